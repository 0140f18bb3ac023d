"""Texts with very many numbers: linear time, the same spans as brute force, and whole redaction."""

import hashlib
import random
import time

from pyspark.sql import functions as F

from geoloom.llm import pii
from tests.llm.test_pii import RULES, brute


def dense(n, seed=6):
    r = random.Random(seed)
    bits = ("a{}@b.org", "10.{}.0.9", "4111 1111 1111 1111", "+49 30 12345{}", "{}", "id-{}", "Ünï \U0001f600", "x", "300.{}.1.1")
    return " ".join(r.choice(bits).format(r.randrange(100)) + r.choice(("", " and", ",\n")) for _ in range(n))


def redacted(text, found):
    spans = sorted((int(a), int(b), k) for k, a, b in (x.split(":") for x in found.split(",")))
    out, at = [], 0
    for a, b, k in spans:
        if a >= at:
            out += [text[at:a], f"[{k.upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def test_running_folds(spark):
    r = random.Random(1)
    for n in (0, 1, 63, 64, 65, 130, 4096, 9000):
        values = [r.randrange(50) for _ in range(n)]
        row = spark.createDataFrame([(values,)], "v array<int>").select(pii.running(F.col("v"), lambda a, x: a + x).alias("sum"), pii.running(F.col("v"), lambda a, x: F.greatest(a, x)).alias("most")).first()
        assert row["sum"] == [sum(values[:i]) for i in range(n + 1)] if n < 200 else row["sum"][-1] == sum(values) and row["sum"][-2] == sum(values[:-1]) and len(row["sum"]) == n + 1
        assert row.most == [max([0, *values[:i]]) for i in range(n + 1)] if n < 200 else row.most == sorted(row.most) and row.most[-1] == max(values)


def test_pieces_give_any_part(spark):
    text = "".join(chr(97 + i % 26) if i % 7 else "\U0001f600" for i in range(2000))
    places = [(0, 0), (0, 1), (511, 513), (0, 2000), (1999, 2000), (1990, 2030), (-5, 4), (700, 700), (512, 1024), (2000, 2040)]
    df = spark.createDataFrame([(text, a, b) for a, b in places], "t string, a int, b int").select("a", "b", pii.bound(pii.cut(F.col("t")), lambda p: pii.between(p, F.col("a"), F.col("b"))).alias("x"))
    assert all(r.x == text[max(r.a, 0) : r.b] for r in df.collect())


def test_dense_text_matches_brute_force(spark):
    rows = [(i, dense(n)) for i, n in enumerate((5, 300, 5000, 20000))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got, clean = {r.doc_id: r for r in pii.report(df).collect()}, {r.doc_id: r.text for r in pii.redact(df).collect()}
    for d, t in rows:
        want = brute(t)
        assert got[d].base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [got[d][f"n_{k}"] for k in RULES] == [sum(x.startswith(k) for x in want) for k in RULES]
        assert set(want) <= set(got[d].spans.split(","))
        assert clean[d] == redacted(t, got[d].spans)


def test_a_megabyte_of_numbers_takes_linear_time(spark):
    """Over what a small text takes on a warm session."""

    def seconds(n):
        df = spark.createDataFrame([(1, " x ".join(str(100_000 + i) for i in range(n)))], "doc_id long, text string")
        began = time.perf_counter()
        assert [r.n_spans for r in pii.report(df).collect()] == [0] and pii.redact(df).first().text.count(" x ") == n - 1
        return time.perf_counter() - began

    plain = min(seconds(10), seconds(10))
    assert seconds(110_000) - plain < 20
