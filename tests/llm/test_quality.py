"""Quality rules: statistics against brute force, constraints, held-out accuracy."""

import random
import re
from collections import Counter

import numpy as np

from geoloom.llm import quality

SF = "/root/testdata/sf0.001"


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    tri = Counter(zip(w, w[1:], w[2:], strict=False))
    on = {j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(on)


def test_statistics_match_brute_force():
    r = random.Random(1)
    bits = ["a", "bb", "Ünï", "#x", "日本", "&", "|", "\xa0", "\x1c"]
    texts = ["", " \n", "a", "a b", "a a a a", "x\n\nx\nx ", "\x0b\x0c", "w" * 3000] + ["".join(r.choice(bits) + r.choice((" ", "\n", "\t", "")) for _ in range(r.choice((3, 30, 300)))) for _ in range(80)]
    got = quality.statistics([t.encode() for t in texts])
    assert [tuple(x) for x in got[:, :5].tolist()] == [brute(t) for t in texts]


def test_constraints_hold():
    r = np.random.default_rng(0)
    x = r.random((3000, 2))
    y = ((x[:, 0] + 0.5 * np.sin(9 * x[:, 0]) - x[:, 1] + r.normal(0, 0.2, 3000)) > 0).astype(float)
    m = quality.fit(x, y, (1, -1), trees=30)
    grid = np.linspace(0, 1, 200)
    for fixed in (0.1, 0.5, 0.9):
        up = m.score(np.stack((grid, np.full(200, fixed)), axis=1))
        down = m.score(np.stack((np.full(200, fixed), grid), axis=1))
        assert (np.diff(up) >= -1e-12).all() and (np.diff(down) <= 1e-12).all()
    assert ((m.score(x) > 0.5) == y).mean() > 0.8


def test_held_out_accuracy():
    import duckdb

    d = "/root/testdata/sf0.01"
    rows = duckdb.sql(f"select text, quality from '{d}/documents.parquet' join '{d}/labels.parquet' using (doc_id) order by hash(doc_id)").fetchall()
    x, y = quality.features(quality.statistics([t.encode() for t, _ in rows])), np.array([float(q) for _, q in rows])
    n = len(rows) * 2 // 3
    m = quality.fit(x[:n], y[:n], tuple(quality.FEATURES.values()))
    assert ((m.score(x[n:]) > 0.5) == y[n:]).mean() > 0.9


def test_report(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = quality.report(docs, labels)
    assert got.count() == docs.count()
    assert got.where("base_failed and kept").count() == 0 and got.where("kept").count() > 0
    assert got.where("base_failed <> (n_words < 50 or 100 * n_repeat_words > 50 * n_words)").count() == 0


def test_odd_rows(spark):
    df = spark.createDataFrame([(1, None, 5), (1, "", 5), (None, "a " * 60, 5), (2, " ".join(f"w{i}" for i in range(80)), 5)], "doc_id long, text string, n_words int")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = sorted((r.doc_id or -1, r.n_words, r.base_failed, r.kept) for r in quality.report(df, none).collect())
    assert got == [(-1, 60, True, False), (1, 0, True, False), (1, 0, True, False), (2, 80, False, True)]
    assert quality.report(df.limit(0), none).count() == 0
