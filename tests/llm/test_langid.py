"""Language ID: the forward sum against all segmentations, held-out accuracy, and odd rows."""

import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from geoloom.llm import common, langid

SF = "/root/testdata/sf0.001"


def test_forward_sums_all_segmentations():
    r = random.Random(1)
    found = sorted({bytes(r.choice(b"ab c") for _ in range(n)) for n in (1, 2, 3) for _ in range(12)} | {bytes([c]) for c in b"ab c"})
    p = np.array([[r.random(), r.random()] for _ in found])
    index, root = {x: i for i, x in enumerate(found)}, langid.tree(found)
    many = [bytes(r.choice(b"abc") for _ in range(r.randrange(1, 8))) for _ in range(20)]
    for w, got in zip(many, langid.forward(many, root, p), strict=True):
        want = np.zeros(2)
        for cuts in itertools.product((0, 1), repeat=len(w) - 1):
            at = [0, *[i + 1 for i, c in enumerate(cuts) if c], len(w)]
            parts = [w[a:b] for a, b in itertools.pairwise(at)]
            if all(x in index for x in parts):
                want += np.prod([p[index[x]] for x in parts], axis=0)
        assert np.allclose(np.exp(got), want)
        assert np.allclose(langid.long_forward(w, root, np.log(p)), got)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.report(docs, most=40).join(docs.select("doc_id", "lang"), "doc_id").collect()
    out = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and len(out) > 20
    assert sum(r.lang == r.lang_pred for r in out) / len(out) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    schema = "doc_id long, text string, lang string, score string"
    rows = [(1, "der die das und nicht", "de", "x"), (3, "der die das und nicht", "de", "x"), (2, "the and of that with", "en", "y"), (4, "the and of that", "en", "y"), (5, None, "en", ""), (6, "123 !! ½ ²", "de", ""), (None, "the and", None, ""), (7, "the " + "a" * 5000, None, ""), (7, "nicht und", None, "")]
    df = spark.createDataFrame(rows, schema)
    path = common.tokenizer_path(langid.VOCABULARY)
    got = langid.report(df, path).collect()
    assert len(got) == len(rows)
    assert {r.lang_pred for r in got if r.doc_id in (5, 6)} == {"und"} and {r.score for r in got if r.doc_id in (5, 6)} == {0.0}
    assert langid.report(df.limit(0), path).count() == 0
    none = langid.report(spark.createDataFrame([(1, "abc", None, "")], schema), path).collect()
    assert (none[0].lang_pred, none[0].score) == ("und", 0.0)


def test_long_runs_are_summed_whole():
    """A run of 18 characters that has 54 bytes: every segmentation counts, those across byte 32 too."""
    word = "日本語の文章は空白なしで書かれるもの"
    w = langid.spelled(word)
    found = sorted({bytes([c]) for c in range(256)} | {x.encode() for x in ("日本", "日本語", "文章", "空白", "なし", "書かれる", "もの", "るもの")})
    root, r = langid.tree(found), random.Random(5)
    p = np.array([[r.random(), r.random()] for _ in found])
    p /= p.sum(axis=0)
    sums = np.zeros((len(w) + 1, 2))
    sums[0] = 1
    index = {x: i for i, x in enumerate(found)}
    for j in range(1, len(w) + 1):
        for i in range(j):
            if w[i:j] in index:
                sums[j] += sums[i] * p[index[w[i:j]]]
    assert len(w) > langid.SHORT and np.allclose(langid.forward([w, b" a"], root, p)[0], np.log(sums[-1]))
    counts = {k: langid.expected({k: 2}, root, p[:, 0].tolist()) for k in (w, w[:20])}
    for k, c in counts.items():
        assert np.isclose(sum(n * len(x) for n, x in zip(c, found, strict=True)), 2 * len(k))


def brute(rows, held, most, rounds):
    """The whole prediction again: the same sample and vocabulary, expectation maximisation and scores by plain sums over all segmentations."""
    found = langid.pieces(common.tokenizer_path(langid.VOCABULARY))
    index = {x: i for i, x in enumerate(found)}
    reach = max(map(len, found))
    words = lambda t: [b" " + w.encode() for w in re.findall(r"[^\W\d_]+", t.lower())]
    arcs = lambda w: [(i, j, index[w[i:j]]) for i in range(len(w)) for j in range(i + 1, min(len(w), i + reach) + 1) if w[i:j] in index]
    langs = sorted({r.lang for r in rows if r.lang})
    logs = []
    for lang in langs:
        seen = [w for r in rows if r.lang == lang and not held[r.doc_id] for w in words(r.text)]
        p = np.array([1 / 256 ** min(len(x), 3) if len(x) == 1 else 0.02 / len(found) * 50 for x in found])
        for _ in range(rounds + 1):
            got = np.full(len(found), langid.SMOOTH)
            for w in seen:
                a = arcs(w)
                f, b = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
                f[0] = b[-1] = 1
                for i, j, x in a:
                    f[j] += f[i] * p[x]
                for i, j, x in reversed(a):
                    b[i] += p[x] * b[j]
                for i, j, x in a:
                    got[x] += f[i] * p[x] * b[j] / f[-1]
            p = got / got.sum()
        logs.append(p)
    out = {}
    for r in rows:
        score = []
        for p in logs:
            total = 0.0
            for w in words(r.text):
                f = np.zeros(len(w) + 1)
                f[0] = 1
                for i, j, x in arcs(w):
                    f[j] += f[i] * p[x]
                total += np.log(f[-1])
            score.append(total)
        best = int(np.argmax(score))
        out[r.doc_id] = (langs[best], 1 / sum(np.exp(s - score[best]) for s in score))
    return out


def test_whole_prediction_matches_brute_force(spark):
    """Every text, short enough for the brute-force version; learned from all that are not held out, repeated texts as often as they come."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", F.substring("text", 1, 60).alias("text"), "lang").where("doc_id < 60 and text rlike '[a-z]'")
    docs = docs.unionByName(docs.where("doc_id < 5").withColumn("doc_id", F.col("doc_id") + 1000))
    rows = docs.collect()
    got = {r.doc_id: r for r in langid.report(docs, most=10_000).collect()}
    want = brute(rows, {d: got[d].held_out for d in got}, 10_000, langid.ROUNDS)
    assert len(got) == len(rows) == len(want)
    for d, (lang, score) in want.items():
        assert got[d].lang_pred == lang and abs(got[d].score - score) < 1e-6, d
