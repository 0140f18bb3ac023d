"""Near copies by exact similarity against a comparison of all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.llm import shingles, simhash


def brute(rows, words=5):
    s = {d: set(simhash.shingles((t or "").encode(), words).tolist()) for d, t in rows}
    label = {d: d for d in s}
    pairs = [(a, b) for a in s for b in s if a < b and (s[a] == s[b] or 5 * len(s[a] & s[b]) >= 4 * len(s[a] | s[b]))]
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if label[a] != label[b]:
                label[a] = label[b] = min(label[a], label[b])
                changed = True
    return {d for d in s if label[d] == d}


@pytest.mark.parametrize("crowd,group", [(1_000, 2_000), (3, 4)])
def test_components_of_all_pairs(spark, monkeypatch, crowd, group):
    """Also where most shingles are frequent and most groups are large."""
    monkeypatch.setattr(shingles, "CROWD", crowd)
    monkeypatch.setattr(shingles, "GROUP", group)
    r = random.Random(4)
    words, texts = [f"w{i}" for i in range(400)], []
    for _ in range(40):
        base = [r.choice(words) for _ in range(r.choice((3, 30, 60, 200)))]
        texts.append(base)
        for _ in range(r.randrange(6)):  # chains of copies on both sides of the threshold
            base = list(r.choice((base, texts[-1])))
            for _ in range(r.randrange(6)):
                base[r.randrange(len(base))] = r.choice(words)
            texts.append(base + [r.choice(words)] * r.randrange(4))
    rows = [(i, "common line of every text " + " ".join(t)) for i, t in enumerate(texts)] + [(900, None), (901, ""), (902, "one"), (903, "ONE")]
    df = spark.createDataFrame([(d, t, "x") for d, t in rows] + [(None, "q", "z"), (None, "q", "z"), (902, "one", "w")], "doc_id long, text string, label string")
    out = shingles.deduplicated(df, 5)
    got = [x.doc_id for x in out.collect()]
    assert out.columns == df.columns and got.count(None) == 2
    assert sorted(d for d in got if d is not None) == sorted(brute(rows)) and len(brute(rows)) < len(rows) - 20


def test_fewer_shared_shingles_than_the_threshold_are_no_link_whatever_the_fingerprints(spark):
    """Pairs that pigeonring proposes are compared by their sets: here every fingerprint is the same."""
    same = [f"s{i}" for i in range(60)]
    rows = [(i, " ".join(same + [f"{c}{j}" for j in range(20)])) for i, c in enumerate("abc")] + [(7, " ".join(same + [f"a{j}" for j in range(19)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in shingles.deduplicated(docs, 5).collect()) == [0, 1, 2]
    nodes = docs.selectExpr("doc_id as id", "5L as fp")
    assert sorted((r.a, r.b) for r in shingles.ringed(nodes).collect()) == [(0, 1), (0, 2), (0, 7)]


def test_pigeonring_proposes_near_fingerprints(spark):
    nodes = spark.createDataFrame([(5, 0), (2, 0), (9, 15), (4, -1)], "id long, fp long")
    assert sorted((r.a, r.b) for r in shingles.ringed(nodes).collect()) == [(2, 5), (2, 9)]


def test_bitmaps_rule_out_no_pair_that_is_alike_enough(spark):
    """Long sets on both sides of the threshold and of a doubling of the bitmap: all pairs of 0.8 or more stay, clear others of any length go."""
    r = np.random.default_rng(5)
    base = np.unique(r.integers(0, 1 << 63, 4500, dtype=np.uint64))
    sets = {0: base, 1: base[:4090], 2: base[: len(base) * 4 // 5], 3: np.concatenate((base[:4050], r.integers(0, 1 << 63, 60, dtype=np.uint64))), 4: np.concatenate((base[:2600], r.integers(0, 1 << 63, 1900, dtype=np.uint64))), 5: base[:10], 6: base[:0]}
    sets = {k: np.unique(v) for k, v in sets.items()}
    wide = {k: shingles.bitmap(v) for k, v in sets.items()}
    assert len({len(w) for w in wide.values()}) == 3 and shingles.folded(wide[0]) == shingles.folded(wide[0].reshape(2, -1)[0] ^ wide[0].reshape(2, -1)[1])
    marks = spark.createDataFrame([(k, len(sets[k]), wide[k].tolist()) for k in sets], "id long, n long, wide array<long>")
    pairs = [(a, b) for a in sets for b in sets if a < b]
    got = {(x.a, x.b) for x in shingles.hopeful(spark.createDataFrame(pairs, "a long, b long"), marks).collect()}
    alike = {(a, b) for a, b in pairs if 5 * len(np.intersect1d(sets[a], sets[b])) >= 4 * len(np.union1d(sets[a], sets[b]))}
    assert {(0, 1), (0, 2), (1, 3)} <= alike <= got
    assert not got & {(a, b) for a, b in pairs if b >= 4}


def test_one_line_in_every_text_makes_no_large_group(spark, monkeypatch):
    """The sample knows nothing here; exact counts put the line's shingles last, and no group is larger than the few texts that share more."""
    monkeypatch.setattr(shingles, "CROWD", 20)
    monkeypatch.setattr(shingles, "frequent", lambda docs, words: (np.empty(0, np.uint64), np.empty(0, np.int64)))
    r, line = random.Random(9), "this very line of ten words stands in every text"
    rows = [(i, f"{line} " + " ".join(f"w{r.randrange(10**6)}" for _ in range(60))) for i in range(300)] + [(900, f"{line} a b c"), (901, f"{line} a b c d")]
    docs, sizes = spark.createDataFrame(rows, "doc_id long, text string"), []
    plain, make = shingles.blockwise, shingles.marked
    monkeypatch.setattr(shingles, "marked", lambda d, w, o: sizes.append(make(d, w, o).select(F.explode("first").alias("h")).groupBy("h").count().agg(F.max("count")).first()[0]) or make(d, w, o))
    assert sorted(x.doc_id for x in shingles.deduplicated(docs, 5).collect()) == sorted(brute(rows)) == sorted(d for d, _ in rows if d != 901)
    assert sizes[0] > 100 and sizes[-1] <= 20
    monkeypatch.setattr(shingles, "GROUP", 7)
    big = spark.createDataFrame([(5, i, 9, 0, i, b"\0" * 128) for i in range(100)] + [(6, 1, 9, 0, 1, b"\0" * 128)], "h long, id long, n long, at long, label long, bitmap binary")
    dealt = plain(big)
    assert dealt.groupBy("h").count().agg(F.max("count")).first()[0] < 40
    pairs = [(x.a, x.b) for x in dealt.repartition(3, "h").sortWithinPartitions("h", "id").mapInArrow(shingles.apart, "a long, b long").distinct().collect()]
    assert len(pairs) == len(set(pairs)) == 4950
