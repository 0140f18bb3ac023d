"""SimHash against a brute-force version."""

import random

import numpy as np
import pytest
import xxhash

from geoloom.llm import simhash


def brute_fp(text):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return 0
    s = [b" ".join(w[i : i + 4]) for i in range(max(1, len(w) - 3))]
    h = [xxhash.xxh64(x, seed=42).intdigest() for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(rows, limit=4):
    fp = {d: brute_fp(t) for d, t in rows}
    ids, label = sorted(fp), {d: d for d in fp}
    while True:
        before = dict(label)
        for a in ids:
            for b in ids:
                if (fp[a] ^ fp[b]).bit_count() <= limit:
                    label[a] = label[b] = min(label[a], label[b])
        if before == label:
            return {d: (f"{fp[d]:016x}", label[d]) for d in ids}


def made(n=120):
    r = random.Random(3)
    words = [f"W{i}é" for i in range(300)]
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one"), (4, "one"), (5, "One two three")]
    base = []
    for d in range(10, 10 + n):
        if base and r.random() < 0.6:
            w = list(r.choice(base))
            for _ in range(r.randrange(4)):
                w[r.randrange(len(w))] = r.choice(words)
        else:
            w = [r.choice(words) for _ in range(r.choice((5, 40, 400)))]
        base.append(w)
        rows.append((d, r.choice((" ", "\n", "\v")).join(w)))
    return rows + [(900, "x " * 5000), (901, "x " * 5000)]


def test_near_duplicates_match_brute_force(spark):
    rows = made()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(df).collect()}
    assert got == brute(rows)


def test_empty_table_and_extra_columns(spark):
    df = spark.createDataFrame([], "doc_id long, text string, fp string, k int, label int")
    assert simhash.near_duplicates(df).count() == 0
    df = spark.createDataFrame([(7, "a b c d e", "x", 1, 2), (7, "a b c d e", "y", 1, 2), (None, "q", "z", 0, 0)], df.schema)
    got = sorted((r.doc_id or -1, r.component_id) for r in simhash.near_duplicates(df).collect())
    assert got == [(-1, None), (7, 7), (7, 7)]


def test_rows_without_an_id_connect_others(spark, monkeypatch):
    """1 and 3 lie eight bits apart, with a null id's fingerprint between them."""
    rows = [(1, 0), (None, 0b1111), (3, 0b11111111), (4, -1)]
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, words: docs.select("doc_id", "fp"))
    df = spark.createDataFrame(rows, "doc_id long, fp long")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df).collect()}
    assert got == {1: 1, None: None, 3: 1, 4: 4}


def test_only_null_ids(spark):
    df = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "")], "doc_id long, text string")
    assert [r.component_id for r in simhash.near_duplicates(df).collect()] == [None] * 3


@pytest.mark.parametrize("limit", [4, 8])
def test_every_pair_within_the_limit_shares_a_passing_group(limit):
    r = random.Random(5)
    for _ in range(3000):
        a = r.getrandbits(64)
        b = a
        for bit in r.sample(range(64), r.randrange(limit + 1)):
            b ^= 1 << bit
        x = np.array([a, b], np.uint64)
        k, start = simhash.keys(x, limit)
        assert any(k[0, j] == k[1, j] and len(simhash.near(x[:1] ^ x[1:], simhash.chain_masks(start[j], limit))) for j in range(k.shape[1]))


def test_forest_connects_dense_groups():
    r = np.random.default_rng(1)
    base = np.uint64(0x0123456789ABCDEF)
    v = np.unique(base ^ (np.uint64(1) << r.integers(0, 64, 200).astype(np.uint64)))
    a, _ = simhash.forest(v, [(np.uint64(2**64 - 1), 4)])
    assert len(a) == len(v) - 1
