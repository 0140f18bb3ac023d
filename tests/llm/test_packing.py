"""Packing: the boundaries against all cuts, and batches that hold their budget."""

import itertools
import random

import numpy as np
from pyspark.sql import functions as F

from geoloom.llm import packing


def padding(lengths, counts, ends):
    return sum(n * (next(e for e in ends if e >= x) - x) for x, n in zip(lengths, counts, strict=True))


def test_boundaries_are_optimal():
    r = random.Random(1)
    for _ in range(60):
        lengths = sorted(r.sample(range(40), r.randrange(1, 9)))
        counts = [r.randrange(1, 9) for _ in lengths]
        for k in (1, 2, 3, 5):
            ends = packing.boundaries(np.array(lengths), np.array(counts), k)
            best = min(padding(lengths, counts, [*c, lengths[-1]]) for m in range(k) for c in itertools.combinations(lengths[:-1], min(m, len(lengths) - 1)))
            assert len(ends) <= k and ends[-1] == lengths[-1] and padding(lengths, counts, ends) == best


def test_batches(spark):
    r = random.Random(2)
    rows = [(i, "w " * r.choice((0, 1, 3, 50, 51, 400, 900)), "x") for i in range(400)] + [(5, None, "y"), (5, "a b", "z")]
    df = spark.createDataFrame(rows, "doc_id long, text string, bucket string")
    for bins in (4096, 4):
        got = packing.packed(df, buckets=4, budget=500, bins=bins).collect()
        assert len(got) == len(rows) and sorted(x.n_tokens for x in got) == sorted(len((t or "").split()) for _, t, _ in rows)
        by = {}
        for x in got:
            assert x.n_tokens <= x.bucket_length
            by.setdefault((x.bucket, x.batch), []).append(x)
        for (bucket, batch), members in by.items():
            n = len(members)
            assert sorted(m.slot for m in members) == list(range(n))
            assert n == 1 or n * members[0].bucket_length <= 500 or members[0].bucket_length == 0
        for bucket in {b for b, _ in by}:
            full = [len(m) for (b, k), m in sorted(by.items()) if b == bucket]
            assert len(set(full[:-1])) <= 1 and full[-1] <= full[0]


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert packing.packed(df).count() == 0 and "lang" in packing.packed(df).columns


def test_rows_of_any_kind(spark):
    """Names that the operator uses itself, rows without an id or with the same one, and a text of a million words."""
    rows = [(None, "a b", 1, 2, 3)] * 50 + [(7, "a b c", 4, 5, 6)] * 50 + [(8, "w " * 1_000_000, 7, 8, 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, first int, row int, place int").withColumn("whole", F.lit("x")).withColumn("shard", F.lit(1)).withColumn("_in", F.lit(1))
    got = packing.packed(df, buckets=3, budget=40)
    assert got.columns == ["doc_id", "first", "row", "place", "whole", "shard", "_in", "n_tokens", "bucket", "bucket_length", "batch", "slot"]
    rows = got.collect()
    assert len({(r.bucket, r.batch, r.slot) for r in rows}) == len(rows) == 101
    assert sorted({(r.doc_id or 0, r.first, r.row, r.place, r.n_tokens) for r in rows}) == [(0, 1, 2, 3, 2), (7, 4, 5, 6, 3), (8, 7, 8, 9, 1_000_000)]
