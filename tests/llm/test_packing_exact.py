"""Packing finds the least padding however many lengths there are."""

import itertools
import random

from geoloom.llm import packing
from tests.llm.test_packing import padding


def test_every_length_is_kept(spark):
    lengths, counts = packing.histogram(spark.range(1, 9001).selectExpr("id as n_tokens").unionByName(spark.range(5).selectExpr("20020L as n_tokens")))
    assert lengths.tolist() == [*range(1, 9001), 20020] and counts.tolist() == [1] * 9000 + [5]


def test_padding_is_least_beyond_the_bins(spark):
    r = random.Random(7)
    rows = [(i, "w " * r.choice(range(1, 60, 2))) for i in range(300)]
    got = packing.packed(spark.createDataFrame(rows, "doc_id long, text string"), buckets=3, bins=5).collect()
    count = {n: sum(x.n_tokens == n for x in got) for n in {x.n_tokens for x in got}}
    lengths = sorted(count)
    best = min(padding(lengths, [count[n] for n in lengths], [*c, lengths[-1]]) for c in itertools.combinations(lengths[:-1], 2))
    assert len(lengths) > 20 and sum(x.bucket_length - x.n_tokens for x in got) == best
