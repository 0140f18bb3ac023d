"""Packing by optimal length buckets.

The global histogram of text lengths is cut into at most `buckets` ranges by dynamic programming, so that the padding
(each text filled up to the longest length of its range) is the least possible. Inside each bucket texts are numbered
and dealt into batches of as many rows as fit the token budget.

The histogram has one row per different length and is never coarsened, so the optimum is exact. A length of n takes n words
at least, so the different lengths number at most the root of twice the corpus' words; they reach the driver about BINS
at a time.

Rows of a bucket are numbered without bringing the bucket together: rows are dealt to shards by a hash of a row number
(so that rows which share a doc_id, or have none, spread too), shards are numbered inside, and the (small) table of shard
counts gives each shard its first number.

Defined results: a null or empty text has length 0 and is packed like any other; a text longer than the budget is a
batch of its own; which of a bucket's rows share a batch depends on the order of the input; an empty table gives no
rows; other columns are kept under any name, but one named like a new one gives way to it.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.llm import common

BUCKETS = 16
BUDGET = 65_536
BINS = 4_096
#: Rows of a bucket that one shard has, about.
SHARD_ROWS = 20_000


def n_words(text: Column) -> Column:
    """Words between white space: text as UTF-8 keeps its words when every run of non-space becomes one sign."""
    return F.coalesce(F.length(F.regexp_replace(F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x"), r"[^x]+", "")), F.lit(0)).cast("long")


def histogram(lengths: DataFrame, bins: int = BINS) -> tuple[np.ndarray, np.ndarray]:
    """All lengths (ascending) and how many rows have each; about `bins` of them are brought to the driver at once."""
    h = common.written(lengths.groupBy("n_tokens").agg(F.count(F.lit(1)).alias("n")))
    parts = -(-h.count() // bins)
    rows = sorted((r.n_tokens, r.n) for r in (h.repartitionByRange(parts, "n_tokens").toLocalIterator() if parts > 1 else h.collect()))
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int64)


def boundaries(lengths: np.ndarray, counts: np.ndarray, buckets: int = BUCKETS) -> list[int]:
    """The longest length of each bucket, ascending; the padding over all rows is the least that `buckets` ranges allow."""
    n = len(lengths)
    if not n:
        return []
    rows = np.concatenate(([0], np.cumsum(counts)))
    best, cuts = lengths * rows[1:], []  # one bucket over the first i + 1 lengths: rows times the longest; the texts' own tokens are a constant
    for _ in range(1, min(buckets, n)):
        now, cut = best.copy(), np.full(n, -1)
        todo = [(0, n - 1, 0, n - 1)]
        while todo:  # the best last cut never moves left as i grows, so the search is divided
            lo, hi, a, b = todo.pop()
            if lo > hi:
                continue
            i = (lo + hi) // 2
            j = np.arange(a, min(b, i - 1) + 1)
            k = a
            if len(j):
                cost = best[j] + lengths[i] * (rows[i + 1] - rows[j + 1])
                x = int(cost.argmin())
                k = int(j[x])
                if cost[x] < now[i]:
                    now[i], cut[i] = cost[x], k
            todo += [(lo, i - 1, a, k), (i + 1, hi, k, b)]
        cuts.append(cut)
        best = now
    out, i = [], n - 1
    for cut in reversed(cuts):
        if i < 0:
            break
        if cut[i] >= 0:
            out.append(int(lengths[i]))
            i = int(cut[i])
    out.append(int(lengths[i]))
    return sorted(set(out))


def packed(docs: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, bins: int = BINS) -> DataFrame:
    """docs without text, with n_tokens, bucket, bucket_length, batch (number inside the bucket), slot (place in the batch)."""
    new = ("n_tokens", "bucket", "bucket_length", "batch", "slot")
    keep = [c for c in docs.columns if c not in (*new, "text")]
    whole = F.struct(*[F.col(f"`{c}`") for c in keep]) if keep else F.lit(None)
    table = common.written(docs.select(whole.alias("whole"), F.monotonically_increasing_id().alias("row"), n_words(F.col("text")).alias("n_tokens")))
    lengths, counts = histogram(table, bins)
    ends = boundaries(lengths, counts, buckets)
    shards = max(1, int(counts.sum()) // SHARD_ROWS)
    edges = F.array(*[F.lit(e).cast("long") for e in ends]) if ends else F.array().cast("array<long>")
    bucket = F.size(F.filter(edges, lambda e: e < F.col("n_tokens"))).cast("int")
    t = table.withColumn("bucket", bucket).withColumn("bucket_length", F.get(edges, F.col("bucket")))
    t = t.withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)))
    sizes = t.groupBy("bucket", "shard").agg(F.count(F.lit(1)).alias("n"))
    first = sizes.withColumn("first", F.sum("n").over(W.partitionBy("bucket").orderBy("shard").rowsBetween(W.unboundedPreceding, -1))).select("bucket", "shard", F.coalesce("first", F.lit(0)).alias("first"))
    t = t.withColumn("place", F.row_number().over(W.partitionBy("bucket", "shard").orderBy("row")) - 1).join(first, ["bucket", "shard"])
    place = F.col("first") + F.col("place")
    rows = F.greatest(F.lit(1), F.floor(F.lit(budget) / F.greatest("bucket_length", F.lit(1)))).cast("long")
    return t.select(*[F.col("whole").getField(c).alias(c) for c in keep], "n_tokens", "bucket", "bucket_length", F.floor(place / rows).cast("long").alias("batch"), (place % rows).cast("long").alias("slot"))
