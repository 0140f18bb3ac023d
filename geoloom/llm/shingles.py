"""Exact near-duplicates: documents whose sets of word shingles have a Jaccard similarity of SHARE or more.

Candidates come from two sides, and every link is checked against the full sets. Pigeonring finds the pairs whose
SimHash fingerprints (of the same shingles) lie within a few bits. Pairs at the threshold differ in some ten bits, which no
Hamming search finds cheaply, so a prefix filter adds every pair that it leaves out: with all shingles in one global
order, two sets that are 4/5 alike share one of the first n - ceil(4n/5) + 1 of each set's n. Sets meet in groups by
these shingles alone; no such pair is missed, and the order only
decides how many others meet: shingles that a sample of texts often has come last, and so do those that are then counted in more
than CROWD prefixes of all texts. What groups of more than GROUP members are left (texts that have frequent shingles alone) is compared
by pairs of blocks, each in a task of its own.

Groups of near copies are dense, so pairs come in two turns. First come the pigeonring pairs, and each prefix group
links its members to one of them; what is then checked and joined to components is tried no more. The second turn takes
every pair of a prefix group that still lies in two components, so that the components are those of all pairs. Of these,
only pairs go on whose bitmaps (parities of the shingles by hash) allow the overlap: each differing bit is a shingle that
one set alone has, so the bound is exact. Small bitmaps of one size go with the groups; before full sets are sent to any pair
of either turn, wide ones, which grow with the set, are compared: a small part of a set's bytes, and as telling for long texts.

Defined results: a null text has no shingles, as an empty one, and equal sets are copies; fewer words than the shingle
size give one shingle; of rows that share a doc_id one stays (the first text in order) before anything is compared; rows
without a doc_id all stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm import common, simhash, tokens

#: Similarity as a fraction of whole numbers, so that every comparison is exact.
SHARE = (4, 5)
#: Texts that the order of shingles is estimated from, how often one must occur there to be put last, and how many of those are kept at most. Results don't depend on them.
SAMPLE, OFTEN, KNOWN = 5_000, 3, 200_000
PAIRS = 1_000_000
#: A prefix shingle of more texts than this is counted and put last for all; a group of more members is compared block by block.
CROWD, GROUP = 1_000, 2_000
#: How often the order is made anew from exact counts; shingles that then move up may be frequent, too.
ORDERS = 1
#: Up to so many ids (8 bytes each) are broadcast to pick their texts in the scan; more are joined by a shuffle.
FEW_IDS = 2_000_000
#: Bits of a set's small bitmap, a power of two, and the least number of bits a shingle of its wide one.
BITS, WIDE = 1024, 4


def shingle_set(text: bytes, words: int) -> np.ndarray:
    return np.unique(simhash.shingles(text, words))


def bitmap(s: np.ndarray) -> np.ndarray:
    """Which hash classes hold an odd number of a set's shingles: WIDE bits or more a shingle, a power of two in all, as longs. Classes are the low bits of hashes, so the halves of a bitmap, one upon the other, are the bitmap of half the size."""
    m = max(BITS, 1 << (WIDE * len(s) - 1).bit_length())
    return np.packbits(np.bincount((s & np.uint64(m - 1)).astype(np.int64), minlength=m).astype(np.uint8) & 1).view(np.int64)


def folded(wide: np.ndarray) -> bytes:
    """A wide bitmap as one of BITS bits."""
    return np.bitwise_xor.reduce(wide.reshape(-1, BITS // 64), axis=0).tobytes()


def sets(docs: DataFrame, words: int) -> DataFrame:
    """id, shingles (sorted, as signed longs) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [shingle_set(t, words).view(np.int64) for t in common.text_bytes(b.column(1))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(got, pa.list_(pa.int64()))], names=["id", "shingles"])

    return docs.select(F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(run, "id long, shingles array<long>")


def frequent(docs: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that a sample of texts often has (sorted), and how often."""
    n = docs.count()
    some = docs if n <= SAMPLE else docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(-(-n // SAMPLE))) == 0)
    h = sets(some, words).select(F.explode("shingles").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= OFTEN)
    rows = h.orderBy(F.desc("n"), "h").limit(KNOWN).toArrow()
    h, n = (rows.column(i).to_numpy() for i in range(2))
    order = np.argsort(h.view(np.uint64))
    return h.view(np.uint64)[order], n[order]


def counted(dealt: DataFrame, before: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray] | None:
    """The order's shingles with their exact numbers of prefixes, where some stands in more than CROWD prefixes and was not among those put last; else None. At most KNOWN, the most frequent."""
    h = dealt.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > CROWD).orderBy(F.desc("n"), "h").limit(KNOWN).toArrow()
    found = dict(zip(h.column(0).to_numpy().view(np.uint64).tolist(), h.column(1).to_pylist(), strict=True))
    if found.keys() <= set(before[0].tolist()):
        return None
    # those of the sample stay behind all that it did not have, by how often all texts would have them
    scale = max(1, int(max(found.values())))
    every = {k: int(n) * scale for k, n in zip(before[0].tolist(), before[1].tolist(), strict=True)}
    for k, n in found.items():
        every[k] = max(every.get(k, 0), n)
    most = sorted(every, key=lambda k: (-every[k], k))[: 2 * KNOWN]
    keys = np.array(sorted(most), np.uint64)
    return keys, np.array([every[int(k)] for k in keys], np.int64)


def marked(docs: DataFrame, words: int, order: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """id, digest of the set, n (its size), fp (its SimHash), bitmap, wide (bitmap), first (the shingles of its prefix in order) of each row. order: shingles (sorted) that come last, and how often each is."""
    sent = docs.sparkSession.sparkContext.broadcast(order)
    p, q = SHARE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh128_digest

        known, often = sent.value
        for b in batches:
            digest, size, first, fp, odd, wide = [], [], [], [], [], []
            for t in common.text_bytes(b.column(1)):
                s = shingle_set(t, words)
                n = len(s)
                rank = np.zeros(n, np.int64)
                if n and len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    rank = np.where(known[at] == s, often[at], 0)
                digest.append(xxh128_digest(s.tobytes()))
                size.append(n)
                fp.append(simhash.bits(s))
                wide.append(bitmap(s))
                odd.append(folded(wide[-1]))
                first.append(s[np.argsort(rank, kind="stable")][: n - -(-p * n // q) + 1 if n else 0].view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(digest, pa.binary()), pa.array(size, pa.int64()), pa.array(np.array(fp, np.uint64).view(np.int64)), pa.array(odd, pa.binary()), pa.array(wide, pa.list_(pa.int64())), pa.array(first, pa.list_(pa.int64()))], names=["id", "digest", "n", "fp", "bitmap", "wide", "first"])

    return docs.select(F.col("doc_id").cast("long").alias("id"), "text").mapInArrow(run, "id long, digest binary, n long, fp long, bitmap binary, wide array<long>, first array<long>")


def groups(run: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Whole groups of a stream sorted by its first column, many at a time; a group may go on in the next batch."""
    kept: list[list[np.ndarray]] = []
    for b in run:
        if not b.num_rows:
            continue
        now = [b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns)]
        k = now[0]
        if kept and k[0] == k[-1] == kept[-1][0][-1]:
            kept.append(now)
            continue
        last = int(np.flatnonzero(k != k[-1])[-1]) + 1 if k[0] != k[-1] else 0
        done = [np.concatenate(c) for c in zip(*kept, [x[:last] for x in now], strict=True)]
        kept = [[x[last:] for x in now]]
        if len(done[0]):
            yield done
    if kept:
        yield [np.concatenate(c) for c in zip(*kept, strict=True)]


def possible(n: np.ndarray, at: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows a and b can be alike enough, if the shingle of their group is the first that they share: what is left of the smaller set must reach the overlap."""
    p, q = SHARE
    most = 1 + np.minimum(n[a] - at[a], n[b] - at[b]) - 1
    return most * (p + q) >= p * (n[a] + n[b])


def paired(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    pair = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1), axis=0)
    return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["a", "b"])


def stars(run: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of each member with one of its group; groups of the same members mostly choose different ones."""
    for h, i, n, at in groups(run):
        edge = np.concatenate(([0], np.flatnonzero(np.diff(h)) + 1))
        size = np.diff(np.concatenate((edge, [len(h)])))
        order = np.lexsort((tokens.mix(h.view(np.uint64) ^ tokens.mix(i.view(np.uint64))), np.repeat(np.arange(len(edge)), size)))
        a, b = np.repeat(order[edge], size), np.arange(len(h))
        ok = (i[a] != i[b]) & possible(n, at, a, b)
        yield paired(i[a[ok]], i[b[ok]])


def mixed(run: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The groups that have members of several labels."""
    for c in groups(run):
        edge = np.concatenate(([0], np.flatnonzero(np.diff(c[0])) + 1))
        ok = np.repeat(np.minimum.reduceat(c[4], edge) < np.maximum.reduceat(c[4], edge), np.diff(np.append(edge, len(c[0]))))
        yield pa.RecordBatch.from_arrays([pa.array(x[ok]) for x in c], names=["h", "id", "n", "at", "label"])


def blockwise(rows: DataFrame) -> DataFrame:
    """Rows of groups (h), those of large groups once for each pair of blocks that theirs is in, under a hash of their own; block is their own, and alone tells pairs of a block with itself (and small groups)."""
    size = rows.groupBy("h").agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > GROUP).select("h", F.ceil(F.col("m") / GROUP).cast("int").alias("blocks"))
    j = rows.join(size, "h", "left").withColumn("block", F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("id"), "blocks").cast("int")))
    j = j.withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)))
    key = F.when(F.col("blocks").isNull(), F.col("h")).otherwise(F.xxhash64("h", F.least("block", "other"), F.greatest("block", "other")))
    return j.select(key.alias("h"), "id", "n", "at", "label", "bitmap", "block", (F.col("block") == F.col("other")).alias("alone"))


def apart(run: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All pairs of a group's members that have different labels and whose bitmaps allow the overlap; of two blocks, those of one member each."""
    p, q = SHARE
    for h, i, n, at, label, odd, block, alone in groups(run):
        bits = np.frombuffer(b"".join(odd), np.uint64).reshape(len(h), -1)
        edge = np.concatenate(([0], np.flatnonzero(np.diff(h)) + 1, [len(h)]))
        a, b, held = [], [], 0
        for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            for x in range(lo, hi - 1):
                y = np.arange(x + 1, hi)
                y = y[(label[y] != label[x]) & (alone[x] | (block[y] != block[x]))]
                y = y[possible(n, at, np.full(len(y), x), y)]
                both = n[x] + n[y]
                y = y[(both - np.bitwise_count(bits[y] ^ bits[x]).sum(axis=1, dtype=np.int64)) * (p + q) >= 2 * p * both]
                a.append(np.full(len(y), i[x]))
                b.append(i[y])
                held += len(y)
                if held > PAIRS:
                    yield paired(np.concatenate(a), np.concatenate(b))
                    a, b, held = [], [], 0
        if held:
            yield paired(np.concatenate(a), np.concatenate(b))


def ringed(nodes: DataFrame, limit: int = simhash.LIMIT) -> DataFrame:
    """Pairs (a, b) of ids that connect all whose fingerprints are within `limit` bits, by pigeonring."""
    first = common.written(nodes.groupBy("fp").agg(F.min("id").alias("low")))
    same = nodes.join(first, "fp").where("id <> low").select(F.col("low").alias("a"), F.col("id").alias("b"))
    far = simhash.links(first, limit).join(first.select(F.col("fp").alias("a"), F.col("low").alias("x")), "a").join(first.select(F.col("fp").alias("b"), F.col("low").alias("y")), "b")
    return same.union(far.select(F.least("x", "y"), F.greatest("x", "y")))


def hopeful(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sizes and wide bitmaps allow the overlap. Sizes that do let bitmaps differ by one doubling at most."""
    p, q = SHARE
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    own = marks.join(ids, "id", "left_semi")
    j = pairs.join(own.select(F.col("id").alias("a"), F.col("n").alias("na"), F.col("wide").alias("x")), "a").join(own.select(F.col("id").alias("b"), F.col("n").alias("nb"), F.col("wide").alias("y")), "b")

    def halved(x: Column) -> Column:
        m = (F.size(x) / 2).cast("int")
        return F.zip_with(F.slice(x, F.lit(1), m), F.slice(x, m + 1, m), lambda u, v: u.bitwiseXOR(v))

    x = F.when(F.size("x") > F.size("y"), halved(F.col("x"))).otherwise(F.col("x"))
    y = F.when(F.size("y") > F.size("x"), halved(F.col("y"))).otherwise(F.col("y"))
    differ = F.aggregate(F.zip_with(x, y, lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda n, v: n + v)
    both = F.col("na") + F.col("nb")
    sizes = F.least("na", "nb") * q >= F.greatest("na", "nb") * p
    return j.where(F.when(sizes, (both - differ) * (p + q) >= both * (2 * p)).otherwise(False)).select("a", "b")


def verified(docs: DataFrame, pairs: DataFrame, marks: DataFrame, words: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike enough: full sets are compared where bitmaps don't rule that out."""
    p, q = SHARE
    pairs = common.written(hopeful(pairs, marks))
    ids = common.written(pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct())
    if ids.count() <= FEW_IDS:
        ids = F.broadcast(ids)
    full = common.written(sets(docs.join(ids, docs["doc_id"].cast("long") == ids["doc_id"], "left_semi"), words))
    j = pairs.join(full.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(full.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b")
    same = F.size(F.array_intersect("x", "y"))
    j = j.select("a", "b", same.alias("same"), (F.size("x") + F.size("y")).alias("both"))
    return j.where(F.col("same") * q >= (F.col("both") - F.col("same")) * p).select("a", "b")


def near_copies(docs: DataFrame, words: int) -> DataFrame:
    """id, label (smallest id of its component) of each row; doc_id is unique and not null."""
    common.ship(docs.sparkSession)
    order = frequent(docs, words)
    marks = common.written(marked(docs, words, order))
    first = marks.groupBy("digest").agg(F.min("id").alias("rep"))
    tagged = common.written(marks.select("id", "digest").join(first, "digest").select("id", "rep"))
    copies = tagged.where("id <> rep")
    for _ in range(ORDERS):
        exact = counted(marks.join(copies, "id", "left_anti").select(F.explode("first").alias("h")), order)
        if exact is None:
            break
        common.drop(marks)
        order, marks = exact, common.written(marked(docs, words, exact))
    nodes = marks.join(copies, "id", "left_anti")
    dealt = nodes.select("id", "n", F.posexplode("first").alias("at", "h")).select("h", "id", "n", F.col("at").cast("long").alias("at"))

    def several(run: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in groups(run):
            edge = np.flatnonzero(np.diff(c[0])) + 1
            size = np.diff(np.concatenate(([0], edge, [len(c[0])])))
            ok = np.repeat(size > 1, size)
            yield pa.RecordBatch.from_arrays([pa.array(x[ok]) for x in c], names=["h", "id", "n", "at"])

    def sorted_by_group(t: DataFrame) -> DataFrame:
        return t.repartition("h").sortWithinPartitions("h", "id")

    met = common.written(sorted_by_group(dealt).mapInArrow(several, "h long, id long, n long, at long"))
    tried = common.written(sorted_by_group(met).mapInArrow(stars, "a long, b long").union(ringed(nodes)).distinct())
    good = common.written(verified(docs, tried, marks, words))
    part = simhash.components(good)
    named = met.join(part.select(F.col("node").alias("id"), "label"), "id", "left").select("h", "id", "n", "at", F.coalesce("label", "id").alias("label"))
    open_groups = sorted_by_group(named).mapInArrow(mixed, "h long, id long, n long, at long, label long").join(marks.select("id", "bitmap"), "id").select("h", "id", "n", "at", "label", "bitmap")
    rest = common.written(sorted_by_group(blockwise(common.written(open_groups))).mapInArrow(apart, "a long, b long").distinct().join(tried, ["a", "b"], "left_anti"))
    more = common.written(verified(docs, rest, marks, words))
    if not more.isEmpty():
        part = simhash.components(good.union(more))
    return tagged.join(part.select(F.col("node").alias("rep"), "label"), "rep", "left").select("id", F.coalesce("label", "rep").alias("label"))


def deduplicated(docs: DataFrame, words: int) -> DataFrame:
    """docs with one document of each component: the one with the smallest doc_id."""
    again = common.written(docs.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("doc_id"))
    if not again.isEmpty():
        one = docs.join(again, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(F.col("text"), *[F.col(c) for c in docs.columns if c not in ("doc_id", "text")])).alias("_row"))
        docs = common.written(docs.join(again, "doc_id", "left_anti").unionByName(one.select("doc_id", "_row.*")).select(*docs.columns))
    found = near_copies(docs.where("doc_id is not null").select("doc_id", "text"), words)
    gone = common.written(found.where("id <> label").select(F.col("id").cast(docs.schema["doc_id"].dataType).alias("doc_id")))
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
