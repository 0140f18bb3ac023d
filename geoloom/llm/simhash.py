"""SimHash near-duplicates: pigeonring-filtered Hamming links between fingerprints, and their components.

Pigeonring: cut the 64 bits into M segments on a ring. Two fingerprints within T bits have a start from which the
differences of every chain of l consecutive segments add up to at most l*T/M. Rows are dealt by what the first two
segments of such a chain may look like (the first equal, the second with one bit left out), the longer chains are
tested inside the group, and only what passes gets the full Hamming test.

Links and components are those of the different fingerprints, so copies cost nothing and documents of any id, null ids
too, carry links on; a component is named by the smallest doc_id in it at the end.

Defined results: a null text has no words and the fingerprint zero, as an empty one; fewer words than the shingle
size give one shingle; zero fingerprints link like any other; rows with one fingerprint get the same component; a null
doc_id has a fingerprint and a null component, and connects others; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm import common, tokens

SEED = 42
WORDS = 4
LIMIT = 4
#: Groups up to this size are compared as arrays of pairs, larger ones by search from member to member.
SMALL = 64


def shingles(text: bytes, words: int = WORDS) -> np.ndarray:
    """Hashes of the shingles of a text in their order; fewer words than the size give one, no words give none."""
    from xxhash import xxh64_intdigest

    got = text.translate(common.LOWER).split()
    if not got:
        return np.zeros(0, "<u8")
    joined = b" ".join(got)
    if len(got) <= words:
        return np.array([xxh64_intdigest(joined, SEED)], "<u8")
    ends = np.cumsum(np.fromiter(map(len, got), np.int64, len(got)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(got) - words + 1
    return np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends[words - 1 :].tolist(), strict=True)), "<u8", n)


def bits(h: np.ndarray) -> int:
    """64 bits: bit b is 1 where over half of the hashes have it; 0 where there are none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        ones += np.unpackbits(h[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(((2 * ones > len(h)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum()) if len(h) else 0


def fingerprint(text: bytes, words: int = WORDS) -> int:
    return bits(shingles(text, words))


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, fp (the fingerprint as a signed long) of each row."""
    common.ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t, words) for t in common.text_bytes(b.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, fp long")


def ring(limit: int) -> list[tuple[int, int]]:
    """Position and width of each segment: one more than `limit`, so that the first of a chain must be equal."""
    m = limit + 1
    widths = [64 // m + (i < 64 % m) for i in range(m)]
    return list(zip(np.cumsum([0, *widths[:-1]]).tolist(), widths, strict=True))


def keys(fp: np.ndarray, limit: int = LIMIT) -> tuple[np.ndarray, np.ndarray]:
    """Group keys of each fingerprint (a row each), and the start of the chain that each column stands for."""
    r, out, starts = ring(limit), [], []
    for i, (at, w) in enumerate(r):
        at2, w2 = r[(i + 1) % len(r)]
        first = (fp >> np.uint64(at)) & np.uint64((1 << w) - 1)
        second = (fp >> np.uint64(at2)) & np.uint64((1 << w2) - 1)
        for bit in range(w2):
            rest = second & ~np.uint64(1 << bit)
            out.append((np.uint64(i << 16 | bit) << np.uint64(32)) | (first << np.uint64(w2)) | rest)
            starts.append(i)
    return np.stack(out, axis=1), np.array(starts)


def chain_masks(start: int, limit: int = LIMIT) -> list[tuple[np.uint64, int]]:
    """Mask and budget of the chains of one segment and more from a start; the last is the full Hamming test."""
    r, mask, out = ring(limit), 0, []
    for k in range(len(r)):
        at, w = r[(start + k) % len(r)]
        mask |= ((1 << w) - 1) << at
        out.append((np.uint64(mask), (k + 1) * limit // len(r)))
    return out


def near(x: np.ndarray, tests: list[tuple[np.uint64, int]]) -> np.ndarray:
    """Which differences stay within every chain's budget; shorter chains first, the full test on what is left."""
    ok = np.arange(len(x))
    for mask, most in tests:
        ok = ok[np.bitwise_count(x[ok] & mask) <= most]
    return ok


def forest(v: np.ndarray, tests: list[tuple[np.uint64, int]]) -> tuple[list[int], list[int]]:
    """Links (numbers of members) that connect what the group's own links connect: each search takes what it reaches out of the rest, so a dense group costs little more than its size."""
    ones = np.array([(v >> np.uint64(i) & np.uint64(1)).sum(dtype=np.int64) for i in range(64)])
    middle = ((2 * ones > len(v)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(dtype=np.uint64)
    # searches begin next to the middle of the group, so that all groups with the same members find mostly the same links
    left, a, b = np.lexsort((v, np.bitwise_count(v ^ middle))), [], []
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            hit = near(v[left] ^ v[x], tests)
            if len(hit):
                got = left[hit]
                a += [int(x)] * len(got)
                b += got.tolist()
                todo += list(got)
                left = np.delete(left, hit)
    return a, b


def tree(v: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of links between rows of v, those that connect as much as all do, the nearest first."""
    if not len(a):
        return a, b
    _, node = np.unique(v, return_inverse=True)
    x, y = np.minimum(node[a], node[b]), np.maximum(node[a], node[b])
    order = np.lexsort((y, x, np.bitwise_count(v[a] ^ v[b])))
    top: dict[int, int] = {}

    def root(i: int) -> int:
        while (j := top.get(i, i)) != i:
            top[i] = i = top.get(j, j)
        return i

    kept = []
    for i, p, q in zip(order.tolist(), x[order].tolist(), y[order].tolist(), strict=True):
        p, q = root(p), root(q)
        if p != q:
            top[q] = p
            kept.append(i)
    return a[kept], b[kept]


def linked(run: Iterator[pa.RecordBatch], limit: int = LIMIT) -> Iterator[pa.RecordBatch]:
    """Links inside the groups of a stream of (key, fingerprint) sorted by key; a group may go on in the next batch."""
    tests = [chain_masks(i, limit) for i in range(limit + 1)]

    def groups(k: np.ndarray, v: np.ndarray) -> pa.RecordBatch:
        edge = np.flatnonzero(np.diff(k)) + 1
        lo, hi = np.concatenate(([0], edge)), np.concatenate((edge, [len(k)]))
        size, start = hi - lo, (k[lo] >> np.uint64(48)).astype(int) & 0xFF
        a, b = [], []
        for n in np.unique(size[(size > 1) & (size <= SMALL)]):
            x, y = np.triu_indices(n, 1)
            for s in range(limit + 1):
                at = lo[(size == n) & (start == s)]
                for part in np.array_split(at, max(1, len(at) * len(x) // 1_000_000)):
                    p, q = (part[:, None] + x).ravel(), (part[:, None] + y).ravel()
                    ok = near(v[p] ^ v[q], tests[s])
                    a.append(p[ok])
                    b.append(q[ok])
        for g in np.flatnonzero(size > SMALL):
            p, q = forest(v[lo[g] : hi[g]], tests[start[g]])
            a.append(lo[g] + np.array(p, np.int64))
            b.append(lo[g] + np.array(q, np.int64))
        a, b = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (a, b))
        a, b = tree(v, a, b)
        # equal links of several groups become equal rows
        pair = np.unique(np.stack((np.minimum(v[a], v[b]), np.maximum(v[a], v[b])), axis=1), axis=0).view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(pair[:, 0]), pa.array(pair[:, 1])], names=["a", "b"])

    kept: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in run:
        if not batch.num_rows:
            continue
        k, v = (batch.column(i).to_numpy(zero_copy_only=False).view(np.uint64) for i in range(2))
        if kept and k[0] == k[-1] == kept[-1][0][-1]:
            kept.append((k, v))
            continue
        last = int(np.searchsorted(k.view(np.int64), k.view(np.int64)[-1]))  # the last group may go on
        kk, vv = np.concatenate([x for x, _ in kept] + [k[:last]]), np.concatenate([x for _, x in kept] + [v[:last]])
        kept = [(k[last:], v[last:])]
        if len(kk):
            yield groups(kk, vv)
    if kept:
        yield groups(np.concatenate([x for x, _ in kept]), np.concatenate([x for _, x in kept]))


def links(distinct: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Links (a, b) between distinct fingerprints (fp) that connect all that are near; copies of a fingerprint are not expanded."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for part in np.array_split(fp, max(1, len(fp) // 4096)):
                k, _ = keys(part, limit)
                yield pa.RecordBatch.from_arrays([pa.array(k.ravel().view(np.int64)), pa.array(np.repeat(part, k.shape[1]).view(np.int64))], names=["k", "fp"])

    dealt = distinct.select("fp").mapInArrow(emit, "k long, fp long").repartition("k").sortWithinPartitions("k")
    return dealt.mapInArrow(lambda run: linked(run, limit), "a long, b long").distinct()


def components(edges: DataFrame, most: int = 60) -> DataFrame:
    """node, label (the smallest node reachable) of the nodes with an edge (a, b), by alternating large-star and small-star steps; each step is a written table, and the one before it is removed."""
    e = common.written(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())

    def star(e: DataFrame, large: bool) -> DataFrame:
        """Large star: each node's larger neighbours go to its smallest; small star: its smaller ones and itself do."""
        both = e.union(e.select("v", "u")) if large else e
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        j = both.join(low, "u")
        out = j.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")) if large else j.select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    before = None
    for _ in range(most):
        step = common.written(star(star(e, True), False))
        common.drop(e)
        e = step
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("label"))
        before = now
    raise RuntimeError("the components did not settle")


def near_duplicates(docs: DataFrame, words: int = WORDS, limit: int = LIMIT) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links) of each row."""
    fps = common.written(fingerprints(docs, words))
    first = common.written(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    found = components(links(first, limit)).withColumnRenamed("node", "fp")
    named = common.written(first.join(found, "fp", "left").select("fp", "least", F.coalesce("label", "fp").alias("label")))
    lowest = named.groupBy("label").agg(F.min("least").alias("component_id"))
    final = named.join(lowest, "label").select("fp", "component_id")
    return fps.join(final, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
