"""Benchmark decontamination: one Aho-Corasick automaton over the normalised windows of test items, each text scanned once.

A text's words are runs of digits, letters and non-ASCII characters after lower-casing A-Z. A window is `size`
consecutive words of an item; an item with fewer words, but not none, is one window. Document words inside any
occurrence of a window are hit; hits are mapped back to character offsets of the original text.

The automaton's letters are words, by number: a window is at most `size` nodes deep, and words that no item has are one
letter that leads nowhere. It runs over the stretches of a text whose neighbouring words are neighbours in some window; no
window lies elsewhere. It is built on the executors from a broadcast block of items. A block holds at most
BLOCK_BYTES of item text (some 400,000 windows, about 300 MB as an automaton); a larger benchmark is scanned in several
blocks, whose hits are merged per document, so what is broadcast at once is bounded whatever the benchmark's size.

Defined results: null and empty texts have no words and no hits; items without words never occur; items with equal
windows are all reported; an item without an id hits like any other, but is not among the reported items; repeated rows and other columns are kept as they are, but a
column named as a new one gives way to it.
"""

from __future__ import annotations

import functools
import itertools
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.llm import common

SIZE = 10
#: Bytes of item text in a block.
BLOCK_BYTES = 2 << 20
#: Bytes of words, lower-cased; all others become a space.
WORD = bytes(common.LOWER[c] if 0x30 <= c <= 0x39 or 0x41 <= c <= 0x5A or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256))
SPAN = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: bytes) -> list[bytes]:
    return text.translate(WORD).split()


def windows(w: list, size: int = SIZE) -> set[tuple]:
    """The windows of an item's words."""
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


@functools.lru_cache(maxsize=2)
def automaton(items: tuple[tuple[str | None, bytes], ...], size: int):
    """Word numbers (from 1 on; 0 is every other word), the automaton over all windows, whose values are (words, item ids), the neighbouring words of windows as sorted codes, and the words of the shortest window."""
    import ahocorasick

    numbers: dict[bytes, int] = {}
    by: dict[tuple, list[str]] = {}
    for item, text in items:
        for w in windows([numbers.setdefault(x, len(numbers) + 1) for x in words(text)], size):
            ids = by.setdefault(w, [])
            if item is not None:
                ids.append(item)
    if not by:
        return None
    a = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
    for w, ids in by.items():
        a.add_word(w, (len(w), ids))
    a.make_automaton()
    beside = np.unique(np.array([x << 32 | y for w in by for x, y in itertools.pairwise(w)], np.int64))
    return numbers, a, beside, min(map(len, by))


def stretches(v: np.ndarray, beside: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Where windows can lie: [first, last + 1) of the longest runs of words whose neighbours are neighbours in some window (of known words, where one word can be a window)."""
    if least == 1:
        on = v > 0
    else:
        code = v[:-1] << 32 | v[1:]
        on = beside[np.minimum(np.searchsorted(beside, code), len(beside) - 1)] == code if len(beside) else np.zeros(len(code), bool)
    edge = np.diff(np.concatenate(([0], on.astype(np.int8), [0])))
    more = int(least > 1)
    for lo, hi in zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True):
        if hi + more - lo >= least:
            yield lo, hi + more


def scan(text: bytes, found) -> tuple[int, list[tuple[int, int]], set[str]]:
    """Number of words, runs of hit words as [first, last + 1), and the items that occur."""
    w = words(text)
    if not w or found is None:
        return len(w), [], set()
    numbers, a, beside, least = found
    v = np.fromiter(map(numbers.get, w, itertools.repeat(0)), np.int64, len(w))
    hits = [(lo + e, x) for lo, hi in stretches(v, beside, least) for e, x in a.iter(tuple(v[lo:hi].tolist()))]
    if not hits:
        return len(w), [], set()
    ends = np.array([e for e, _ in hits]) + 1
    delta = np.zeros(len(w) + 1, np.int32)
    np.add.at(delta, ends - [n for _, (n, _) in hits], 1)
    np.add.at(delta, ends, -1)
    on = np.diff(np.concatenate(([0], np.cumsum(delta[:-1]) > 0, [0])).astype(np.int8))
    return len(w), list(zip(np.flatnonzero(on == 1).tolist(), np.flatnonzero(on == -1).tolist(), strict=True)), {i for _, (_, ids) in hits for i in ids}


def blocks(bench: DataFrame, most: int = BLOCK_BYTES) -> Iterator[tuple[tuple[str | None, bytes], ...]]:
    """The items (item_id as string or None, text) in blocks of bounded size, one after another."""
    block, size = [], 0
    for r in bench.select(F.col("item_id").cast("string").alias("i"), F.encode("text", "UTF-8").alias("t")).where("t is not null").toLocalIterator():
        t = bytes(r.t)
        if block and size + len(t) > most:
            yield tuple(block)
            block, size = [], 0
        block.append((r.i, t))
        size += len(t)
    yield tuple(block)


def scanned(docs: DataFrame, bench: DataFrame, size: int = SIZE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with n_words, hit_runs (array of struct first, last: word numbers, last excluded), spans (array of struct start, end: code points of the hit runs) and items (sorted array of item ids)."""
    spark = docs.sparkSession
    common.ship(spark)
    new = T.StructType.fromDDL("n_words long, hit_runs array<struct<first:long,last:long>>, spans array<struct<start:long,end:long>>, items array<string>")
    if clash := [n for n in new.names if n in docs.columns]:
        docs = docs.drop(*clash)

    def over(items, docs: DataFrame) -> DataFrame:
        sent = spark.sparkContext.broadcast(items)
        schema = T.StructType(docs.schema.fields + new.fields)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            a = automaton(sent.value, size)
            for b in batches:
                n, runs, spans, ids = [], [], [], []
                for t in common.text_bytes(b.column(b.schema.get_field_index("text"))):
                    k, r, i = scan(t, a)
                    at = [m.span() for m in SPAN.finditer(t.decode())] if r else []
                    n.append(k)
                    runs.append([{"first": x, "last": y} for x, y in r])
                    spans.append([{"start": at[x][0], "end": at[y - 1][1]} for x, y in r])
                    ids.append(sorted(i))
                pairs = [pa.list_(pa.struct([(x, pa.int64()), (y, pa.int64())])) for x, y in (("first", "last"), ("start", "end"))]
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n, pa.int64()), pa.array(runs, pairs[0]), pa.array(spans, pairs[1]), pa.array(ids, pa.list_(pa.string()))], names=schema.names)

        return docs.mapInArrow(run, schema)

    read = blocks(bench, block_bytes)
    first, second = next(read), next(read, None)
    if second is None:
        return over(first, docs)
    row = f"row_{uuid.uuid4().hex}"
    numbered = common.written(docs.withColumn(row, F.monotonically_increasing_id()))
    # the driver has one block in hand at a time; what is sent out lies in files
    return merged(docs.columns, row, [over(b, numbered) for b in itertools.chain((first, second), read)])


def merged(columns: list[str], row: str, parts: list[DataFrame]) -> DataFrame:
    """The blocks' hits of each document together: only documents with hits travel, keyed by the row number."""
    base, more = parts[0], None
    for p in parts[1:]:
        hit = p.where(F.size("hit_runs") > 0).select(row, "hit_runs", "spans", "items")
        more = hit if more is None else more.unionByName(hit)
    more = more.groupBy(row).agg(F.flatten(F.collect_set("hit_runs")).alias("r2"), F.flatten(F.collect_set("spans")).alias("s2"), F.flatten(F.collect_set("items")).alias("i2"))
    j = base.join(more, row, "left")

    def joined(own: str, other: str, lo: str, hi: str):
        """Runs that touch or overlap become one; `last` and `end` are excluded, and runs that only touch stay apart in characters as in words."""
        both = F.array_sort(F.concat(own, F.coalesce(other, F.array().cast(dict(base.dtypes)[own]))))
        step = lambda acc, x: F.when((F.size(acc) > 0) & (x[lo] <= F.element_at(acc, -1)[hi]), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)[lo].alias(lo), F.greatest(F.element_at(acc, -1)[hi], x[hi]).alias(hi))))).otherwise(F.concat(acc, F.array(x)))
        return F.when(F.col(other).isNull(), F.col(own)).otherwise(F.aggregate(both, F.array().cast(dict(base.dtypes)[own]), step))

    return j.select(*[F.col(f"`{c}`") for c in columns], "n_words", joined("hit_runs", "r2", "first", "last").alias("hit_runs"), joined("spans", "s2", "start", "end").alias("spans"), F.array_sort(F.array_distinct(F.concat("items", F.coalesce("i2", F.array().cast("array<string>"))))).alias("items"))


def report(docs: DataFrame, bench: DataFrame, size: int = SIZE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans of each document."""
    s = scanned(docs.select("doc_id", "text"), bench, size, block_bytes)
    n_hit = F.aggregate("hit_runs", F.lit(0).cast("long"), lambda a, x: a + x["last"] - x["first"])
    return s.select("doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "spans")


def oracle(size: int = SIZE) -> str:
    """report() without spans in DuckDB SQL."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    norm = f"coalesce(regexp_extract_all(translate(text, '{upper}', '{lower}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+'), [])"
    return f"""
WITH i AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {norm} AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, n, array_to_string(win, ' ') AS win FROM (
 SELECT item_id, least(len(w), {size}) AS n, unnest(list_transform(range(1, greatest(len(w) - {size} + 1, 1) + 1), lambda k: w[k:k + {size} - 1])) AS win FROM i WHERE len(w) > 0)),
d AS (SELECT row_number() OVER () AS row, doc_id, {norm} AS w FROM documents),
places AS (SELECT row, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d CROSS JOIN (SELECT DISTINCT n FROM wins)),
hits AS (SELECT row, p, n, item_id FROM (SELECT row, p, n, array_to_string(w[p:p + n - 1], ' ') AS win FROM places) a JOIN wins USING (n, win)),
covered AS (SELECT row, count(DISTINCT q) AS n_hit FROM (SELECT row, unnest(range(p, p + n)) AS q FROM hits) GROUP BY row),
found AS (SELECT row, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT row, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY row)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (row) LEFT JOIN found USING (row)"""
