"""Suffix-array dedup with a logarithmic family of indexes.

Removed is each byte covered by a string of LONG bytes that also starts in a document with a smaller doc_id.

A suffix array of every position would be many times the corpus. Here it is sparse: each window of LONG bytes elects one
anchor (the least hash among its strings of GRAM bytes), so equal windows elect equal anchors at the same place in them,
and only suffixes that begin at anchors are kept. An entry is the suffix's first LONG bytes at most and what stands
before it, as far as windows that elect this anchor reach; entries are in byte order of their suffixes, then of what stands
before, read backwards. A window that begins k bytes before its anchor is in two entries where their suffixes agree in
LONG - k bytes and what stands before agrees in k: both are runs of a sorted order, found from the common prefixes of
neighbours. Bytes are compared, never hashes; a hash only says which range an anchor's entries meet in.

Documents come in generations by doc_id, each a new batch of the family. In each hash range a generation's entries are
sorted to an array, which is merge-scanned against the array of each existing level; whatever a level has is a match, as its documents
come before. Then the array becomes level 0, and two arrays of one level merge, in one linear pass, into the next. Levels
are tables, bucketed by range: the next generation reads them where they lie. `Family` keeps them for batches that come
later, `report` takes a whole table at once; there, anchors that one batch of texts alone has are not indexed.

Copies inside a batch of texts are found by the same arrays in the batch itself, and its equal entries travel once. An anchor
that HOT batches have is dealt by the second hash of its windows too, so no range gets all of a common string's surroundings.

Defined results: null and empty texts have no bytes; rows with one doc_id never match each other; a null doc_id counts
as larger than all others, and null ids never match each other; documents shorter than LONG are kept whole; other
columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm import batches, common, tokens

LONG, GRAM = 50, 24
WINDOW = LONG - GRAM + 1
#: Bytes looked at together; anchors' places must fit the low bits of their sort key.
PIECE_BITS = 20
#: Generations that report() cuts a table into.
GENERATIONS = 4
#: An anchor that this many batches of texts have is dealt to several ranges.
HOT = 256

_rng = np.random.default_rng(77)
_BYTE = _rng.integers(0, (1 << 64) - 1, 256, np.uint64, endpoint=True)
_STEP = _rng.integers(0, (1 << 64) - 1, 8, np.uint64, endpoint=True) | np.uint64(1)


def doubled(buf: np.ndarray, upto: int) -> list[np.ndarray]:
    """Hashes of all strings of 1, 2, 4 ... bytes, up to `upto`."""
    out = [_BYTE[buf]]
    for k in range(1, upto.bit_length()):
        h, half = out[-1], 1 << (k - 1)
        out.append(h[:-half] * _STEP[k] + h[half:] if len(h) > half else h[:0])
    return out


def string_hash(d: list[np.ndarray], n: int) -> np.ndarray:
    """Hashes of all strings of n bytes from doubled(); the binary digits of n name the pieces. Not mixed: that would only rename them."""
    total = len(d[0]) - n + 1
    if total <= 0:
        return d[0][:0]
    h, at = None, 0
    for k in range(n.bit_length() - 1, -1, -1):
        if n >> k & 1:
            piece = d[k][at : at + total]
            h, at = piece if h is None else h * _STEP[7] + piece, at + (1 << k)
    return h


def sliding_min(a: np.ndarray, w: int) -> np.ndarray:
    """Least value of each run of w values."""
    have = 1
    while 2 * have <= w:
        a, have = np.minimum(a[:-have], a[have:]), 2 * have
    return np.minimum(a[: len(a) - (w - have)], a[w - have :]) if w > have else a


def pieces(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (text, place in it, bytes) that fit one look; pieces of a long text overlap so that each window is in one of them."""
    most, group, total = (1 << PIECE_BITS) - 1, [], 0
    for i, t in enumerate(texts):
        for at in range(0, max(1, len(t) - LONG + 1), most - LONG + 1):
            part = t[at : at + most]
            if len(part) < LONG:
                continue
            if total + len(part) > most:
                yield group
                group, total = [], 0
            group.append((i, at, part))
            total += len(part)
    if group:
        yield group


def anchors(texts: list[bytes], again: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows with one anchor: anchor hash (mixed anew, as elected hashes are small), text, first and last window start in it, and the anchor's place. again: another election."""
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    low = np.uint64((1 << PIECE_BITS) - 1)
    for group in pieces(texts):
        sizes = np.array([len(p) for _, _, p in group])
        buf = np.frombuffer(b"".join(p for _, _, p in group), np.uint8)
        owner = np.repeat(np.arange(len(group)), sizes)
        g = string_hash(doubled(buf, GRAM), GRAM)
        g = tokens.mix(g) if again else g
        least = sliding_min((g & ~low) | np.arange(len(g), dtype=np.uint64), WINDOW)
        s = np.flatnonzero(owner[: len(buf) - LONG + 1] == owner[LONG - 1 :])
        a = (least[s] & low).astype(np.int64)
        new = np.concatenate(([True], (np.diff(a) != 0) | (np.diff(s) != 1)))
        first = np.flatnonzero(new)
        last = np.concatenate((first[1:], [len(s)])) - 1
        at = owner[s[first]]
        shift = np.array([p for _, p, _ in group])[at] - (np.cumsum(sizes) - sizes)[at]
        for x, y in zip(out, (tokens.mix(g[a[first]]), np.array([i for i, _, _ in group])[at], s[first] + shift, s[last] + shift, a[first] + shift), strict=True):
            x.append(y)
    return tuple(np.concatenate(x) if x else np.zeros(0, d) for x, d in zip(out, (np.uint64, np.int64, np.int64, np.int64, np.int64), strict=True))


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """starts[i], starts[i] + 1, ... counts[i] values each, one after another."""
    total = int(counts.sum())
    base = np.repeat(starts - (np.cumsum(counts) - counts), counts)
    return base + np.arange(total)


class Entries(NamedTuple):
    """Suffixes at anchors: document, bytes before the anchor and from it on, and these bytes: the suffix (LONG columns) and what stands before it, backwards (WINDOW - 1 columns), filled up with zeros."""

    doc: np.ndarray
    left: np.ndarray
    right: np.ndarray
    suffix: np.ndarray
    before: np.ndarray

    def take(self, i: np.ndarray) -> Entries:
        return Entries(*(x[i] for x in self))

    def keys(self) -> np.ndarray:
        """Strings in the order of the entries; the last byte is never zero."""
        return np.ascontiguousarray(np.hstack((self.suffix, self.before, self.right[:, None], self.left[:, None] + np.uint8(1)))).view(f"S{LONG + WINDOW + 1}").ravel()

    def packed(self) -> bytes:
        size = self.left.astype(np.int64) + self.right
        both = np.hstack((self.before[:, ::-1], self.suffix))
        raw = both.ravel()[spread(np.arange(len(size)) * both.shape[1] + WINDOW - 1 - self.left, size)] if len(size) else both.ravel()
        return common.pack(self.doc, self.left, self.right, raw)


def entries(buf: np.ndarray, doc: np.ndarray, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> Entries:
    """Entries with anchors at places of buf."""
    suffix, before = np.zeros((len(at), LONG), np.uint8), np.zeros((len(at), WINDOW - 1), np.uint8)
    for lo in range(0, len(at), 50_000):
        own = slice(lo, lo + 50_000)
        for out, n, place in ((suffix, right, at[own, None] + np.arange(LONG)), (before, left, at[own, None] - 1 - np.arange(WINDOW - 1))):
            out[own] = np.where(np.arange(out.shape[1]) < n[own, None], buf[np.clip(place, 0, len(buf) - 1)], 0)
    return Entries(doc, left.astype(np.uint8), right.astype(np.uint8), suffix, before)


def unpacked(blobs: list[bytes]) -> Entries:
    """Entries of several blobs, one after another."""
    doc, left, right, raw = (np.concatenate(x) for x in zip(*map(common.unpack, blobs), strict=True))
    size = left.astype(np.int64) + right
    return entries(raw, doc, left, right, np.cumsum(size) - size + left)


def numbers(rows: np.ndarray) -> list[np.ndarray]:
    """Columns of bytes as big-endian numbers, eight bytes each."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    return list(wide.view(">u8").astype(np.uint64).T)


def byte_order(e: Entries) -> np.ndarray:
    """The order of keys()."""
    ends = e.right.astype(np.int64) << 8 | e.left
    return np.lexsort((ends, *reversed(numbers(e.before)), *reversed(numbers(e.suffix))))


def common_prefix(rows: np.ndarray) -> np.ndarray:
    """Length of the common prefix of each row with the next."""
    differ = rows[1:] != rows[:-1]
    return np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])


def runs_of(first: np.ndarray) -> np.ndarray:
    """Numbers of runs, from whether each place after the first begins one."""
    return np.concatenate(([0], np.cumsum(first)))


def scanned(e: Entries, rank: np.ndarray) -> np.ndarray:
    """Of entries in byte order: which windows (a column for each number of bytes before the anchor) another entry with a smaller rank has too."""
    hit = np.zeros((len(e.doc), WINDOW), bool)
    if len(e.doc) < 2:
        return hit
    gram = runs_of(common_prefix(e.suffix[:, :GRAM]) < GRAM)
    edge = np.flatnonzero(np.diff(gram, prepend=-1))
    on = np.flatnonzero((np.minimum.reduceat(rank, edge) < np.maximum.reduceat(rank, edge))[gram])
    if not len(on):
        return hit
    e, rank = e.take(on), rank[on]
    after = common_prefix(e.suffix)
    order = np.lexsort(tuple(reversed(numbers(e.before))))
    ahead = common_prefix(e.before[order])
    for k in range(WINDOW):
        have = np.flatnonzero((e.left >= k) & (e.right >= LONG - k))
        if not len(have):
            continue
        side = np.empty(len(on), np.int64)
        side[order] = runs_of(ahead < k)
        key = runs_of(after < LONG - k)[have] * len(on) + side[have]
        by = np.argsort(key)
        first = np.flatnonzero(np.diff(key[by], prepend=-1))
        r = rank[have[by]]
        hit[on[have[by]], k] = np.repeat(np.minimum.reduceat(r, first), np.diff(np.append(first, len(by)))) < r
    return hit


def once(e: Entries) -> tuple[Entries, np.ndarray]:
    """Of entries in byte order, each different one with its smallest doc; and which of them each entry is."""
    if not len(e.doc):
        return e, np.zeros(0, np.int64)
    k = e.keys()
    run = runs_of(k[1:] != k[:-1])
    first = np.flatnonzero(np.diff(run, prepend=-1))
    return e.take(first)._replace(doc=np.minimum.reduceat(e.doc, first)), run


def merged(a: Entries, b: Entries) -> tuple[Entries, np.ndarray]:
    """Two arrays in byte order as one, and where each entry comes from (places in a, then in b). A stable sort finds the two runs and merges them in one pass."""
    order = np.argsort(np.concatenate((a.keys(), b.keys())), kind="stable")
    return Entries(*(np.concatenate(x)[order] for x in zip(a, b, strict=True))), order


def carried(levels: dict[int, Entries], array: Entries) -> dict[int, Entries]:
    """Levels with a new array: level i holds 2**i batches or nothing, and two equal levels merge into the next."""
    levels, i = dict(levels), 0
    while i in levels:
        array, i = once(merged(levels.pop(i), array)[0])[0], i + 1
    return levels | {i: array}


class Batch:
    """What each pass needs of a batch, in the same order each time."""

    def __init__(self, blob: bytes) -> None:
        self.ids, self.nulls, _, texts = batches.opened(blob)
        self.texts = texts
        self.start = np.concatenate(([0], np.cumsum([len(t) for t in texts])))
        self.buffer = np.frombuffer(b"".join(texts), np.uint8)
        self.h, self.text, self.first, self.last, self.at = anchors(texts)
        self.keys, self.key, order, edge = tokens.distinct(self.h)
        ids = self.ids[self.text[order]]
        self.own = np.minimum.reduceat(ids, edge) < np.maximum.reduceat(ids, edge) if len(edge) else np.zeros(0, bool)

    def told(self, by: dict[int, bytes], parts: int) -> np.ndarray:
        """Which anchors ranges say something of."""
        on = np.zeros(len(self.keys), bool)
        for k, lo, hi in batches.slices_of(self.keys, parts):
            if k in by:
                on[lo:hi] = np.unpackbits(np.frombuffer(by[k], np.uint8), count=hi - lo)
        return on

    def indexed(self, by: dict, parts: int, closed: bool) -> tuple[Entries, np.ndarray, np.ndarray, np.ndarray]:
        """Entries in byte order of the runs whose anchor several documents have (all runs where the table is not closed), with their anchors' places in the buffer, the ranges they go to, and whether they go at all."""
        shared = self.told(by.get("shared", {}), parts) if closed else np.ones(len(self.keys), bool)
        runs = np.flatnonzero((shared | self.own)[self.key])
        hot = self.told(by.get("hot", {}), parts)[self.key[runs]]
        h, text, first, last, at, sent = self.h[runs], self.text[runs], self.first[runs], self.last[runs], self.at[runs], shared[self.key[runs]]
        if hot.any():
            far = np.flatnonzero(hot)
            strings = [self.texts[t][f : n + LONG] for t, f, n in zip(text[far].tolist(), first[far].tolist(), last[far].tolist(), strict=True)]
            h2, s, f2, n2, _ = anchors(strings, again=True)
            s = far[s]
            near = np.flatnonzero(~hot)
            join = lambda x, y: np.concatenate((x[near], y))
            h, text, first, last, at, sent = join(h, tokens.mix(h[s] ^ h2)), join(text, text[s]), join(first, first[s] + f2), join(last, first[s] + n2), join(at, at[s]), join(sent, sent[s])
        place = self.start[text] + at
        e = entries(self.buffer, self.ids[text], at - first, last + LONG - at, place)
        order = byte_order(e)
        return e.take(order), place[order], batches.parts_of(h[order], parts), sent[order]

    def asked(self, by: dict, parts: int, closed: bool) -> tuple[Entries, np.ndarray, np.ndarray, Entries, np.ndarray, np.ndarray]:
        """indexed() entries and places; which of the different entries each is; these, their ranges, and whether they are sent."""
        e, place, part, sent = self.indexed(by, parts, closed)
        unique, run = once(e)
        first = np.flatnonzero(np.diff(run, prepend=-1))
        return e, place, run, unique, part[first], sent[first]


def wanted(table: DataFrame, parts: int, hot: int = HOT) -> DataFrame:
    """What ranges say of anchors: `shared` by several batches, and `hot` ones."""

    def ask(batch: int, blob: bytes) -> list[tuple[int, int, str, bytes]]:
        keys = Batch(blob).keys
        return [(batch, k, "anchors", common.pack(keys[lo:hi])) for k, lo, hi in batches.slices_of(keys, parts)]

    def several(part: int, got: list[tuple[int, str, bytes]]) -> list[tuple[int, int, str, bytes]]:
        arrays = [common.unpack(blob)[0] for _, _, blob in got]
        key, times = np.unique(np.concatenate(arrays), return_counts=True)
        out = []
        for kind, least in (("shared", 2), ("hot", hot)):
            chosen = key[times >= least]
            masks = [np.isin(a, chosen, assume_unique=True) for a in arrays] if len(chosen) else []
            out += [(b, part, kind, np.packbits(m).tobytes()) for (b, _, _), m in zip(got, masks, strict=False) if m.any()]
        return out

    return batches.answered(batches.asked(table, ask), several)


def taken(table: DataFrame, told: DataFrame, before: DataFrame | None, parts: int, closed: bool, keep: bool, number: int | None = None) -> DataFrame:
    """One generation (a table of batches): its marks against itself and the levels before, and, if they are to be kept, the levels with it. With its number, only levels that it changes (and which it empties, as `gone`) are kept, as batch -number; of several tables before, the highest number holds for each level."""

    def contexts(batch: int, blob: bytes, by: dict) -> pa.Table:
        _, _, _, e, part, sent = Batch(blob).asked(by, parts, closed)
        rows = []
        for k in np.unique(part[sent]):
            rows.append((batch, int(k), "contexts", e.take(np.flatnonzero((part == k) & sent)).packed()))
        return batches.messages(rows)

    def scan(part: int, got: list[tuple[int, str, bytes]], old: list[tuple[int, str, bytes]]) -> list[tuple[int, int, str, bytes]]:
        newest: dict[int, tuple[str, bytes]] = {}
        for _, kind, blob in old:  # the highest number first
            newest.setdefault(int(kind.lstrip("levgon")), (kind, blob))
        levels = {i: unpacked([blob]) for i, (kind, blob) in newest.items() if kind.startswith("level")}
        out, array = [], None
        if got:
            e = unpacked([blob for _, _, blob in got])
            order = byte_order(e)
            e = e.take(order)
            hit = scanned(e, e.doc)
            array, run = once(e)
            for level in levels.values():
                both, source = merged(level, array)
                own = source >= len(level.doc)
                new = np.zeros((len(array.doc), WINDOW), bool)
                new[source[own] - len(level.doc)] = scanned(both, own.astype(np.int8))[own]
                hit |= new[run]
            back = np.empty_like(hit)
            back[order] = hit
            lo = 0
            for batch, _, blob in got:
                n = len(common.unpack(blob)[0])
                if back[lo : lo + n].any():
                    out.append((batch, part, "marks", common.pack(np.packbits(back[lo : lo + n]))))
                lo += n
        if keep:
            now = carried(levels, array) if array is not None else levels
            changed = now if number is None else {i: a for i, a in now.items() if a is not levels.get(i)}
            out += [(-(number or 1), part, f"level{i}", a.packed()) for i, a in changed.items()]
            out += [(-number, part, f"gone{i}", b"") for i in levels.keys() - now.keys()] if number else []
        return out

    return batches.continued(batches.together(table, told, contexts, batches.MESSAGE), before, scan)


def finished(table: DataFrame, answers: DataFrame, parts: int, closed: bool, kept: bool) -> DataFrame:
    """Each row's result from the marks of all generations."""

    def remove(_: int, blob: bytes, by: dict) -> pa.Table:
        b = Batch(blob)
        size, change = len(b.buffer), np.zeros(len(b.buffer) + 1, np.int32)
        e, place, run, unique, part, sent = b.asked(by, parts, closed)
        hit = scanned(e, e.doc)
        marks = np.zeros((len(unique.doc), WINDOW), bool)
        for k, m in by.get("marks", {}).items():
            own = np.flatnonzero((part == k) & sent)
            marks[own] = np.unpackbits(common.unpack(m)[0], count=len(own) * WINDOW).reshape(len(own), WINDOW)
        hit |= marks[run]
        i, k = np.nonzero(hit)
        starts = np.bincount(place[i] - k, minlength=size + 1)
        change[:] = starts[: size + 1]
        change[LONG:] -= starts[: size + 1 - LONG].astype(np.int32) if size >= LONG else change[LONG:]
        off = np.cumsum(change[:-1]) > 0
        rows = []
        for i in range(len(b.texts)):
            own = slice(int(b.start[i]), int(b.start[i + 1]))
            gone, n = off[own], int(b.start[i + 1] - b.start[i])
            removed = int(gone.sum())
            left = b.buffer[own][~gone].tobytes() if removed else b.texts[i]
            spans = int(gone[0]) + int((gone[1:] > gone[:-1]).sum()) if n else 0
            rows.append((None if b.nulls[i] else int(b.ids[i]), n, removed, spans, hashlib.sha256(left).hexdigest(), *([left] if kept else [])))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())[: len(names)]
        return pa.table([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if kept else "")
    names = [x.split()[0] for x in schema.split(", ")]
    return batches.together(table, answers, remove, schema)


class Family:
    """Levels for tables of documents that come one after another: each is scanned against all that came before.

    Every table writes the levels that it changes, and no others: n tables write n log n, not n squared. Tables that later ones
    have replaced altogether are forgotten. All are bucketed by range, so a scan reads them where they lie. parts: hash ranges; about as many as
    the tables to come have RANGE bytes, as a task holds the levels of one range.
    """

    def __init__(self, parts: int = 1024) -> None:
        self.parts, self.number, self.tables = parts, 0, {}

    def add(self, docs: DataFrame, size: int = batches.SIZE, kept: bool = True) -> DataFrame:
        """The columns of report() for new documents: removed is what an earlier table has, or a smaller doc_id of this one. The levels then hold this table, too."""
        table = batches.split(docs.select("doc_id", "text", F.lit(False).alias("flag")), size)
        none = docs.sparkSession.createDataFrame([], batches.MESSAGE)
        self.number += 1
        done = taken(table, none, self.stored(), self.parts, closed=False, keep=True, number=self.number)
        self.tables[self.number] = done
        used = {-r.batch for r in self.newest().select("batch").distinct().collect()}  # a row a table
        self.tables = {n: t for n, t in self.tables.items() if n in used}
        return finished(table, done.where("kind = 'marks'"), self.parts, closed=False, kept=kept)

    def stored(self) -> DataFrame | None:
        """MESSAGE rows of all tables: levels, and which were emptied."""
        return reduce(DataFrame.unionByName, [t.where("kind <> 'marks'") for t in self.tables.values()]) if self.tables else None

    def newest(self) -> DataFrame:
        """part, level, batch (the number of the table that says so, negative) and kind of what holds."""
        level = F.regexp_extract("kind", r"([0-9]+)$", 1).cast("int")
        return self.stored().select("part", level.alias("level"), "batch", "kind").groupBy("part", "level").agg(F.min("batch").alias("batch"), F.min_by("kind", "batch").alias("kind"))

    def levels(self) -> DataFrame | None:
        """batch, part, kind (`level0`, `level1` ...), blob of the levels that hold something."""
        return self.stored().join(self.newest().drop("level"), ["part", "batch", "kind"], "left_semi").where("kind like 'level%'") if self.tables else None


def report(docs: DataFrame, size: int = batches.SIZE, range_size: int = batches.RANGE, generations: int = GENERATIONS, kept: bool = True, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the bytes that stay) of each row."""
    ids = docs.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null")
    cuts = sorted(set(ids.approxQuantile("doc_id", [i / generations for i in range(1, generations)], 0.01)))
    turn = sum((F.coalesce(F.col("doc_id") > F.lit(int(c)), F.lit(True)).cast("int") for c in cuts), F.lit(0))
    table = batches.split(docs.select("doc_id", "text", F.lit(False).alias("flag"), turn.alias("turn")), size)
    parts = batches.ranges(table, range_size)
    told = wanted(table, parts, hot)
    levels, marks = None, told.where("kind <> 'anchors'")
    for i in range(len(cuts) + 1):
        done = taken(table.where(F.col("turn") == i), told, levels, parts, closed=True, keep=i < len(cuts))
        levels, marks = done.where("kind like 'level%'"), marks.unionByName(done.where("kind = 'marks'"))
    return finished(table, marks, parts, closed=True, kept=kept)
