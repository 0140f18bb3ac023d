"""Quality rules: gradient-boosted trees over document statistics, as flat numpy node arrays, with monotonic constraints.

The statistics come from one pass over whole texts. The trees are fitted to at most SAMPLE labelled documents (those
with the smallest hash of doc_id; the bound is what makes the driver's share constant), with histogram splits; a split
that breaks its feature's constraint is not taken, and the middle between a constrained split's children bounds what is
below them. Scoring walks all rows of a batch down each tree at once.

Defined results: a null text has no words and fails the base rules; without labels of both kinds the method keeps what
the base rules keep; documents with several labels count once each; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm import common, tokens

SAMPLE = 10_000
TREES, DEPTH, RATE, BINS, LEAST, L2 = 60, 3, 0.2, 64, 8, 1.0
#: Documents are kept from this probability on.
KEEP = 0.5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower", "n_digits", "n_punct", "n_ends", "n_distinct")
#: Features and the direction in which they may move the verdict: -1 only down, 1 only up, 0 either.
FEATURES = {
    "mean_word": 0,
    "symbols": -1,
    "dup_lines": -1,
    "repeat_words": -1,
    "upper": -1,
    "digits": 0,
    "punct": -1,
    "ends": 0,
    "distinct": 0,
    "log_words": 0,
    "words_per_line": 0,
}
SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
PUNCT = np.isin(np.arange(256), list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"))
KIND = np.zeros(256, np.uint8)
KIND[65:91], KIND[97:123], KIND[48:58] = 1, 2, 3


def statistics(texts: list[bytes]) -> np.ndarray:
    """The COUNTS of each text (a row each)."""
    out = np.zeros((len(texts), len(COUNTS)), np.int64)
    for lo, hi, buf, starts, ends, doc, h in tokens.slices(texts):
        if hi - lo == 0:
            continue
        n = hi - lo
        row = out[lo:hi]
        row[:, 0] += np.bincount(doc, minlength=n)
        owner = tokens.owners(texts, lo, hi)
        for col, mask in ((1, ~tokens.SPACE[buf] & ((buf & 0xC0) != 0x80)), (2, SYMBOLS[buf]), (6, KIND[buf] == 1), (7, KIND[buf] == 2), (8, KIND[buf] == 3), (9, PUNCT[buf])):
            row[:, col] += np.bincount(owner[mask], minlength=n)
        last = buf[ends - 1] if len(ends) else buf[:0]
        row[:, 10] += np.bincount(doc[np.isin(last, list(b".!?"))], minlength=n)
        row[:, 4] += tokens.repeated(h, doc, n, 3)
        key = tokens.mix(h ^ tokens.mix(doc.astype(np.uint64)))
        row[:, 11] += np.bincount(doc[np.unique(key, return_index=True)[1]], minlength=n)
    for i, t in enumerate(texts):
        seen: set[bytes] = set()
        for line in t.split(b"\n"):
            if line and not line.isspace():
                out[i, 5] += 1
                if line in seen:
                    out[i, 3] += 1
                seen.add(line)
    return out


def features(c: np.ndarray) -> np.ndarray:
    """FEATURES of statistics() rows."""
    c = c.astype(np.float64)
    words, chars, lines, letters = np.maximum(c[:, 0], 1), np.maximum(c[:, 1], 1), np.maximum(c[:, 5], 1), np.maximum(c[:, 6] + c[:, 7], 1)
    return np.stack((chars / words, c[:, 2] / chars, c[:, 3] / lines, c[:, 4] / words, c[:, 6] / letters, c[:, 8] / chars, c[:, 9] / chars, c[:, 10] / words, c[:, 11] / words, np.log1p(c[:, 0]), words / lines), axis=1)


@dataclass
class Trees:
    """All trees' nodes in flat arrays: feature (-1 in a leaf), threshold (left if not above), children, value; roots by tree."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of each row: all rows walk down each tree together."""
        total, rows = np.full(len(x), self.bias), np.arange(len(x))
        for root in self.roots:
            at = np.full(len(x), root)
            while True:
                f = self.feature[at]
                inner = f >= 0
                if not inner.any():
                    break
                go = x[rows, np.maximum(f, 0)] <= self.threshold[at]
                at = np.where(inner, np.where(go, self.left[at], self.right[at]), at)
            total += self.value[at]
        return 1 / (1 + np.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, signs: tuple[int, ...], trees: int = TREES, depth: int = DEPTH) -> Trees:
    """Boosted trees for the log loss; deterministic."""
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    share = min(max(y.mean(), 1e-6), 1 - 1e-6)
    bias = float(np.log(share / (1 - share)))
    total, nodes, roots = np.full(len(y), bias), [], []

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, lo: float, hi: float, level: int) -> int:
        at = len(nodes)
        best = float(np.clip(-g[rows].sum() / (h[rows].sum() + L2), lo, hi))
        nodes.append([-1, 0.0, at, at, RATE * best])
        found = None
        if level < depth and len(rows) >= 2 * LEAST:
            gt, ht = g[rows].sum(), h[rows].sum()
            for j, e in enumerate(edges):
                if not len(e):
                    continue
                b = binned[rows, j]
                gs, hs, ns = (np.cumsum(np.bincount(b, w, len(e) + 1))[:-1] for w in (g[rows], h[rows], np.ones(len(rows))))
                wl, wr = np.clip(-gs / (hs + L2), lo, hi), np.clip(-(gt - gs) / (ht - hs + L2), lo, hi)
                gain = gs**2 / (hs + L2) + (gt - gs) ** 2 / (ht - hs + L2) - gt**2 / (ht + L2)
                ok = (ns >= LEAST) & (len(rows) - ns >= LEAST) & (signs[j] * (wr - wl) >= 0)
                if ok.any():
                    k = int(np.where(ok, gain, -np.inf).argmax())
                    if gain[k] > 1e-9 and (found is None or gain[k] > found[0]):
                        found = (gain[k], j, k, wl[k], wr[k])
        if found is None:
            total[rows] += RATE * best
            return at
        _, j, k, wl, wr = found
        go, mid = binned[rows, j] <= k, (wl + wr) / 2
        bounds = ((lo, hi), (lo, hi)) if not signs[j] else ((lo, mid), (mid, hi)) if signs[j] > 0 else ((mid, hi), (lo, mid))
        nodes[at][:2] = [j, float(edges[j][k])]
        nodes[at][2] = grow(rows[go], g, h, *bounds[0], level + 1)
        nodes[at][3] = grow(rows[~go], g, h, *bounds[1], level + 1)
        return at

    for _ in range(trees):
        p = 1 / (1 + np.exp(-total))
        roots.append(grow(np.arange(len(y)), p - y, np.maximum(p * (1 - p), 1e-9), -np.inf, np.inf, 0))
    f, t, a, b, v = (np.array(c) for c in zip(*nodes, strict=True))
    return Trees(f.astype(np.int64), t.astype(float), a.astype(np.int64), b.astype(np.int64), v.astype(float), np.array(roots), bias)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the COUNTS of each row."""
    common.ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = statistics(common.text_bytes(b.column(1)))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c[:, i]) for i in range(len(COUNTS)))], names=["doc_id", *COUNTS])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS))


def trained(counts: DataFrame, labels: DataFrame, most: int = SAMPLE) -> Trees | None:
    """Trees fitted to at most `most` labelled rows of measured(); None without labels of both kinds."""
    y = labels.where("doc_id is not null and quality is not null").select("doc_id", F.col("quality").cast("double").alias("quality"))
    # hashes are even: the smallest `most` lie below a bound, so only about twice as many rows are sorted
    below = F.xxhash64("doc_id") / float(1 << 64) + 0.5 <= (2.0 * most + 50) / max(1, y.count())
    rows = counts.join(y.where(below), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "quality", *COUNTS).limit(most).select(*COUNTS, "quality").toPandas()
    if rows["quality"].nunique() < 2:
        return None
    return fit(features(rows[list(COUNTS)].to_numpy()), (rows["quality"].to_numpy() > 0).astype(float), tuple(FEATURES.values()))


def report(docs: DataFrame, labels: DataFrame, most: int = SAMPLE, keep: float = KEEP) -> DataFrame:
    """doc_id, the statistics, base_failed, quality (the trees' probability) and kept of each row."""
    counts = common.written(measured(docs))
    sent = docs.sparkSession.sparkContext.broadcast(trained(counts, labels, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = np.stack([b.column(i + 1).to_numpy(zero_copy_only=False) for i in range(len(COUNTS))], axis=1)
            q = sent.value.score(features(c)) if sent.value else np.ones(len(c))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(q)], names=["doc_id", *COUNTS, "quality"])

    scored = counts.mapInArrow(run, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", quality double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return scored.select("doc_id", *COUNTS[:5], failed.alias("base_failed"), (~failed & (F.col("quality") >= keep)).alias("kept"), "quality")
