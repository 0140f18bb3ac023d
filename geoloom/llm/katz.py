"""Language-model scoring by a Katz backoff bigram model.

Counts come from all training texts. An n-gram seen r times (r up to K) keeps the share that Good-Turing leaves it; what
is taken off goes to the lower order: P(w | h) = d(r) r / c(h) for a seen pair, else a(h) P(w), with a(h) such that the
probabilities of all words after h add up to one exactly. Unigrams are discounted likewise, and what they give up is the
probability of an unknown word (all unknown words are one class). A text's first word follows a start sign, and an end
sign follows its last.

Where Good-Turing's formula leaves its range (an empty count of counts in small tables), half a count is taken off
instead. A context whose discounts take nothing off (all counts above K) gives up 1 / (c(h) + 1).

Tables are partitioned by a hash of the context: batches of documents send each hash range their pairs with counts, the
range adds them up and writes, for each batch, the totals, and for each context its count, its counts of counts and the
unigram mass of what followed it. A context that training texts have more often than a range has tokens on average is
dealt in shares, by a hash of the word that follows, so no range gets a hot context whole; its figures are sums over
the shares. Documents are scored in their batch from these: pair, else context weight times word.

Defined results: a null or empty text is scored as its end sign alone; rows with a null doc_id are scored, not learned
from, and not held out; with no training text at all every token is unknown with probability one; repeated rows count
as often as they come; other columns are not read.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm import batches, common, tokens

K = 5
SIZE = 10 << 20
START, END = np.uint64(0x5354415254000001), np.uint64(0x454E440000000002)
STEP = np.uint64(0x9E3779B97F4A7C15)


def discounts(n: np.ndarray, k: int = K) -> np.ndarray:
    """Share d(r) that a count r = 1 ... k keeps, from the counts of counts n[1] ... n[k + 1]; d[0] is not used."""
    d = np.ones(k + 1)
    for r in range(1, k + 1):
        d[r] = (r - 0.5) / r
        if n[1] and n[r] and n[r + 1]:
            cut = (k + 1) * n[k + 1] / n[1]
            star = (r + 1) * n[r + 1] / n[r]
            if cut < 1 and 0 < (x := (star / r - cut) / (1 - cut)) < 1:
                d[r] = x
    return d


def kept(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Discounted counts."""
    return c * np.where(c < len(d), d[np.minimum(c, len(d) - 1)], 1.0)


class Unigrams:
    """Probabilities by training count. stats: tokens, types, then how many types have 1, 2 ... K + 1."""

    def __init__(self, stats: np.ndarray) -> None:
        self.total, self.types = int(stats[0]), int(stats[1])
        n = np.concatenate(([0], stats[2:]))
        self.d = discounts(n)
        r = np.arange(1, K + 1)
        off = float(((1 - self.d[1:]) * r * n[1 : K + 1]).sum())
        self.all = self.total if off > 0 else self.total + 1
        self.unknown = off / self.total if off > 0 else 1 / (self.total + 1)

    def p(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, kept(c, self.d) / max(self.all, 1), self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 1) / (self.total + self.types + 1))


class Batch:
    """A batch's tokens: ids into its sorted vocabulary, and those of the token (or start sign) before."""

    def __init__(self, blob: bytes) -> None:
        self.ids, self.nulls, self.train, texts = batches.opened(blob)
        hashes, owners = [], []
        for lo, hi, _, _, _, doc, h in tokens.slices(texts, lower=True):
            edge = np.cumsum(np.bincount(doc, minlength=hi - lo))
            hashes.append(np.insert(h, edge, END))
            owners.append(lo + np.insert(doc, edge, np.arange(hi - lo)))
        self.doc = np.concatenate(owners)
        h = np.concatenate(hashes)
        self.keys, at, _, _ = tokens.distinct(np.append(h, START))
        self.token, self.start = at[:-1], int(at[-1])
        self.before = np.concatenate(([0], self.token[:-1]))
        self.before[np.concatenate(([True], self.doc[1:] != self.doc[:-1]))] = self.start
        self.counted = self.train[self.doc]

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Different pairs by context and word: context, word, training count; and the pair of each token."""
        code, back, _, _ = tokens.distinct(self.before * len(self.keys) + self.token)
        return code // len(self.keys), code % len(self.keys), np.bincount(back, self.counted, len(code)).astype(np.int64), back

    def groups(self, context: np.ndarray, word: np.ndarray, c: np.ndarray, most: int) -> Groups:
        """The pairs' groups: contexts, or shares of those that training texts have more than `most` times. All shares of a context are there, with or without pairs of this batch."""
        times = c.copy()
        times[self.start] = c[np.searchsorted(self.keys, END)]  # as many starts as ends
        new = np.ones(len(context), bool)
        new[1:] = context[1:] != context[:-1]
        seen, own = context[new], np.cumsum(new) - 1
        shares = 1 + times[seen] // most
        first = np.cumsum(shares) - shares
        parent = np.repeat(np.arange(len(seen)), shares)
        share = np.arange(len(parent)) - first[parent]
        key = self.keys[seen][parent]
        key = np.where(share == 0, key, tokens.mix(key + share.astype(np.uint64) * STEP))
        order = np.argsort(key)
        place = np.empty(len(key), np.int64)
        place[order] = np.arange(len(key))
        group = place[first[own] + (tokens.mix(self.keys[word]) % shares[own].astype(np.uint64)).astype(np.int64)]
        size = np.bincount(group, minlength=len(key))
        return Groups(key[order], parent[order], size, np.concatenate(([0], np.cumsum(size))), np.argsort(group, kind="stable"), own)


class Groups(NamedTuple):
    """Keys (ascending), the context of each, its pairs in the batch and where they begin; the pairs in this order; the context of each pair."""

    key: np.ndarray
    parent: np.ndarray
    size: np.ndarray
    edge: np.ndarray
    order: np.ndarray
    own: np.ndarray


def small(a: np.ndarray) -> np.ndarray:
    """Counts in the least of 1, 4 or 8 bytes."""
    top = a.max(initial=0)
    return a.astype(np.uint8 if top < 256 else np.int32 if top < 1 << 31 else np.int64)


def counts_of_counts(c: np.ndarray) -> np.ndarray:
    return np.bincount(c[c <= K + 1], minlength=K + 2)[1 : K + 2]


def summed(table: DataFrame, kind: str, width: int) -> np.ndarray:
    """Sum of the arrays that hash ranges report under a kind."""

    def run(rows):
        total = np.zeros(width, np.int64)
        for b in rows:
            for blob in b.column(0).to_pylist():
                total += common.unpack(blob)[0]
        yield pa.RecordBatch.from_arrays([pa.array([i for i in range(width)]), pa.array(total)], names=["i", "n"])

    rows = table.where(F.col("kind") == kind).select("blob").mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(width, np.int64)
    for r in rows:
        out[r.i] = r.n
    return out


def looked_up(keys: np.ndarray, by: dict[int, bytes], parts: int) -> np.ndarray:
    """Totals of a batch's keys from the ranges' answers."""
    out = np.zeros(len(keys), np.int64)
    for k, lo, hi in batches.slices_of(keys, parts):
        out[lo:hi] = common.unpack(by[k])[0]
    return out


def report(docs: DataFrame, train: Column, size: int = SIZE, range_size: int = batches.RANGE) -> DataFrame:
    """doc_id, train (whether learned from), n_tokens, n_known, train_tokens, base_score, score of each row. train: which rows to learn from."""
    table = batches.split(docs.select("doc_id", "text", (F.col("doc_id").isNotNull() & F.coalesce(train, F.lit(False))).alias("flag")), size)
    parts = batches.ranges(table, range_size)

    def ask_words(batch: int, blob: bytes) -> list[tuple[int, int, str, bytes]]:
        b = Batch(blob)
        c = np.bincount(b.token, b.counted, len(b.keys)).astype(np.int64)
        return [(batch, k, "words", common.pack(b.keys[lo:hi], small(c[lo:hi]))) for k, lo, hi in batches.slices_of(b.keys, parts)]

    def add_words(part: int, got: list[tuple[int, str, bytes]]) -> list[tuple[int, int, str, bytes]]:
        every = [common.unpack(blob) for _, _, blob in got]
        key, back = np.unique(np.concatenate([k for k, _ in every]), return_inverse=True)
        total = np.bincount(back, np.concatenate([c for _, c in every])).astype(np.int64)
        stats = np.concatenate(([total.sum(), (total > 0).sum()], counts_of_counts(total)))
        parts_back = np.split(total[back], np.cumsum([len(k) for k, _ in every])[:-1])
        return [(-1, part, "word_stats", common.pack(stats)), *((b, part, "counts", common.pack(small(c))) for (b, _, _), c in zip(got, parts_back, strict=True))]

    words = batches.answered(batches.asked(table, ask_words), add_words)
    one = Unigrams(summed(words, "word_stats", K + 3))
    counts = words.where(F.col("kind") == "counts")
    most = max(1, one.total // parts)

    def ask_pairs(batch: int, blob: bytes, by: dict) -> pa.Table:
        b = Batch(blob)
        c = looked_up(b.keys, by["counts"], parts)
        context, word, n, _ = b.pairs()
        g = b.groups(context, word, c, most)
        word, n = word[g.order], n[g.order]
        rows = []
        for k, lo, hi in batches.slices_of(g.key, parts):
            own = slice(int(g.edge[lo]), int(g.edge[hi]))
            rows.append((batch, k, "pairs", common.pack(g.key[lo:hi], small(g.size[lo:hi]), b.keys[word[own]] >> np.uint64(16), small(n[own]), small(np.where(n[own] > 0, c[word[own]], 0)))))
        return batches.messages(rows)

    def add_pairs(part: int, got: list[tuple[int, str, bytes]]) -> list[tuple[int, int, str, bytes]]:
        every = [common.unpack(blob) for _, _, blob in got]
        context, where = np.unique(np.concatenate([e[0] for e in every]), return_inverse=True)
        owner = np.repeat(where, np.concatenate([e[1] for e in every]))
        word, n, c = (np.concatenate([e[i] for e in every]) for i in (2, 3, 4))
        key = tokens.mix(context[owner] ^ tokens.mix(word))
        _, first, back = np.unique(key, return_index=True, return_inverse=True)
        total = np.bincount(back, n).astype(np.int64)
        in_word = np.zeros(len(first), np.int64)
        np.maximum.at(in_word, back, c.astype(np.int64))
        on = total > 0
        at = owner[first][on]
        mass = np.bincount(at, one.p(in_word[on]), len(context))
        after = np.bincount(at, total[on], len(context)).astype(np.int64)
        by_count = [np.bincount(at[total[on] == r], minlength=len(context)) for r in range(1, K + 1)]
        out = [(-1, part, "pair_stats", common.pack(counts_of_counts(total)))]
        lo = ctx = 0
        for (b, _, _), e in zip(got, every, strict=True):
            own, here = slice(lo, lo + len(e[2])), where[ctx : ctx + len(e[0])]
            out.append((b, part, "totals", common.pack(small(total[back[own]]), small(after[here]), mass[here], *(small(x[here]) for x in by_count))))
            lo, ctx = own.stop, ctx + len(e[0])
        return out

    pairs = batches.answered(batches.together(table, counts, ask_pairs, batches.MESSAGE), add_pairs)
    d = discounts(np.concatenate(([0], summed(pairs, "pair_stats", K + 1))))

    def score(_: int, blob: bytes, by: dict) -> pa.Table:
        b = Batch(blob)
        c = looked_up(b.keys, by["counts"], parts)
        context, word, _, back = b.pairs()
        g = b.groups(context, word, c, most)
        totals, after, mass, counted = [], [], [], []
        for k, _, _ in batches.slices_of(g.key, parts):
            t, a, m, *r = common.unpack(by["totals"][k])
            totals.append(t.astype(np.int64))
            after.append(a.astype(np.int64))
            mass.append(m)
            counted.append(np.stack(r).astype(np.int64))
        total = np.empty(len(context), np.int64)
        total[g.order] = np.concatenate(totals)
        after, mass = (np.bincount(g.parent, np.concatenate(x)) for x in (after, mass))
        counted = np.stack([np.bincount(g.parent, x) for x in np.concatenate(counted, axis=1)])
        off = ((1 - d[1:, None]) * np.arange(1, K + 1)[:, None] * counted).sum(axis=0)
        plain = off <= 0
        denominator = np.where(plain, after + 1, after)
        weight = np.where(after > 0, np.where(plain, 1 / (after + 1), off / np.maximum(after, 1)) / np.maximum(1 - mass, one.unknown), 1.0)
        pair_p = kept(total, d) / denominator[g.own]
        at, r = g.own[back], total[back]
        p = np.where(r > 0, pair_p[back], weight[at] * one.p(c)[b.token])
        n = len(b.ids)
        columns = [
            pa.array([None if x else i for i, x in zip(b.ids.tolist(), b.nulls.tolist(), strict=True)], pa.int64()),
            pa.array(b.train), pa.array(np.bincount(b.doc, minlength=n)), pa.array(np.bincount(b.doc, c[b.token] > 0, n).astype(np.int64)), pa.array(np.full(n, one.total)),
            pa.array(np.bincount(b.doc, one.base(c)[b.token], n)), pa.array(np.bincount(b.doc, np.log10(p), n)),
        ]
        return pa.table(columns, names=["doc_id", "train", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    answers = counts.unionByName(pairs.where(F.col("kind") == "totals"))
    return batches.together(table, answers, score, "doc_id long, train boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def held_out(parts: int = 7, out: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == out, F.lit(False))
