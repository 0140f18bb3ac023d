"""Language ID by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary. A word's probability is the sum over all
its segmentations into pieces (forward algorithm), a text's is the product over its words, and the language with the
largest is predicted; the score is its posterior under equal priors.

Words are runs of letters, lower-cased, with a space before them, in UTF-8, of any length: words up to SHORT bytes are
summed together in one table, longer ones (scripts without spaces) one by one in logarithms, which gives the same sum
without underflow. Every single byte is a piece, so every word has a segmentation. The piece probabilities are fitted by expectation
maximisation to the words of at most SAMPLE labelled texts of each language (those with the smallest hash of doc_id);
each language in a task of its own, which has that many texts, of any length. The driver gets, and sends out, one number per piece and language.

Defined results: `und` with score 0 for a null text, a text without letters, or where no labelled text exists; ties go
to the first language by name; rows without a language or doc_id are scored but never learned from; other columns are
kept, and one named like a new one gives way to it.
"""

from __future__ import annotations

import base64
import math
import re
from collections import Counter
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.llm import common

SAMPLE = 600
ROUNDS = 2
#: Longest word, in bytes, that is summed as plain numbers.
SHORT = 32
SMOOTH = 0.3
#: Tasks that languages are dealt to for fitting.
LANGS_AT_ONCE = 64
#: Words, and characters of words, whose probabilities a worker remembers; beyond either, the memory starts anew.
MEMORY, LETTERS_KEPT = 400_000, 1 << 24
VOCABULARY = "byte_bpe_multi_50k.tiktoken"
LETTERS = re.compile(r"[^\W\d_]+")


def pieces(path: str) -> list[bytes]:
    """Pieces made of letters (and a space before them), and every single byte."""
    ranks = [base64.b64decode(line.split()[0]) for line in Path(path).read_bytes().splitlines() if line.strip()]

    def fits(p: bytes) -> bool:
        body = p.removeprefix(b" ")
        return len(p) == 1 or bool(body) and not any(c < 0x61 or 0x7A < c < 0x80 for c in body)

    return sorted({p for p in ranks if fits(p)} | {bytes([c]) for c in range(256)})


def tree(found: list[bytes]) -> list:
    """Nested dictionaries by byte; each node is [piece or -1, children]."""
    root: list = [-1, {}]
    for i, p in enumerate(found):
        node = root
        for c in p:
            node = node[1].setdefault(c, [-1, {}])
        node[0] = i
    return root


def spelled(word: str) -> bytes:
    """A word as the pieces spell it: with a space before it."""
    return b" " + word.encode("utf-8", "replace")


def arcs(w: bytes, root: list) -> list[tuple[int, int, int]]:
    """All pieces inside w as (start, end, piece), by start."""
    out, n = [], len(w)
    for i in range(n):
        node, j = root, i
        while j < n and (node := node[1].get(w[j])):
            j += 1
            if node[0] >= 0:
                out.append((i, j, node[0]))
    return out


def forward(many: list[bytes], root: list, p: np.ndarray) -> np.ndarray:
    """Logarithm of each word's probability in each language: the sum over all segmentations, position by position for all short words together."""
    out, logs = np.zeros((len(many), p.shape[1])), np.log(p)
    short = [i for i, w in enumerate(many) if len(w) <= SHORT]
    for i, w in enumerate(many):
        if len(w) > SHORT:
            out[i] = long_forward(w, root, logs)
    at, end, piece, bounds = [], [], [], []
    for x in short:
        found = arcs(many[x], root)
        bounds.append(len(found))
        for i, j, x in found:
            at.append(i)
            end.append(j)
            piece.append(x)
    word = np.repeat(np.arange(len(short)), bounds)
    at, end, piece = (np.array(x, np.int64) for x in (at, end, piece))
    sums = np.zeros((len(short), SHORT + 1, p.shape[1]))
    sums[:, 0] = 1.0
    flat = sums.reshape(-1, p.shape[1])
    order = np.argsort(at, kind="stable")
    edge = np.searchsorted(at[order], np.arange(SHORT + 1))
    for i in range(SHORT):
        own = order[edge[i] : edge[i + 1]]
        if len(own):
            add, to = sums[word[own], i] * p[piece[own]], word[own] * (SHORT + 1) + end[own]
            for k in range(p.shape[1]):
                np.add.at(flat[:, k], to, add[:, k])
    out[short] = np.log(sums[np.arange(len(short)), [len(many[i]) for i in short]])
    return out


def long_forward(w: bytes, root: list, logs: np.ndarray) -> np.ndarray:
    """forward() for one word in logarithms; only the sums that a piece can still reach are held."""
    ahead = {0: np.zeros(logs.shape[1])}
    for i in range(len(w)):
        here, node, j = ahead.pop(i), root, i
        while j < len(w) and (node := node[1].get(w[j])):
            j += 1
            if node[0] >= 0:
                x = here + logs[node[0]]
                ahead[j] = np.logaddexp(ahead[j], x) if j in ahead else x
    return ahead[len(w)]


def expected(words: Counter, root: list, p: list[float]) -> list[float]:
    """Expected piece counts of one language's words under p, by forward and backward sums."""
    got, logs = [0.0] * len(p), [math.log(x) for x in p]
    for w, times in words.items():
        a, n = arcs(w, root), len(w)
        if n > SHORT:
            f, b = [-math.inf] * (n + 1), [-math.inf] * (n + 1)
            f[0] = b[n] = 0.0
            for i, j, x in a:
                f[j] = added(f[j], f[i] + logs[x])
            for i, j, x in reversed(a):
                b[i] = added(b[i], logs[x] + b[j])
            for i, j, x in a:
                got[x] += math.exp(f[i] + logs[x] + b[j] - f[n]) * times
            continue
        f, b = [0.0] * (n + 1), [0.0] * (n + 1)
        f[0] = b[n] = 1.0
        for i, j, x in a:
            f[j] += f[i] * p[x]
        for i, j, x in reversed(a):
            b[i] += p[x] * b[j]
        scale = times / f[n]
        for i, j, x in a:
            got[x] += f[i] * p[x] * b[j] * scale
    return got


def added(x: float, y: float) -> float:
    """Logarithm of the sum of two numbers given as logarithms."""
    hi, lo = max(x, y), min(x, y)
    return hi if lo == -math.inf else hi + math.log1p(math.exp(lo - hi))


def fitted(words: Counter, root: list, found: list[bytes], rounds: int = ROUNDS) -> list[float]:
    """Piece probabilities of one language."""
    p = [1 / 256 ** min(len(x), 3) if len(x) == 1 else 0.02 / len(found) * 50 for x in found]
    for _ in range(rounds + 1):
        got = np.array(expected(words, root, p)) + SMOOTH
        p = (got / got.sum()).tolist()
    return p


def fit(by: dict[str, Counter], found: list[bytes], rounds: int = ROUNDS) -> tuple[list[str], np.ndarray]:
    """Languages and their piece probabilities (a column each)."""
    root, langs = tree(found), sorted(by)
    return langs, np.array([fitted(by[lang], root, found, rounds) for lang in langs]).T


def sampled(docs: DataFrame, train: Column, most: int = SAMPLE) -> DataFrame:
    """lang, text of at most `most` labelled texts a language: those with the smallest hash of doc_id."""
    w = W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    able = docs.where(train & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & F.col("text").rlike(r"\p{L}")).select("doc_id", "lang")
    # hashes are even, so the smallest lie below a bound that the language's count gives: only about twice the sample is brought together
    counts = able.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    below = F.xxhash64("doc_id") / float(1 << 64) + 0.5 <= (2.0 * most + 50) / F.col("n")
    ids = able.join(F.broadcast(counts), "lang").where(below).withColumn("n", F.row_number().over(w)).where(F.col("n") <= most)
    return docs.select("doc_id", "lang", "text").join(F.broadcast(ids.select("doc_id", "lang").distinct()), ["doc_id", "lang"], "left_semi").select("lang", "text")


def learned(docs: DataFrame, train: Column, vocabulary: str, most: int = SAMPLE, rounds: int = ROUNDS) -> tuple[list[str], list[bytes], np.ndarray]:
    """Languages, pieces and probabilities, from labelled rows where train holds."""
    common.ship(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c: Counter = Counter()
            for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                c.update((lang, spelled(w)) for w in LETTERS.findall(text.lower()))
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in c], pa.string()), pa.array([k[1] for k in c], pa.binary()), pa.array(list(c.values()), pa.int64())], names=["lang", "word", "n"])

    counts = sampled(docs, train, most).mapInArrow(count, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    found = pieces(vocabulary)

    def one(key: tuple, t: pa.Table) -> pa.Table:
        words = Counter(dict(sorted(zip(map(bytes, t.column("word").to_pylist()), t.column("n").to_pylist(), strict=True))))
        return pa.table({"lang": [key[0].as_py()], "p": pa.array([fitted(words, tree(found), found, rounds)], pa.list_(pa.float64()))})

    # rows say nothing of the work: without a number of its own, languages would be fitted one after another in one task
    models = counts.repartition(LANGS_AT_ONCE, "lang").groupBy("lang").applyInArrow(one, "lang string, p array<double>").toArrow().sort_by("lang")
    langs = models.column("lang").to_pylist()
    return langs, found, np.array(models.column("p").to_pylist()).T if langs else np.zeros((len(found), 0))


def identified(docs: DataFrame, model: tuple[list[str], list[bytes], np.ndarray]) -> DataFrame:
    """docs with lang_pred and score (posterior of the prediction)."""
    spark = docs.sparkSession
    common.ship(spark)
    langs = model[0]
    sent = spark.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")
    schema = T.StructType([*docs.schema.fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, found, p = sent.value
        root, k = tree(found), len(langs)
        known: dict[str, int] = {}
        held = 0
        logs = np.zeros((1024, k))

        def learn(fresh: list[str]) -> None:
            nonlocal logs
            while len(known) + len(fresh) > len(logs):
                logs = np.concatenate((logs, np.zeros_like(logs)))
            for lo in range(0, len(fresh), 4096):
                part = fresh[lo : lo + 4096]
                logs[len(known) : len(known) + len(part)] = forward([spelled(w) for w in part], root, p)
                known.update(zip(part, range(len(known), len(known) + len(part)), strict=True))

        def totals(words: list[str]) -> np.ndarray:
            total = np.zeros(k)
            for lo in range(0, len(words), 100_000):
                part = words[lo : lo + 100_000]
                total += logs[np.fromiter(map(known.__getitem__, part), np.int64, len(part))].sum(axis=0)
            return total

        for b in batches:
            pred, score = [], []
            texts = b.column(b.schema.get_field_index("text")).to_pylist()
            for lo in range(0, len(texts), 400):
                every = [LETTERS.findall(t.lower()) if t and k else [] for t in texts[lo : lo + 400]]
                if len(known) > MEMORY or held > LETTERS_KEPT:
                    known.clear()
                    held = 0
                fresh = list({w for words in every for w in words if w not in known})
                held += sum(map(len, fresh))
                learn(fresh)
                for words in every:
                    if not any(c.isalpha() for w in words for c in w):  # runs may be of other numeric signs alone
                        pred.append("und")
                        score.append(0.0)
                        continue
                    total = totals(words)
                    best = int(total.argmax())
                    pred.append(langs[best])
                    score.append(float(1 / np.exp(total - total[best]).sum()))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)


def held_out(parts: int = 4, out: int = 2) -> Column:
    """Rows that are never learned from: the checksum of doc_id as text leaves `out` over."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % parts == out, F.lit(False))


def report(docs: DataFrame, vocabulary: str | None = None, most: int = SAMPLE, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, lang_pred, score of each row."""
    model = learned(docs, ~held_out(), vocabulary or common.tokenizer_path(VOCABULARY), most, rounds)
    return identified(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
