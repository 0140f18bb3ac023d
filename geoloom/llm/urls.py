"""URL filters: host words by unigram Viterbi, scored by multinomial naive Bayes, under a list of rules.

Names in hosts are often several words run together. The most probable split is found by Viterbi search over a unigram model: the
whole words (of two letters or more) of a public vocabulary, with Zipf's law over their order as probabilities; what is no word costs UNKNOWN and
UNKNOWN_LETTER a letter more. Path words are split likewise; runs of digits are one token.

Naive Bayes learns from the table itself: a URL whose host has a word of SEEDS counts as blocked, any other with a host as
allowed. Each token counts once a URL, so one that repeats itself does not outweigh others. Tokens are hashed into BUCKETS, so the model, which the driver gathers and sends out, has one bounded size however
many tokens there are; its counts cover all rows. Rules say which sections are blocked or allowed whatever their words, so they
are no labels; where a rule fits, its verdict stands, and elsewhere that of the model.

Defined results: a null url, or one without "://", has an empty host and path, no rule, and the verdict of a URL without
words (allow unless most hosts are blocked); equal urls get equal results; repeated rows are rows of their own and are learned from
as often; where there is nothing to learn from, all is allowed but for rules; urls of any length are judged whole; an empty table gives
no rows. Other columns are not read.
"""

from __future__ import annotations

import json
import math
import re
import zlib
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.llm import common

VOCABULARY = "word_bpe_49k.json"
#: Rules by what they say and the host with path that they are for (a list of a few thousand at most, as each is tried).
RULES = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))
#: Words that mark a host as unwanted (gambling, adult, pharmacy spam, advertising, malware), to learn from.
SEEDS = frozenset(
    "casino casinos poker slots jackpot lottery betting bet bets gambling gamble roulette bingo wager bookmaker "
    "adult porn porno xxx sex sexy nude escort escorts erotic hentai webcam camgirl "
    "pills pill viagra cialis levitra pharmacy meds tramadol steroids "
    "spam spammer ads adserver adware banner banners popunder clickbait tracker tracking "
    "malware phishing warez crack cracked keygen torrent torrents botnet".split()
)
BUCKETS = 1 << 18
SMOOTH = 1.0
#: Natural logarithms: the price of a chunk that is no word, and of each of its letters; such chunks, like words, have MOST letters at most.
UNKNOWN, UNKNOWN_LETTER, MOST = 11.0, 2.0, 24
TOKEN = re.compile(r"[a-z]+|[0-9]+|[^\x00-\x7F]+")
#: Runs of letters whose words a worker remembers; beyond that the memory starts anew.
MEMORY = 200_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def unigrams(path: str) -> dict[str, float]:
    """Natural log probabilities of the vocabulary's whole words, by Zipf's law over their order."""
    vocab = json.loads(Path(path).read_text(encoding="utf-8"))["model"]["vocab"]
    whole = [w.removesuffix("</w>") for w in sorted(vocab, key=vocab.get) if w.endswith("</w>")]
    words = list(dict.fromkeys(w for w in (w.lower() for w in whole) if w.isascii() and w.isalpha() and 1 < len(w) <= MOST))
    total = math.log(sum(1 / (i + 1) for i in range(len(words)))) if words else 0.0
    return {w: -math.log(i + 1) - total for i, w in enumerate(words)}


def segmented(run: str, words: dict[str, float]) -> list[str]:
    """The most probable split of a run of letters; of equal ones, that with the longest last chunks."""
    best, back = [0.0], [0]
    for end in range(1, len(run) + 1):
        top, at = -math.inf, 0
        for begin in range(max(0, end - MOST), end):
            p = words.get(run[begin:end])
            score = best[begin] + (p if p is not None else -UNKNOWN - UNKNOWN_LETTER * (end - begin))
            if score > top:
                top, at = score, begin
        best.append(top)
        back.append(at)
    out, end = [], len(run)
    while end:
        out.append(run[back[end] : end])
        end = back[end]
    return out[::-1]


class Splitter:
    """Tokens of hosts and paths, with a bounded memory of the runs seen."""

    def __init__(self, words: dict[str, float]):
        self.words, self.memory = words, {}

    def __call__(self, text: str) -> list[str]:
        out = []
        for run in TOKEN.findall(text):
            if run.isdigit() or not run.isascii():
                out.append("#" if run.isascii() else run)
                continue
            if (found := self.memory.get(run)) is None:
                if len(self.memory) >= MEMORY:
                    self.memory.clear()
                found = self.memory[run] = segmented(run, self.words)
            out += found
        return out


def bucket(token: str, buckets: int = BUCKETS) -> int:
    return zlib.crc32(token.encode()) % buckets


def located(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lowered) and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: Iterable[tuple[str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    name = said = F.lit(None).cast("string")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at = rule.index("/")
        fits = ((host == rule[:at]) | F.endswith(host, F.lit("." + rule[:at]))) & F.startswith(path, F.lit(rule[at:]))
        name, said = F.when(fits, rule).otherwise(name), F.when(fits, verdict).otherwise(said)
    return name, said


def learned(places: DataFrame, words: dict[str, float], seeds: frozenset[str] = SEEDS, buckets: int = BUCKETS, smooth: float = SMOOTH) -> tuple[float, np.ndarray]:
    """Log odds of block before any token, and of each bucket, from all rows of places (host, path)."""

    def counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, found = Splitter(words), np.zeros((buckets + 1, 2), np.int64)
        for batch in batches:
            for host, path in zip(batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True):
                if host:
                    of_host = split(host)
                    label = int(not seeds.isdisjoint(of_host))
                    np.add.at(found[:, label], [bucket(t, buckets) for t in {*of_host, *split(path.lower())}] + [buckets], 1)
        at = np.flatnonzero(found.any(axis=1))
        yield pa.record_batch([pa.array(at), pa.array(found[at, 0]), pa.array(found[at, 1])], names=["bucket", "allowed", "blocked"])

    sums = places.select("host", "path").mapInArrow(counts, "bucket long, allowed long, blocked long").groupBy("bucket").agg(F.sum("allowed").alias("allowed"), F.sum("blocked").alias("blocked"))
    table = np.zeros((buckets + 1, 2))
    for b, allowed, blocked in sums.collect():  # buckets + 1 rows at most
        table[b] = allowed, blocked
    rows, table = table[-1], table[:-1]
    if not rows.any():
        return -1.0, np.zeros(buckets)
    kinds = max(1, int((table.sum(axis=1) > 0).sum()))
    odds = np.log((table[:, 1] + smooth) / (table[:, 1].sum() + smooth * kinds)) - np.log((table[:, 0] + smooth) / (table[:, 0].sum() + smooth * kinds))
    odds[table.sum(axis=1) == 0] = 0.0  # a token that was never seen says nothing
    return float(np.log((rows[1] + smooth) / (rows[0] + smooth))), odds


def judged(pages: DataFrame, vocabulary: str | None = None, rules: Iterable[tuple[str, str]] = RULES, seeds: frozenset[str] = SEEDS) -> DataFrame:
    """page_id, host, path, rule, verdict, words (of the host, by spaces), odds (the model's log odds of block)."""
    common.ship(pages.sparkSession)
    words = unigrams(vocabulary or common.tokenizer_path(VOCABULARY))
    host, path = located(F.col("url"))
    places = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(host, F.lit("")).alias("host"), F.coalesce(path, F.lit("")).alias("path"))
    prior, odds = learned(places, words, seeds)
    rule, said = ruled(F.col("host"), F.col("path"), rules)

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Splitter(words)
        for batch in batches:
            names, values = [], []
            for host, path in zip(batch["host"].to_pylist(), batch["path"].to_pylist(), strict=True):
                of_host = split(host)
                names.append(" ".join(of_host))
                values.append(prior + math.fsum(odds[bucket(t, len(odds))] for t in {*of_host, *split(path.lower())}))
            yield pa.record_batch([*batch.columns, pa.array(names, pa.string()), pa.array(values, pa.float64())], names=[*batch.schema.names, "words", "odds"])

    found = places.select("page_id", "host", "path", rule.alias("rule"), said.alias("said")).mapInArrow(scored, "page_id long, host string, path string, rule string, said string, words string, odds double")
    return found.select("page_id", "host", "path", "rule", F.coalesce("said", F.when(F.col("odds") > 0, "block").otherwise("allow")).alias("verdict"), "words", "odds")
