"""Source divergence audit: how far the sources of a language differ in the words they use, from joint count histograms.

Each task counts terms by (lang, source) in a bounded table that it hands on when full; Spark adds these up. Kept terms
are one written table: a row a term of a language, with the sources that have it and their counts. For each pair of sources, distinct
(count, count) combinations are tallied. Only the terms that both have are looked at: cells where one count or both are
zero follow from each source's own histogram of counts and the number of kept terms, by adding and taking away. The divergence of two
shares is then worked out once a combination and multiplied by how many terms have it, for both directions.

All numbers are 64-bit integers, with shares in billionths: the long division goes by thousands, so nothing overflows up
to 9e15 occurrences, and sums stay below 2^63 up to 5e8 kept terms (Spark raises an error beyond, it does not wrap).

Defined results: null text, lang and source are the empty string, and the empty lang is a language like any other;
repeated rows are documents of their own; a group whose texts have no kept term still has its pairs, with the shares that smoothing gives (value 0
where the language keeps no term at all), and no terms; a lang with one source has no pairs; texts of any length are
counted whole; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm import common

#: A kept term stands in so many documents of its language; a group lists so many of its terms.
LEAST_DOCS, TOP = 3, 200
#: Shares are in 1 / STEP^3; below FITS occurrences, STEP^3 times a count fits 63 bits.
STEP, FITS = 1000, 9 * 10**9
#: Entries of a task's table before it is handed on.
ENTRIES = 250_000
#: Terms as words of a byte string: A-Z lowered, whatever is no letter and below 128 a space.
TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SCHEMA = "lang string, source string, term string, n long, docs long"


def partial_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, occurrences, documents), each term as often as the task's table was full."""
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}

    def handed() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in held.items():
            words = list(n)
            yield pa.record_batch(
                [pa.array([lang] * len(words), pa.string()), pa.array([source] * len(words), pa.string()), pa.array(words, pa.binary()).cast(pa.string()), pa.array([n[w] for w in words], pa.int64()), pa.array([docs[w] for w in words], pa.int64())],
                names=["lang", "source", "term", "n", "docs"],
            )
        held.clear()

    entries = 0
    for batch in batches:
        for lang, source, text in zip(batch["lang"].to_pylist(), batch["source"].to_pylist(), common.text_bytes(batch["text"]), strict=True):
            n, docs = held.setdefault((lang, source), (Counter(), Counter()))
            words, before = text.translate(TERMS).split(), len(n)
            n.update(words)
            docs.update(set(words))
            entries += len(n) - before
            if entries > ENTRIES:
                yield from handed()
                entries = 0
    yield from handed()


def kept_terms(docs: DataFrame, least: int = LEAST_DOCS) -> DataFrame:
    """lang, term, cells (source and count, where it isn't zero, by source): a written table of the terms that `least` documents of the language have."""
    common.ship(docs.sparkSession)
    parts = docs.select("lang", "source", "text").mapInArrow(partial_counts, SCHEMA)
    counts = parts.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sort_array(F.collect_list(F.struct("source", "n"))).alias("cells"))
    return common.written(terms.where(F.col("docs") >= least).select("lang", "term", "cells"))


def sized(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, total (occurrences of kept terms), lang_total, terms (kept by the language): a written row for each occurring group."""
    by_group = kept.select("lang", F.inline("cells")).groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_lang = kept.groupBy("lang").agg(F.count("*").alias("terms"))
    groups = docs.select("lang", "source").distinct().join(by_group, ["lang", "source"], "left").join(by_lang, "lang", "left").na.fill(0)
    return common.written(groups.withColumn("lang_total", F.sum("total").over(Window.partitionBy("lang"))))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(10^9 (count + 1) / (total + terms)): one division where the product fits, else long division by thousands."""
    by, div = F.greatest(total + terms, F.lit(1)), lambda a, b: F.call_function("div", a, b)
    one = (count + 1) % by
    two = one * STEP % by
    three = two * STEP % by
    long = div(count + 1, by) * STEP**3 + div(one * STEP, by) * STEP**2 + div(two * STEP, by) * STEP + div(three * STEP, by)
    return 1 + F.when(by < FITS, div((count + 1) * STEP**3, by)).otherwise(long)


def divergence(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def tally(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, a, b (sources, a first), na, nb, m: how many kept terms have these counts, zeros included."""
    sources = groups.select("lang", F.col("source").alias("b"))
    both = kept.select("lang", "cells", F.posexplode("cells").alias("i", "x")).select("lang", F.col("x.source").alias("a"), F.col("x.n").alias("na"), F.explode(F.slice("cells", F.col("i") + 2, F.size("cells"))).alias("y"))

    seen = both.groupBy("lang", "a", F.col("y.source").alias("b"), "na", F.col("y.n").alias("nb")).agg(F.count("*").alias("m"))

    def cell(na: Column, nb: Column, m: Column) -> Column:
        return F.struct(na.alias("na"), nb.alias("nb"), m.alias("m"))

    zero, na, nb, m = F.lit(0).cast("long"), F.col("na"), F.col("nb"), F.col("m")
    seen = seen.select("lang", "a", "b", F.inline(F.array(cell(na, nb, m), cell(na, zero, -m), cell(zero, nb, -m), cell(zero, zero, m))))
    # by itself, each source has its counts against zero; those where the other has the term too were taken away above
    own = kept.select("lang", F.inline("cells")).groupBy("lang", "source", "n").agg(F.count("*").alias("m")).join(sources, "lang").where("source <> b")
    first = F.col("source") < F.col("b")
    own = own.select("lang", F.least("source", "b").alias("a"), F.greatest("source", "b").alias("b"), F.when(first, F.col("n")).otherwise(0).alias("na"), F.when(first, 0).otherwise(F.col("n")).alias("nb"), "m")
    own = own.select("lang", "a", "b", F.inline(F.array(cell(na, nb, m), cell(zero, zero, -m))))
    every = groups.select("lang", F.col("source").alias("a"), F.col("terms").alias("m")).join(sources, "lang").where("a < b").select("lang", "a", "b", zero.alias("na"), zero.alias("nb"), "m")
    return seen.unionByName(own).unionByName(every).groupBy("lang", "a", "b", "na", "nb").agg(F.sum("m").alias("m"))


def pairs(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (another source), value."""
    left = groups.select("lang", F.col("source").alias("a"), F.col("total").alias("total_a"), "terms")
    right = groups.select("lang", F.col("source").alias("b"), F.col("total").alias("total_b"))
    cells = tally(kept, groups).join(left, ["lang", "a"]).join(right, ["lang", "b"])
    shares = cells.select("lang", "a", "b", "m", share(F.col("na"), F.col("total_a"), F.col("terms")).alias("p"), share(F.col("nb"), F.col("total_b"), F.col("terms")).alias("q"))
    # at m = 0 no term has the combination, so where a language keeps no term all sums are 0
    sums = shares.groupBy("lang", "a", "b").agg(F.sum(F.col("m") * divergence(F.col("p"), F.col("q"))).alias("ab"), F.sum(F.col("m") * divergence(F.col("q"), F.col("p"))).alias("ba"))
    return sums.select("lang", F.inline(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item"), F.col("ab").alias("value")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"), F.col("ba").alias("value")))))


def terms(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item (a term that the source uses more than its language does), value."""
    total = F.aggregate("cells", F.lit(0).cast("long"), lambda a, x: a + x["n"])
    found = kept.select("lang", "term", total.alias("all"), F.inline("cells")).join(groups, ["lang", "source"])
    shares = found.select("lang", "source", F.col("term").alias("item"), share(F.col("n"), F.col("total"), F.col("terms")).alias("p"), share(F.col("all"), F.col("lang_total"), F.col("terms")).alias("q"))
    return shares.where("p > q").select("lang", "source", "item", divergence(F.col("p"), F.col("q")).alias("value"))


def report(docs: DataFrame, top: int = TOP, least: int = LEAST_DOCS) -> DataFrame:
    """lang, source, part, item, value, rank."""
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    kept = kept_terms(plain, least)
    groups = sized(plain, kept)
    ranked = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    by_pair = pairs(kept, groups).select("lang", "source", F.lit("pair").alias("part"), "item", "value", ranked)
    by_term = terms(kept, groups).select("lang", "source", F.lit("term").alias("part"), "item", "value", ranked).where(F.col("rank") <= top)
    return by_pair.unionByName(by_term)


def oracle() -> str:
    """DuckDB SQL for report()."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    share = "1 + (1000000000 * CAST({c} + 1 AS HUGEINT)) // ({n} + v)"
    return rf"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT lang, source, k, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n_all FROM t GROUP BY ALL HAVING count(DISTINCT k) >= {LEAST_DOCS}),
l AS (SELECT lang, count(*) AS v, sum(n_all) AS n_lang FROM kept GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT g.lang, g.source, kept.term, n_all, count(t.term) AS n FROM g JOIN kept USING (lang) LEFT JOIN t ON t.lang = g.lang AND t.source = g.source AND t.term = kept.term GROUP BY ALL),
s AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS n_group FROM c JOIN l USING (lang)),
p AS (SELECT *, {share.format(c="n", n="n_group")} AS p, {share.format(c="n_all", n="n_lang")} AS q FROM s),
pair AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, CAST(coalesce(v.value, 0) AS BIGINT) AS value FROM g JOIN g h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) v
  ON v.lang = g.lang AND v.source = g.source AND v.item = h.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
SELECT * FROM r WHERE part = 'pair' OR rank <= {TOP}"""
