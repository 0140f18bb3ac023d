"""Filter interaction audit: what five filters remove in every order, from one relational pass over words and rows.

Texts are told apart by their SHA-256. The row with the smallest doc_id of each text stands for it: its words are exploded
and counted by (text, word), then by text for totals and distinct words. Everything else that a decision needs (capitals,
symbols, copies, labels) is counted by (part, text) and outer-joined to the word counts, which texts without words
lack. What is left is one of 32 failure patterns a row; 32 conditional counts for each part, and as many of good
and of toxic rows, give every cell of the report.

Texts are dealt once, by (doc_id, text); words are grouped where they are exploded. Joins are by (doc_id, text), by doc_id and by text
after rows of equal fate have been added up, so a third of all rows being copies, or of one part, lands in no single task.

Defined results: a null text is empty and has no words (fails A alone, and E where a smaller doc_id is empty too);
of repeated rows none has a smaller doc_id, so none fails E for the other; a row without a doc_id fails no E, is never
the smaller one, and has no labels; several labels of a doc_id count once, as good or toxic if any says so; a null part
is the empty string; an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FILTERS = "ABCDE"
PATTERNS = range(1 << len(FILTERS))
SPACE = r"[\x20\x09-\x0D]+"
CAPITAL, SYMBOL = "[A-Z]", "[#$%&*|]"
#: Stands for a missing doc_id in join keys alone.
NO_ID = -(2**63)


def word_counts(texts: DataFrame, *key: str) -> DataFrame:
    """key, n_words, n_distinct of each row of texts (key, text), keys being unique; texts without words have no row."""
    words = texts.select(*key, F.explode(F.split("text", SPACE)).alias("word")).where("word <> ''")
    return words.groupBy(*key, "word").agg(F.count("*").alias("n")).groupBy(*key).agg(F.sum("n").alias("n_words"), F.count("*").alias("n_distinct"))


def cells(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """part, pattern (bit i set: fails FILTERS[i]), good, toxic, n: rows of equal fate, added up."""
    key = F.col("doc_id").cast("long")
    rows = docs.select(key.alias("doc_id"), F.coalesce(F.col(part), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "doc_id", "part", "text", F.unhex(F.sha2("text", 256)).alias("digest"))
    firsts = rows.groupBy("digest").agg(F.coalesce(F.min("doc_id"), F.lit(NO_ID)).alias("id"))

    standing = rows.select("id", "digest", "text", F.monotonically_increasing_id().alias("row")).join(firsts.hint("shuffle_hash"), ["id", "digest"], "left_semi")
    counted = word_counts(standing, "id", "digest", "row").groupBy("digest").agg(F.max("n_words").alias("n_words"), F.max("n_distinct").alias("n_distinct"))

    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    c = F.lit(100) * F.regexp_count("text", F.lit(CAPITAL)) > F.lit(5) * F.length("text")
    fates = rows.select("id", "doc_id", "part", "digest", c.alias("c"), F.col("text").rlike(SYMBOL).alias("d"))
    fates = fates.join(marks, "doc_id", "left").join(firsts.withColumn("first", F.lit(True)), ["id", "digest"], "left")
    one = [F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"), (F.col("doc_id").isNotNull() & F.col("first").isNull()).alias("e")]
    fates = fates.select("part", "digest", "c", "d", *one).groupBy("part", "digest", "c", "d", "e", "good", "toxic").agg(F.count("*").alias("n"))

    whole = fates.join(counted, "digest", "left").na.fill(0, ["n_words", "n_distinct"])
    fails = (F.col("n_words") < 50, F.col("n_distinct") * 100 < F.col("n_words") * 65, F.col("c"), F.col("d"), F.col("e"))
    pattern = sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0))
    return whole.select("part", pattern.alias("pattern"), "good", "toxic", "n")


def counted(cells: DataFrame) -> DataFrame:
    """A row a part: 32 conditional counts each of all, good and toxic rows, as the arrays every, good and toxic."""

    def columns(name: str, weight: Column) -> list[Column]:
        return [F.sum(F.when(F.col("pattern") == p, weight).otherwise(0)).alias(f"{name}_{p}") for p in PATTERNS]

    sums = cells.groupBy("part").agg(*columns("every", F.col("n")), *columns("good", F.col("n") * F.col("good")), *columns("toxic", F.col("n") * F.col("toxic")))
    return sums.select("part", *[F.array(*[f"{name}_{p}" for p in PATTERNS]).alias(name) for name in ("every", "good", "toxic")])


def report(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    at: dict[tuple[int, int], list[tuple[str, int]]] = {}  # what went before, whatever its order, and the filter: where that occurs
    for order in permutations(range(len(FILTERS))):
        for step, f in enumerate(order, 1):
            at.setdefault((sum(1 << g for g in order[: step - 1]), 1 << f), []).append(("".join(FILTERS[g] for g in order), step))
    orders = len(list(permutations(FILTERS)))

    def places(steps: list[tuple[str, int]]) -> Column:
        return F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step")) for o, s in steps])

    turns = F.array(*[F.struct(F.lit(before).alias("before"), F.lit(own).alias("own"), places(steps).alias("places")) for (before, own), steps in at.items()])

    def added(counts: str, weigh: Callable[[Column], Column]) -> Column:
        """Counts times weigh(pattern), added up."""
        return F.aggregate(F.transform(counts, lambda n, p: n * weigh(p)), F.lit(0).cast("long"), lambda a, x: a + x)

    before, own = F.col("turn.before"), F.col("turn.own")
    fails, gone = lambda p: p.bitwiseAND(own) != 0, lambda p: p.bitwiseAND(before) != 0
    # of all orders, a filter comes first among the n filters that a row fails in one of n
    weigh = {
        "kept": ("every", lambda p: (~fails(p) & ~gone(p)).cast("long")),
        "removed": ("every", lambda p: (fails(p) & ~gone(p)).cast("long")),
        "redundant": ("every", lambda p: (fails(p) & gone(p)).cast("long")),
        "unique_fails": ("every", lambda p: (p == own).cast("long")),
        "good_lost": ("good", lambda p: (fails(p) & ~gone(p)).cast("long")),
        "toxic_lost": ("toxic", lambda p: (fails(p) & ~gone(p)).cast("long")),
        "shapley": ("every", lambda p: F.when(fails(p), (F.lit(orders) / F.greatest(F.bit_count(p), F.lit(1))).cast("long")).otherwise(0)),
    }
    by_turn = counted(cells(docs, labels, part)).select("*", F.explode(turns).alias("turn"))
    sums = by_turn.select("part", F.col("turn.places").alias("places"), *[added(c, w).alias(k) for k, (c, w) in weigh.items()])
    return sums.select("part", F.inline("places"), *weigh)


def oracle() -> str:
    """DuckDB SQL for report()."""
    words = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
    return rf"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, {words} AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM d GROUP BY t),
marks AS (SELECT doc_id, max(CAST(coalesce(quality = 1, false) AS INT)) AS good, max(CAST(coalesce(toxic = 1, false) AS INT)) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic, [len(w) < 50, 100 * len(list_distinct(w)) < 65 * len(w),
  100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t), regexp_matches(t, '[#$%&*|]'), coalesce(d.doc_id > first, false)] AS bad
  FROM d JOIN firsts USING (t) LEFT JOIN marks ON d.doc_id = marks.doc_id),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l, unnest([1, 2, 3, 4, 5]) AS i),
orders AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o, a.l || b.l || c.l || d.l || e.l AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (SELECT filter_order, o, CAST(s AS INT) AS step, o[s] AS own, o[1:s - 1] AS before FROM orders, range(1, 6) r(s)),
x AS (SELECT part, filter_order, step, own, good, toxic, bad[own] AS fails, len([k for k in before if bad[k]]) > 0 AS gone, len([v for v in bad if v]) AS n_bad FROM f, steps),
r AS (SELECT part, filter_order, step, own, count(*) FILTER (WHERE NOT fails AND NOT gone) AS kept, count(*) FILTER (WHERE fails AND NOT gone) AS removed, count(*) FILTER (WHERE fails AND gone) AS redundant,
  count(*) FILTER (WHERE fails AND n_bad = 1) AS unique_fails, CAST(coalesce(sum(good) FILTER (WHERE fails AND NOT gone), 0) AS BIGINT) AS good_lost, CAST(coalesce(sum(toxic) FILTER (WHERE fails AND NOT gone), 0) AS BIGINT) AS toxic_lost FROM x GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r"""
