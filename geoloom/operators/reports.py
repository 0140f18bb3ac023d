"""Run reports: merging jobs' rows, common headers, totals, and writing them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.functions.columns import c


def merged(rows: DataFrame) -> DataFrame:
    """The last row of each scene by file and place, and all rows without a scene; `n` orders scenes by name, then the others as they came."""
    named, other = rows.where("scene is not null and scene <> ''"), rows.where("scene is null or scene = ''")
    last = named.withColumn("rn", F.row_number().over(W.partitionBy("scene").orderBy(F.desc("file"), F.desc("pos")))).where("rn = 1").drop("rn")
    return last.withColumn("part", F.lit(0)).unionByName(other.withColumn("part", F.lit(1)))


def with_common_header(parts: list[DataFrame]) -> DataFrame:
    """Reports with different columns as one table: the sorted union of columns, missing ones null."""
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return every.select(*sorted(every.columns))


def totals(rows: DataFrame, good: str) -> DataFrame:
    return rows.agg(F.count_if(c("status") == good).alias("n_success"), F.count_if(c("status") != good).alias("n_failed"))


def status_counts(rows: DataFrame, key: str, states: tuple[str, ...]) -> DataFrame:
    """One column for each status."""
    return rows.groupBy(key).agg(*[F.count_if(c("status") == s).alias(f"n_{s}") for s in states])


def appended(rows: DataFrame, path: str, job: str) -> None:
    """Adds a job's rows to a report table; jobs write their own partition, so concurrent jobs do not meet."""
    rows.withColumn("job_id", F.lit(job)).write.mode("append").partitionBy("job_id").parquet(path)


def as_json(rows: DataFrame) -> DataFrame:
    """Each row as one JSON document."""
    return rows.select(F.to_json(F.struct(*rows.columns)).alias("value"))
