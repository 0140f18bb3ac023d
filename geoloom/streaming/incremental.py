"""Streams: a growing scene index and run reports with the last row of each scene."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from geoloom.functions.columns import c
from geoloom.operators import catalog, reports


def new_bands(files: DataFrame, delay: str = "1 day") -> DataFrame:
    """Band files of a stream of (path, seen), each path once within the delay."""
    return catalog.band_files(files.withWatermark("seen", delay).dropDuplicatesWithinWatermark(["path"]).select("path"))


def daily_counts(files: DataFrame, delay: str = "1 day", window: str = "1 day") -> DataFrame:
    """Band files by window of arrival and band; late files within the delay still count."""
    b = files.withWatermark("seen", delay).withColumn("band", F.regexp_extract("path", r"_([BGNR])\.tiff?$", 1)).where("band <> ''")
    return b.groupBy(F.window("seen", window), "band").agg(F.count(F.lit(1)).alias("n")).select(c("window.start").alias("start"), "band", "n")


def keep_last_reports(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Merges each micro-batch into a table of the last row of each scene; a batch that runs again gives the same table."""

    def merge(batch: DataFrame, number: int) -> None:
        spark: SparkSession = batch.sparkSession
        now, before = f"{path}/{number}", f"{path}/{number - 1}"
        both = batch.unionByName(spark.read.schema(batch.schema).parquet(before)) if number else batch
        reports.merged(both).drop("part").write.mode("overwrite").parquet(now)

    return rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
