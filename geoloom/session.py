"""Session settings that every geoloom query assumes."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(master: str | None = None, shuffle_partitions: int | None = None, app: str = "geoloom", **extra: str) -> SparkSession:
    """A session in UTC with AQE, skew-join handling and Arrow transfer switched on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    return b.config(map=conf | {k.replace("__", "."): v for k, v in extra.items()}).getOrCreate()
