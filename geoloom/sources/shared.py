"""A folder that the driver and all executors share, for what a job writes in between."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local: dict[str, str] = {}


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that spark.checkpoint.dir names. A local master without that setting gets a temporary folder; any other is an error."""
    top = spark.conf.get("spark.checkpoint.dir", None)
    if not top:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        top = _local.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="geoloom-"))
    return f"{top.rstrip('/')}/geoloom-{uuid.uuid4().hex}"
