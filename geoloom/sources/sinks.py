"""Sinks: prediction tables, tiles by class, block outputs, tiling reports, radiometry, and the reader of job reports."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions.columns import c
from geoloom.operators import classify, finalise, selection


def csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", "true").csv(path)


def predictions(found: DataFrame, path: str) -> None:
    """predictions, prediction_summary, prediction_summary_by_dataset, prediction_summary_by_scene, and tiles_by_class (the paths of each class in a folder, in order of dataset and scene)."""
    csv(found, f"{path}/predictions")
    csv(classify.class_summary(found), f"{path}/prediction_summary")
    for name, by in (("dataset", ["dataset"]), ("scene", ["dataset", "scene"])):
        csv(classify.counts_by(found, *by), f"{path}/prediction_summary_by_{name}")
    found.select("path", "pred_label", "dataset", "scene").sortWithinPartitions("pred_label", "dataset", "scene").write.mode("overwrite").partitionBy("pred_label").parquet(f"{path}/tiles_by_class")


def block_outputs(pixels: DataFrame, rules: selection.Rules, path: str) -> None:
    """tiles, observations, footprints and the observations' pixels (in order of tile and day), a folder a block; what is empty has no rows."""
    tiles, seen = selection.extracted(pixels, rules)
    tiles.write.mode("overwrite").partitionBy("block_id").parquet(f"{path}/tiles")
    spark = pixels.sparkSession
    tiles = spark.read.schema(tiles.schema).parquet(f"{path}/tiles")
    seen.write.mode("overwrite").partitionBy("block_id").parquet(f"{path}/observations")
    seen = spark.read.schema(seen.schema).parquet(f"{path}/observations")
    csv(selection.footprints(tiles), f"{path}/footprints")
    selection.observation_pixels(pixels, tiles, seen, rules).withColumn("block_id", F.regexp_extract("tile_id", "^(.*)_TS_", 1)).repartition("block_id").sortWithinPartitions("block_id", "tile_id", "acq_day").write.mode("overwrite").partitionBy("block_id").parquet(f"{path}/observation_pixels")


def coverage_raster(counts: DataFrame, least: int, path: str) -> None:
    """Days of each pixel, and whether they are enough."""
    counts.withColumn("repeated", c("date_count") >= least).write.mode("overwrite").parquet(path)


def tiling_report(report: DataFrame, path: str) -> None:
    """Appends to a tiling report."""
    csv(report, path, "append")


def radiometry(bands: DataFrame, path: str) -> None:
    """One JSON document a scene: each band's source path, type, missing value, scale and offset (bands: scene, band and these)."""
    own = [k for k in bands.columns if k not in ("scene", "band")]
    doc = bands.groupBy("scene").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("band", F.struct(*own))))).alias("bands"))
    doc.write.mode("overwrite").json(path)


def job_rows(spark: SparkSession, path: str) -> DataFrame:
    """file, pos, scene, row (map) of the rows of job reports (JSON lists of objects); files that are no such list, and elements that are no object, are passed over."""
    t = spark.read.option("wholetext", "true").text(path).select(c("_metadata.file_path").alias("file"), "value").where(F.ltrim("value").startswith("["))
    e = t.select("file", F.posexplode(F.from_json("value", "array<string>")).alias("pos", "text")).where(F.ltrim("text").startswith("{"))
    row = F.from_json("text", "map<string,string>")
    return e.select("file", "pos", F.get(F.filter(F.map_values(F.map_filter(row, lambda k, v: (k == "scene") & (v != ""))), lambda v: v.isNotNull()), F.lit(0)).alias("scene"), row.alias("row")).where("row is not null")


def merged_summaries(report: DataFrame, path: str, buckets: int = 64) -> None:
    """Updates the table of scene summaries at path by a finalising report, scene by scene. Only buckets with new scenes are written; they are staged whole first, so a run that is cut off in between is simply done again."""
    spark, staged = report.sparkSession, f"{path.rstrip('/')}-staged-{uuid.uuid4().hex}"
    of = lambda k: F.pmod(F.xxhash64(k), F.lit(buckets)).cast("int")
    schema = T.StructType([*T._parse_datatype_string(finalise.SUMMARY).fields, T.StructField("bucket", T.IntegerType())])
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    there = at.getFileSystem(spark._jsc.hadoopConfiguration())
    existing = spark.read.schema(schema).parquet(path) if there.exists(at) else spark.createDataFrame([], schema)
    touched = report.where("summary is not null").select(of("scene").alias("bucket")).distinct()
    finalise.updated(existing.join(touched, "bucket", "left_semi").drop("bucket"), report).withColumn("bucket", of("scene")).write.parquet(staged)
    fresh = spark.read.schema(schema).parquet(staged)
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)
    gone = spark._jvm.org.apache.hadoop.fs.Path(staged)
    there.delete(gone, True)


def match_documents(pairs: DataFrame, about: DataFrame, path: str) -> None:
    """One JSON document a scene, as files.matches() reads them: pts_mov_on_ref, pts_ref and confidence of its pairs (scene, ord, x0, y0, x1, y1, conf) in order, and the columns of `about` (a row a scene: method, counts, residuals, the selected candidate). A scene of `about` without pairs has empty lists; a scene's pairs are as few as its filters leave."""
    p = F.array_sort(F.collect_list(F.struct("ord", "x0", "y0", "x1", "y1", "conf")))
    lists = pairs.groupBy("scene").agg(p.alias("p"))
    of = lambda f: F.coalesce(F.transform("p", f), F.array())
    j = about.join(lists, "scene", "left")
    doc = j.select(*about.columns, of(lambda x: F.array(x["x0"], x["y0"])).alias("pts_mov_on_ref"), of(lambda x: F.array(x["x1"], x["y1"])).alias("pts_ref"), of(lambda x: x["conf"]).alias("confidence"))
    doc.withColumn("scene", c("scene").cast("string")).write.mode("overwrite").json(path)


def row_documents(rows: DataFrame, name: str, path: str) -> None:
    """One JSON document a scene, with its rows (of tile diagnostics, or of reference candidates) as a list `name`, in order of their first column after the scene; nulls are left out."""
    own = [k for k in rows.columns if k != "scene"]
    doc = rows.groupBy("scene").agg(F.array_sort(F.collect_list(F.struct(*own))).alias(name))
    doc.withColumn("scene", c("scene").cast("string")).write.mode("overwrite").json(path)


def block_tables(index: DataFrame, blocks: DataFrame, pairs: DataFrame, tiles: DataFrame, observations: DataFrame, config: dict, path: str) -> None:
    """scene_index and blocks (Parquet and CSV, boxes as text too), block_summary (CSV) and the configuration (JSON) of a temporal job. pairs: block_id, scene_id, acq_day; blocks without pairs are not summed up."""
    box = lambda a, b, x, y: F.format_string("POLYGON((%1$s %2$s,%3$s %2$s,%3$s %4$s,%1$s %4$s,%1$s %2$s))", a, b, x, y)
    index = index.withColumn("geometry", box("minx", "miny", "maxx", "maxy"))
    blocks = blocks.withColumn("geometry", box(*[f"core_{k}" for k in ("minx", "miny", "maxx", "maxy")])).withColumn("expanded_geometry", box(*[f"expanded_{k}" for k in ("minx", "miny", "maxx", "maxy")]))
    for name, df in (("scene_index", index), ("blocks", blocks)):
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        csv(df, f"{path}/{name}_csv")
    n = lambda df, name: df.groupBy("block_id").agg(F.count("*").alias(name))
    s = pairs.groupBy("block_id").agg(F.count_distinct("scene_id").alias("n_scenes"), F.count_distinct("acq_day").alias("n_dates"))
    s = s.join(n(tiles, "selected_tiles"), "block_id", "left").join(n(observations, "observations"), "block_id", "left").na.fill(0)
    csv(s.withColumn("count_raster", F.concat("block_id", F.lit("/date_count.tif"))).withColumn("mask_raster", F.concat("block_id", F.lit("/repeated.tif"))), f"{path}/block_summary")
    spark = index.sparkSession
    spark.createDataFrame([(json.dumps(config, sort_keys=True),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/config")
