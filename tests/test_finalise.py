"""Finalising: each failure in its own words, summaries merged by scene, nothing changed by doing it again."""

from pyspark.sql import functions as F

from geoloom.operators import finalise
from geoloom.sources import sinks

SCENES = "scene string, has_dir boolean, template string, folder string, left double, bottom double, right double, top double"


def made(spark):
    names = ["ok", "tiff", "parts", "two", "none", "many", "nodir", "notpl", "shifted"]
    scenes = spark.createDataFrame([(n, n != "nodir", None if n == "notpl" else f"/s/{n}/t.tif", f"/s/{n}", 100.0, 200.0, 300.0, 240.0) for n in names], SCENES)
    mark = finalise.EXPORT
    files = [f"/d1/ok{mark}.tif", f"/d1/ok{mark}-old.tif", f"/d1/tiff{mark}.tiff", f"/d2/parts{mark}-0001.tif", f"/d1/two{mark}.tif", f"/d2/two{mark}.tif", f"/d1/many{mark}-1.tif", f"/d1/many{mark}-2.tif", f"/d1/nodir{mark}.tif", f"/d1/notpl{mark}.tif", f"/d1/shifted{mark}.tif", "/d1/other.tif"]
    found = finalise.exports(spark.createDataFrame([(f,) for f in files], "path string"))
    settings = spark.createDataFrame([("shifted", 0.25, ["w", "N", "w"])], "scene string, overlap double, directions array<string>")
    return finalise.finalised(scenes, found, settings, 32638)


def test_states_and_reasons(spark):
    got = {r.scene: r for r in made(spark).collect()}
    assert {k for k, r in got.items() if r.status == "OK"} == {"ok", "tiff", "parts", "shifted"}
    assert {k: r.error for k, r in got.items() if r.status == "FAILED"} == {
        "two": "several exact exports (2)", "none": "expected one export, found 0", "many": "expected one export, found 2", "nodir": "missing scene folder: nodir", "notpl": "no template: notpl",
    }
    assert got["ok"].drive_export.endswith("ok_sentinel2_rgb_raw.tif") and got["ok"].reference_candidates == 1 and got["shifted"].reference_candidates == 3
    multi = got["shifted"].summary.multi_reference
    assert multi.directions == ["W", "N"] and [c.crop_bounds for c in multi.candidates] == [[100.0, 200.0, 300.0, 240.0], [-50.0, 200.0, 150.0, 240.0], [100.0, 230.0, 300.0, 270.0]]
    assert [c.path for c in multi.candidates] == ["sentinel2_rgb_utm.tif", "sentinel2_rgb_utm_ref_W.tif", "sentinel2_rgb_utm_ref_N.tif"] and got["ok"].summary.multi_reference is None


def test_summaries_are_merged_and_stay_the_same(spark, tmp_path):
    report, path = made(spark), str(tmp_path / "summaries")
    old = [("ok", "STARTED", "x", None, None, 1, 1, "s", (0.5, ["N"], []), {"bbox": "1"}), ("two", "OLD", None, None, None, None, None, None, None, {"k": "v"}), ("elsewhere", "OLD", None, None, None, None, None, None, None, None)]
    before = spark.createDataFrame(old, finalise.SUMMARY)
    before.withColumn("bucket", F.pmod(F.xxhash64("scene"), F.lit(64)).cast("int")).write.partitionBy("bucket").parquet(path)
    read = lambda: {r.scene: r.asDict(True) for r in spark.read.parquet(path).drop("bucket").collect()}
    sinks.merged_summaries(report, path)
    once = read()
    assert set(once) == {"ok", "tiff", "parts", "shifted", "two", "elsewhere"}
    assert once["ok"]["status"] == finalise.FINALISED and once["ok"]["multi_reference"] is None and once["ok"]["other"] == {"bbox": "1"}
    assert once["two"]["status"] == once["elsewhere"]["status"] == "OLD"
    sinks.merged_summaries(report, path)
    assert read() == once
    sinks.merged_summaries(report, str(tmp_path / "new"))
    assert spark.read.parquet(str(tmp_path / "new")).count() == 4
