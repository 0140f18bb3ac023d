"""Whole jobs, sinks and the reader of reports."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.functions import columns as fc
from geoloom.operators import jobs, models, points, references, selection
from geoloom.plans import catalogue
from geoloom.plans import jobs as plans
from geoloom.sources import sinks

SF = "/root/testdata/sf0.001"


def test_utm_and_back(spark):
    r = np.random.default_rng(3)
    rows = [(float(x), float(y), int(z)) for x, y, z in zip(r.uniform(-3.4, 3.4, 200), r.uniform(-83, 83, 200), r.integers(1, 61, 200), strict=True)]
    df = spark.createDataFrame(rows, "off double, lat double, zone int").withColumn("lon", F.col("off") + F.col("zone") * 6 - 183)
    x, y = fc.utm_from_wgs84(F.col("lon"), F.col("lat"), F.col("zone"), F.col("lat") < 0)
    df = df.withColumn("x", x).withColumn("y", y)
    lon, lat = fc.wgs84_from_utm(F.col("x"), F.col("y"), F.col("zone"), F.col("lat") < 0)
    for q in df.select("lon", "lat", "x", "y", lon.alias("lon2"), lat.alias("lat2")).collect():
        assert abs(q.lon - q.lon2) < 1e-9 and abs(q.lat - q.lat2) < 1e-9 and 1e5 < q.x < 9e5 and 0 <= q.y < 1e7


def test_tiles_without_enough_days_take_no_number(spark):
    """The first tile taken is the best covered, but never enough of it in one day: the second one is number 1."""
    rules = selection.Rules(8, 4, 4, 2, 0.5, 0.9, 2, 1.0, (0.0, -8.0, 8.0, 0.0))
    rows = [("B", r, k, f"d{(r * 4 + k) % 3 + i}", 0, "s0") for r in range(4) for k in range(4) for i in range(4)]
    rows += [("B", r, k + 4, f"d{i}", i, f"s{i}") for r in range(4) for k in range(4) for i in range(2)]
    rows += [("B", 0, 4, "d1", 7, "s7")]
    df = spark.createDataFrame(rows, "block_id string, row int, col int, acq_day string, scene_ord int, scene_id string")
    for i, b in enumerate(selection.BANDS):
        df = df.withColumn(b, F.col("scene_ord") * 10.0 + i).withColumn(f"valid_{b}", F.lit(True))
    tiles, seen = selection.extracted(df, rules)
    tiles = {t.tile_id: t for t in tiles.collect()}
    places = {p.place: (p.row, p.col) for p in selection.found(df, rules).collect()}
    assert places == {1: (0, 0), 2: (0, 4)}
    days = {(t.row, t.col): t.tile_id for t in tiles.values()}
    if (0, 0) in days:  # days d2 and d3 cover it wholly
        assert days[(0, 0)] == "B_TS_000001"
    assert tiles[days[(0, 4)]].dates == "d0 | d1" and tiles[days[(0, 4)]].west == 4.0
    one = {(o.tile_id, o.acq_day): o for o in seen.collect()}[days[(0, 4)], "d1"]
    assert one.source_scene_ids == "s1 | s7" and one.valid_fraction == 1.0 and one.observation.endswith("_d1_RGBN_4_1m")
    late = selection.extracted(df.where("not (row < 4 and col < 4 and acq_day in ('d2', 'd3'))"), rules._replace(dates=1))[0].collect()
    assert [(t.tile_id, t.row, t.col) for t in late] == [("B_TS_000001", 0, 4)]


def test_block_outputs(spark, tmp_path):
    pixels = plans.v_blocks(spark, SF)
    sinks.block_outputs(pixels, plans.RULES, str(tmp_path))
    tiles, seen = (spark.read.parquet(f"{tmp_path}/{n}").count() for n in ("tiles", "observations"))
    assert tiles == plans.block_tiles(spark, SF).count() > 0 and seen >= tiles * plans.RULES.days
    values = spark.read.parquet(f"{tmp_path}/observation_pixels")
    assert values.count() == seen * plans.RULES.tile**2
    polygon = spark.read.option("header", "true").csv(f"{tmp_path}/footprints").first()
    assert polygon.geometry.startswith("POLYGON ((") and polygon.geometry.count(",") == 4
    sinks.block_outputs(pixels.where("row < 0"), plans.RULES, str(tmp_path / "none"))
    assert spark.read.option("header", "true").csv(f"{tmp_path}/none/footprints").count() == 0


def test_prediction_sinks(spark, tmp_path):
    found = catalogue.predictions(spark, SF)
    sinks.predictions(found, str(tmp_path))
    n = found.count()
    read = lambda name: spark.read.option("header", "true").csv(f"{tmp_path}/{name}")
    assert read("predictions").count() == n and read("prediction_summary").count() == 4
    assert all(read(f"prediction_summary_by_{k}").agg(F.sum("count")).first()[0] == n for k in ("dataset", "scene"))
    by = spark.read.parquet(f"{tmp_path}/tiles_by_class")
    assert by.count() == n and {"pred_label", "dataset", "scene"} < set(by.columns)


def test_reports_that_are_broken_are_passed_over(spark, tmp_path):
    files = {"a.json": json.dumps([{"scene": "s1", "n": 1}, 5, "x", {"scene": "", "n": 2}, {"n": 3}]), "b.json": '[{"scene": "s2"', "c.json": '{"scene": "s3"}', "d.json": "", "e.json": "[]"}
    for name, text in files.items():
        (tmp_path / name).write_text(text)
    got = [(r.file.rsplit("/", 1)[1], r.pos, r.scene, r.row["n"]) for r in sinks.job_rows(spark, f"{tmp_path}/*.json").orderBy("pos").collect()]
    assert got == [("a.json", 0, "s1", "1"), ("a.json", 3, None, "2"), ("a.json", 4, None, "3")]


def test_radiometry_and_tiling_reports(spark, tmp_path):
    bands = spark.createDataFrame([("s", b, f"/{b}.tif", "uint16", 0.0, 0.1, 0.0) for b in "RG"], "scene string, band string, source_path string, source_dtype string, source_nodata double, source_scale double, source_offset double")
    sinks.radiometry(bands, f"{tmp_path}/r")
    doc = spark.read.json(f"{tmp_path}/r").first()
    assert doc.bands.R.source_path == "/R.tif" and doc.bands.G.source_scale == 0.1
    report = plans.tiling(spark, SF)
    for _ in range(2):
        sinks.tiling_report(report, f"{tmp_path}/t")
    assert spark.read.option("header", "true").csv(f"{tmp_path}/t").count() == 2 * report.count()
    sums = {r.dataset: r for r in jobs.by_dataset(report).collect()}
    assert set(sums) == {"survey-2023", "survey-2024", "survey-2024-float32", "survey-2025", "survey-2025-float32"}
    assert sums["survey-2024"].raw_tiles == sums["survey-2024-float32"].raw_tiles


def test_unknown_chunks_and_bands_fail(spark):
    with pytest.raises(Exception, match="Unknown chunk name"):
        jobs.routed(spark.createDataFrame([("other",)], "name string"), {"a": ["native"]}).collect()
    files = spark.createDataFrame([("s", "R", "/1"), ("s", "G", "/2"), ("t", "R", "/3"), ("t", "R", "/4")], "scene string, band string, path string")
    assert jobs.one_band(files.where("scene = 's'"), "R").first().path == "/1"
    with pytest.raises(Exception, match="expected one R band"):
        jobs.one_band(files, "R").collect()


def test_references(spark):
    files = spark.createDataFrame([("/a/ref.tif",), ("/a/ref_c_N.tif",), ("/a/ref_c_E.tif",), ("/b/ref_c_SW.tif",), ("/b/other.tif",)], "path string")
    got = sorted((r.folder, r.pos, r.direction) for r in references.discovered(files, "ref.tif", "ref_c_").collect())
    assert got == [("/a", 0, "C"), ("/a", 1, "E"), ("/a", 2, "N"), ("/b", 0, "SW")]
    found = references.configured(spark.createDataFrame([("s", "/a", '{"multi_reference": {"candidates": [{"direction": "n", "path": "ref_c_N.tif", "crop_bounds": [1, 2, 3, 4]}, {"direction": "E", "path": "/gone.tif", "crop_bounds": []}]}}', "/a/ref.tif", [0.0] * 4), ("t", "/a", "{broken", "/a/ref.tif", [0.0] * 4)], "scene string, folder string, summary string, center string, bounds array<double>"))
    assert sorted((r.scene, r.pos, r.direction, r.path) for r in found.collect()) == [("s", 0, "N", "/a/ref_c_N.tif"), ("s", 1, "E", "/gone.tif"), ("t", 0, "C", "/a/ref.tif")]
    assert [r.path for r in references.missing(found, files).collect()] == ["/gone.tif"]


def test_grid_errors(spark):
    names = "direction string, w int, h int, crs string, xres double, yres double, left double, bottom double, c_w int, c_h int, c_crs string, c_xres double, c_yres double, c_left double, c_bottom double, overlap double"
    center = (100, 50, "u", 10.0, 10.0, 0.0, 0.0, 0.25)
    rows = [("E", 100, 50, "u", 10.0, 10.0, 750.0, 0.0, *center), ("N", 100, 51, "v", 10.2, 10.0, 0.0, 380.0, *center), ("C", 100, 50, None, 10.0, 9.0, 1.0, 0.0, *center)]
    got = {r.direction: r.errors for r in references.grid_errors(spark.createDataFrame(rows, names)).collect()}
    assert got["E"] == []
    assert got["N"] == ["N: raster dimensions differ from center", "N: CRS differs from center", "N: x resolution differs from center", "N: unexpected vertical crop shift"]
    assert got["C"] == ["C: CRS differs from center", "C: y resolution differs from center", "C: unexpected horizontal crop shift"]


@pytest.mark.parametrize("model", ["homography_ransac", "affine_ransac", "tps"])
def test_match_ladder_hands_its_pairs_to_the_model(spark, model):
    m = plans.v_matches(spark, SF).where("scene in (0, 1) or (scene = 2 and ord % 97 = 0) or (scene = 3 and conf < 0.2)")
    got = {r.scene: r for r in jobs.match_ladder(m, model, 4096).collect()}
    assert got[2].reason.startswith("too_few_matches_raw(") and got[3].reason.startswith("too_few_matches_after_conf(")
    assert not got[2].exportable and got[2].n_inliers == got[2].n_before == 0
    thin = points.without_copies(points.spatial_thin(points.confidence_gate(m.where("scene < 2"), 0.2, 100.0), 128, 8, 4096, 4096), ("x0", "y0"), 0.25)
    want = models.spline_filter(thin, 4096, 4096) if model == "tps" else models.ransac_filter(thin, model.split("_")[0])
    for r in want.collect():
        assert (got[r.scene].ok, got[r.scene].exportable, got[r.scene].reason, got[r.scene].n_inliers, got[r.scene].median_px) == (r.ok, r.exportable, r.reason, r.n_inliers, r.median_px)


def test_ladder_knows_its_models(spark):
    with pytest.raises(ValueError, match="unknown filter model"):
        jobs.match_ladder(plans.v_matches(spark, SF), "other", 10)
