"""Hand-computed cases, and properties that hold for any input."""

import json
import math
import random
import struct

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from geoloom.functions import columns as fc
from geoloom.functions.columns import c, d
from geoloom.operators import catalog, classify, coverage, grid, models, points, raster, reports
from geoloom.sources import files
from geoloom.streaming import incremental


def one(spark, *columns):
    return spark.range(1).select(*columns).first()


@pytest.mark.parametrize("length,want", [(2500, [0, 1056, 1380]), (1000, [0]), (2176, [0, 1056])])
def test_axis_starts(spark, length, want):
    assert one(spark, grid.axis_starts(F.lit(length), 1120, 64).alias("x")).x == want


def test_scalars(spark):
    r = one(spark, fc.align_down(d(-1), 20000).alias("lo"), fc.align_up(d(-1), 20000).alias("hi"), grid.directions(F.array(F.lit("w"), F.lit("W"), F.lit("nw"))).alias("dirs"), F.rint(d(0.375) / d(0.25)).alias("key"), fc.softmax(F.array(d(1), d(2), d(3))).alias("p"), points.bad_geometry(F.lit(None).cast("double"), F.lit(None).cast("double")).alias("bad"))
    assert (r.lo, r.hi, r.dirs, r.key, r.bad) == (-20000, 0, ["C", "W", "NW"], 2, False)
    assert [round(x, 6) for x in r.p] == [0.090031, 0.244728, 0.665241]
    t = fc.scene_times(F.lit("20230307T102907_20230307T102909_X"))
    u = fc.scene_times(F.lit("abc"))
    r = one(spark, *[v.alias(k) for k, v in t.items()], *[v.alias(f"u_{k}") for k, v in u.items()])
    assert (r.acq_start, r.acq_end, r.acq_day, r.processing_time) == ("20230307T102907", "20230307T102909", "20230307", "unknown") and set(r[4:]) == {"unknown"}
    a, b = fc.time_window(F.to_date(F.lit("2023-03-07")), 60)
    assert tuple(one(spark, a.alias("a"), b.alias("b"))) == ("2023-01-06", "2023-05-06")
    with pytest.raises(Exception, match="unknown directions"):
        one(spark, grid.directions(F.array(F.lit("up"))).alias("x"))


def test_download_box(spark):
    df = spark.createDataFrame([(1, 0.5, ["W"], 44.0, 40.0)], "scene int, overlap double, directions array<string>, west double, south double")
    r = grid.download_box(df, 1.0, 0.02).first()
    assert [round(x, 6) for x in (r.west, r.south, r.east, r.north)] == [43.48, 39.98, 45.02, 41.02]


def test_utm_of_known_place(spark):
    x, y = fc.utm_from_wgs84(d(9.0), d(48.0), F.lit(32))
    r = one(spark, x.alias("x"), y.alias("y"))
    assert abs(r.x - 500000) < 1e-3 and abs(r.y - 5316300.3) < 1.0


def test_folds(spark):
    df = spark.createDataFrame([(1, i, 0, n) for i, n in enumerate([9, 7, 7, 5, 3, 1])] + [(2, 0, 0, 5)], "scene long, bx long, by long, n long")
    got = {r.bx: r.fold for r in points.folds(df, 3).collect()}
    assert [got[i] for i in range(6)] == [0, 1, 2, 1, 2, 0]


def test_robust_threshold_and_percentiles(spark):
    df = spark.createDataFrame([(1, float(x)) for x in (1, 2, 3, 4, 100)], "scene int, v double")
    assert round(points.robust_threshold(df, "v", 6.0, 3.0).first().threshold, 4) == 7.4478
    df = spark.createDataFrame([(1, float(x), True) for x in range(1, 6)], "scene int, v double, valid boolean")
    r = raster.limits(df, ("v",)).first()
    assert (round(r.v_low, 6), round(r.v_high, 6)) == (1.08, 4.92)


@pytest.mark.parametrize("n,most", [(12, 2), (4, 1)])
def test_worst_removed(spark, n, most):
    df = spark.createDataFrame([(1, i, 100.0 + i) for i in range(n)], "scene int, ord long, r double")
    assert sorted(x.ord for x in points.worst_removed(df, "r", 1.0, 0.2).collect()) == list(range(n - most, n))


def test_best_candidate_prefers_the_first(spark):
    df = spark.createDataFrame([(1, 0, 40, True), (1, 1, 40, True), (1, 2, 39, True), (1, 3, 99, False)], "scene int, ord int, inliers int, viable boolean")
    assert points.best_candidate(df).first().ord == 0


def test_date_count_windows_and_selection(spark):
    px = spark.createDataFrame([(0, 0, "A", 0, 1.0, True), (0, 0, "A", 1, 1.0, True), (0, 0, "B", 0, 1.0, False)], "row int, col int, acq_day string, scene_ord int, value double, valid boolean")
    assert coverage.date_count(px, coverage.dense_grid(spark, 1, 1)).first().date_count == 1
    k = spark.createDataFrame([(0, 0, 2), (0, 1, 1), (1, 0, 3), (1, 1, 0)], "row int, col int, date_count int")
    r = coverage.windows(k, 2, 2, 2, 1, 2).first()
    assert (r.repeated_fraction, r.mean_date_count, r.max_date_count) == (0.5, 2.5, 3)
    f = spark.createDataFrame([("B", 0, 0, 0.9, 1.0, 1), ("B", 0, 1, 0.95, 1.0, 1), ("B", 0, 3, 0.9, 1.0, 1)], "block_id string, row int, col int, repeated_fraction double, mean_date_count double, max_date_count int")
    assert [(x.row, x.col) for x in coverage.nonoverlapping(f, 2).orderBy("place").collect()] == [(0, 1), (0, 3)]


def test_windows_are_the_naive_ones(spark):
    r = np.random.default_rng(1)
    h, w, tile, step = 23, 30, 9, 6
    n = r.integers(0, 6, (h, w))
    df = spark.createDataFrame([(i, j, int(n[i, j])) for i in range(h) for j in range(w)], "row int, col int, date_count int")
    got = {(x.row, x.col): (x.repeated_fraction, x.mean_date_count, x.max_date_count) for x in coverage.windows(df, h, w, tile, step, 3).collect()}
    want = {}
    for y in range(0, h - tile + 1, step):
        for x in range(0, w - tile + 1, step):
            p = n[y : y + tile, x : x + tile]
            want[y, x] = ((p >= 3).mean(), p[p >= 3].mean() if (p >= 3).any() else 0.0, p.max())
    assert got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)


def test_selected_tiles_are_disjoint_and_maximal(spark):
    r = random.Random(2)
    rows = [("B", y, x, r.random(), r.random(), r.randrange(9)) for y in range(0, 60, 4) for x in range(0, 60, 4) if r.random() < 0.7]
    df = spark.createDataFrame(rows, "block_id string, row int, col int, repeated_fraction double, mean_date_count double, max_date_count int")
    got = [(x.row, x.col) for x in coverage.nonoverlapping(df, 16).collect()]
    meet = lambda a, b: abs(a[0] - b[0]) < 16 and abs(a[1] - b[1]) < 16
    assert not any(meet(a, b) for i, a in enumerate(got) for b in got[:i])
    assert all(any(meet((y, x), g) for g in got) for _, y, x, *_ in rows)


def test_balanced_is_a_round_robin(spark):
    r = random.Random(3)
    rows = [(1, i, r.uniform(-5, 105), r.uniform(-5, 105), c / 1000) for i, c in enumerate(r.sample(range(1000), 300))] + [(2, i, -1.0, 200.0, 0.5) for i in range(7)]
    df = spark.createDataFrame(rows, "scene int, ord long, x1 double, y1 double, conf double")
    got = points.balanced(df, 100, 100, 4, 50).orderBy("scene", "place").collect()
    cells = {}
    for _, i, x, y, _ in sorted((q for q in rows if q[0] == 1), key=lambda q: -q[4]):
        if 0 <= x < 100 and 0 <= y < 100:
            cells.setdefault((min(3, int(y / 25)), min(3, int(x / 25))), []).append(i)
    want = []
    while len(want) < 50:
        want += [cells[k].pop(0) for k in sorted(cells) if cells[k]]
    assert [x.ord for x in got if x.scene == 1] == want[:50] and [x.ord for x in got if x.scene == 2] == list(range(7))


def test_thin_and_copies(spark):
    r = random.Random(4)
    rows = [(1, i, r.uniform(0, 20), r.uniform(0, 20), r.uniform(0, 100), r.uniform(0, 100), r.choice((0.1, 0.5))) for i in range(500)]
    df = spark.createDataFrame(rows, "scene int, ord long, x0 double, y0 double, x1 double, y1 double, conf double")
    n = points.spatial_thin(df, 10, 3, 100, 100).groupBy("cx", "cy").count().agg(F.max("count")).first()[0]
    assert n == 3
    keep = points.without_copies(df, ("x0", "y0"), 4.0).collect()
    assert len({(round(x.x0 / 4), round(x.y0 / 4)) for x in keep}) == len(keep)


def test_summary_has_all_classes(spark):
    df = spark.createDataFrame([("cloud",)] * 3 + [("clear",)], "pred_label string")
    assert [tuple(r) for r in classify.class_summary(df).collect()] == [("clear", 1, 0.25), ("cloud", 3, 0.75), ("shadow", 0, 0.0), ("snow", 0, 0.0)]
    assert classify.class_summary(df.limit(0)).first().fraction == 0
    px = spark.createDataFrame([(5.0, False), (float("nan"), True), (7.0, True)], "r double, valid boolean")
    assert [round(x.r, 4) for x in classify.normalised(px, ("r",), (5.0,), (2.0,)).collect()] == [0.0, 0.0, 1.0]


def test_reports(spark, tmp_path):
    rows = spark.createDataFrame([("a", 0, "s1", "FAILED"), ("b", 0, "s1", "OK"), ("b", 1, None, "x"), ("b", 2, "", "y")], "file string, pos int, scene string, status string")
    got = reports.merged(rows).orderBy("part", "scene", "file", "pos").collect()
    assert [(r.scene, r.status) for r in got][0] == ("s1", "OK") and len(got) == 3
    reports.appended(rows, str(tmp_path / "t"), "j1")
    reports.appended(rows, str(tmp_path / "t"), "j2")
    assert spark.read.parquet(str(tmp_path / "t")).groupBy("job_id").count().count() == 2


def test_batch_slices_like_a_list(spark):
    names = [f"s{i:02d}" for i in range(20)]
    df = spark.createDataFrame([(n,) for n in names], "scene string")
    for a, b in ((0, None), (3, 7), (-5, None), (None, -3), (-4, -1), (18, 99), (5, 2), (None, 0)):
        assert [r.scene for r in catalog.batch(df, a, b).orderBy("scene").collect()] == names[a:b], (a, b)


def test_spline_goes_through_its_points_and_filter_finds_the_outliers(spark):
    r = np.random.default_rng(5)
    src = r.uniform(0, 1000, (160, 2))
    dst = src + 5 * np.sin(src / 200)
    assert np.allclose(models.Spline(src, dst, 1000.0)(src), dst, atol=1e-6)
    bad = dst.copy()
    bad[:4] += 90
    pdf = pd.DataFrame({"scene": 1, "ord": range(160), "x0": src[:, 0], "y0": src[:, 1], "x1": bad[:, 0], "y1": bad[:, 1]})
    got = models.spline_filter(spark.createDataFrame(pdf), 1000, 1000, block=250, need=12, strong=120).first()
    assert got.ok and 130 <= got.n_inliers <= 156 and got.median_px < 6 and got.p90_px < 6
    few = models.spline_filter(spark.createDataFrame(pdf.head(5)), 1000, 1000).first()
    assert few.reason == "too_few_matches_before_iteration(5)" and few.n_iters == 0


@pytest.mark.parametrize("kind", ["homography", "affine"])
def test_ransac(kind):
    r = np.random.default_rng(6)
    p0 = r.uniform(0, 500, (120, 2))
    h = np.array([[1.01, 0.02, 5], [-0.03, 0.98, -7], [1e-5 if kind == "homography" else 0, 0, 1]])
    q = np.column_stack((p0, np.ones(120))) @ h.T
    p1 = q[:, :2] / q[:, 2:] + r.normal(0, 0.3, (120, 2))
    p1[:40] += r.uniform(30, 200, (40, 2))
    m = models.ransac(p0, p1, kind, 3.0, 2000, 0.999, 1)
    assert (models.residuals(m, p0, p1) <= 3)[40:].all() and not (models.residuals(m, p0, p1) <= 3)[:40].any()
    assert models.ransac(p0[:2], p1[:2], kind, 3.0, 10, 0.99, 1) is None


def test_resampling_keeps_the_identity(spark):
    t = {"a": 2.0, "b": 0.0, "c": 5.0, "d": 0.0, "e": -2.0, "f": 9.0}
    px = spark.createDataFrame([(i, j, float(10 * i + j)) for i in range(5) for j in range(6)], "row int, col int, value double")
    g = coverage.dense_grid(spark, 5, 6)
    want = sorted(map(tuple, px.collect()))
    assert sorted(map(tuple, raster.nearest(g, px, t, t).collect())) == sorted(map(tuple, raster.bilinear(g, px, t, t).collect())) == want


def test_stretch_rules(spark):
    px = spark.createDataFrame([(1, float(i), i != 3) for i in range(50)], "scene int, v double, valid boolean")
    assert raster.stretched(px, ("v",), 100, "truncate").agg(F.max("v")).first()[0] == 0
    assert raster.stretched(px, ("v",), 10, "truncate").agg(F.max("v")).first()[0] >= 254
    with pytest.raises(Exception, match="too few valid pixels"):
        raster.stretched(px, ("v",), 100, "round").collect()


def tiff(path, width, height):
    tags = [(256, 4, 1, width), (257, 4, 1, height), (277, 3, 1, 4)]
    data = struct.pack("<3d", 2.0, 2.0, 0.0) + struct.pack("<6d", 0, 0, 0, 500000.0, 4600000.0, 0) + b"-9999\0"
    at = 8 + 2 + 12 * 6 + 4
    tags += [(33550, 12, 3, at), (33922, 12, 6, at + 24), (42113, 2, 6, at + 72)]
    path.write_bytes(b"II" + struct.pack("<HI", 42, 8) + struct.pack("<H", 6) + b"".join(struct.pack("<HHII", *t) for t in tags) + b"\0" * 4 + data)


def test_sources(spark, tmp_path):
    (tmp_path / "list.txt").write_text("# note\n  a/b/s1/ \n\ns2\ns1\n")
    got = catalog.scene_list(files.lines(spark, str(tmp_path / "list.txt"))).orderBy("pos").collect()
    assert [r.scene for r in got] == ["s1", "s2"]
    (tmp_path / "m.json").write_text(json.dumps({"scene": "s", "pts_mov_on_ref": [[1, 2], [3, 4]], "pts_ref": [[1, 2], [3, 5]], "confidence": []}))
    assert [(r.ord, r.x1, r.y1, r.conf) for r in files.matches(spark, str(tmp_path / "m.json")).collect()] == [(0, 1.0, 2.0, 1.0), (1, 3.0, 5.0, 1.0)]
    (tmp_path / "bad.json").write_text(json.dumps({"scene": "s", "pts_mov_on_ref": [[1, 2]], "pts_ref": [], "confidence": [1.0]}))
    with pytest.raises(Exception, match="different lengths"):
        files.matches(spark, str(tmp_path / "bad.json")).collect()
    (tmp_path / "c.json").write_text(json.dumps({"s1": {"overlap": 0.5, "directions": ["W"]}, "s2": {"overlap": 0.1}}))
    assert sorted((r.scene, r.overlap, r.directions) for r in files.configuration(spark, str(tmp_path / "c.json")).collect()) == [("s1", 0.5, ["W"]), ("s2", 0.1, None)]
    for i in range(3):
        tiff(tmp_path / f"x_{i}.tif", 10 + i, 20)
    assert files.listing(spark, str(tmp_path)).count() == 3
    spark.dataSource.register(files.HeaderSource)
    h = spark.read.format("raster_header").option("paths", "\n".join(str(tmp_path / f"x_{i}.tif") for i in range(3))).load().orderBy("path").collect()
    assert [(r.width, r.height, r.bands, r.a, r.e, r.c, r.f, r.nodata) for r in h][1] == (11, 20, 4, 2.0, -2.0, 500000.0, 4600000.0, -9999.0)


def test_streams(spark, tmp_path):
    src = tmp_path / "in"
    schema = "file long, pos long, scene string, status string"
    for i, rows in enumerate(([(1, 0, "a", "FAILED"), (1, 1, "b", "OK")], [(2, 0, "a", "OK"), (2, 1, None, "x")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(src))
        q = incremental.keep_last_reports(spark.readStream.schema(schema).json(str(src)), str(tmp_path / "out"), str(tmp_path / "cp"))
        q.awaitTermination()
    got = {(r.scene, r.status) for r in spark.read.schema(schema).parquet(str(tmp_path / "out" / "1")).collect()}
    assert got == {("a", "OK"), ("b", "OK"), (None, "x")}
    name = "20230307T102907_20230307T102909_SAT_x_"
    spark.createDataFrame([(f"/d/{name}{b}.tif", "2024-01-01 00:00:00") for b in "RGRB"], "path string, seen string").selectExpr("path", "timestamp(seen) seen").coalesce(1).write.parquet(str(tmp_path / "files"))
    stream = spark.readStream.schema("path string, seen timestamp").parquet(str(tmp_path / "files"))
    q = incremental.new_bands(stream).writeStream.format("memory").queryName("bands").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r.band for r in spark.table("bands").collect()) == ["B", "G", "R"]


def test_empty_inputs(spark):
    m = spark.createDataFrame([], "scene int, ord long, x0 double, y0 double, x1 double, y1 double, conf double")
    for df in (points.spatial_thin(m, 8, 2, 9, 9), points.without_copies(m, ("x0",), 1.0), points.confidence_gate(m, 0.1, 50), points.balanced(m, 9, 9, 2, 4), points.merge_stats(m, 1.0), points.coverage_ratio(m, 3, 9, 9), models.ransac_filter(m), models.spline_filter(m, 9, 9)):
        assert df.count() == 0
    s = spark.createDataFrame([], "scene_id string, acq_day string, minx double, miny double, maxx double, maxy double")
    assert grid.blocks(s, 10.0, 1.0).count() == 0 and grid.block_scenes(grid.blocks(s, 10.0, 1.0), s, 10.0, 1.0).count() == 0


def test_block_scenes_match_the_plain_comparison(spark):
    r = random.Random(8)
    rows = [(f"s{i}", "d", x := r.randrange(0, 4000) / 10 - 100, y := r.randrange(0, 4000) / 10 - 100, x + r.choice((0.0, 5.0, 170.0)), y + r.choice((0.0, 30.0))) for i in range(150)]
    s = spark.createDataFrame(rows, "scene_id string, acq_day string, minx double, miny double, maxx double, maxy double")
    for margin in (0.0, 5.0, 65.0):
        b = grid.blocks(s, 50.0, margin)
        got = sorted((x.block_id, x.scene_id) for x in grid.block_scenes(b, s, 50.0, margin).collect())
        want = sorted((k.block_id, q[0]) for k in b.collect() for q in rows if q[2] <= k.expanded_maxx and q[4] >= k.expanded_minx and q[3] <= k.expanded_maxy and q[5] >= k.expanded_miny)
        assert got == want and math.isclose(b.first().expanded_minx, b.first().core_minx - margin)
