"""Coarse-to-fine matching: states, fitted models, windows over masks."""

import numpy as np
from pyspark.sql import functions as F

from geoloom.operators import refine
from geoloom.plans import refine as plans

SF = "/root/testdata/sf0.001"


def test_all_nine_states_come_up(spark):
    got = {r.status for r in plans.tile_states(spark, SF).select("status").distinct().collect()}
    assert got == {"skip_small", "skip_low_valid", "skip_empty_pred_window", "skip_empty_ref", "zero_raw", "worker_error", "rejected_by_tile_filter", "rejected_by_prior_gate", "used_refined"}


def test_each_scene_has_its_own_model(spark):
    r = np.random.default_rng(1)
    rows = []
    for scene, (dx, dy) in {1: (5.0, -3.0), 2: (40.0, 8.0)}.items():
        p = r.uniform(0, 500, (60, 2))
        q = p + (dx, dy)
        q[:10] += r.uniform(50, 90, (10, 2))
        rows += [(scene, i, *map(float, p[i]), *map(float, q[i]), 0.9) for i in range(60)]
    rows.append((3, 0, 0.0, 0.0, 1.0, 1.0, 0.5))
    df = spark.createDataFrame(rows, "scene long, ord long, x0 double, y0 double, x1 double, y1 double, conf double")
    found = {x.scene: x.h for x in refine.fitted(df).collect()}
    assert found[3] is None
    at = spark.createDataFrame([(k, found[k]) for k in (1, 2)], "scene long, h array<double>").select("scene", *[v.alias(n) for n, v in zip("xy", refine.mapped(F.col("h"), F.lit(100.0), F.lit(200.0)), strict=True)])
    got = {x.scene: (x.x, x.y) for x in at.collect()}
    assert np.allclose(got[1], (105, 197), atol=1e-6) and np.allclose(got[2], (140, 208), atol=1e-6)
    images = spark.createDataFrame([(1, 300, 300), (2, 300, 300), (3, 300, 300)], "scene long, h int, w int")
    every = spark.createDataFrame([(s, y, x) for s in (1, 2, 3) for y in range(0, 300) for x in (0, 150, 299)], "scene long, row int, col int")
    plan = refine.tile_plan(images, spark.createDataFrame(list(found.items()), "scene long, h array<double>"), every, every, 200, 50, 64, 0.0, 10)
    windows = {(x.scene, x.tile_id): (x.ry0, x.ry1, x.rx0, x.rx1) for x in plan.collect()}
    assert {k for k, _ in windows} == {1, 2}
    near = lambda a, b: max(abs(x - y) for x, y in zip(a, b, strict=True)) <= 1  # noqa: E731  a whole number may be met from either side
    assert near(windows[1, 0], (0, 207, 0, 215)) and near(windows[2, 3], (98, 300, 130, 300))


def test_window_fractions_equal_brute_force(spark):
    r = np.random.default_rng(3)
    mask = r.random((30, 40)) < 0.4
    windows = [(1, i, *sorted(r.integers(0, 31, 2).tolist()), *sorted(r.integers(0, 41, 2).tolist())) for i in range(40)]
    df = spark.createDataFrame(windows, "scene long, tile_id int, a int, b int, p int, q int")
    valid = spark.createDataFrame([(1, int(y), int(x)) for y, x in zip(*np.nonzero(mask), strict=True)] * 2, "scene long, row int, col int")
    got = {x.tile_id: x.share for x in refine.valid_fractions(df, valid, "share", ("a", "b", "p", "q")).collect()}
    for _, i, a, b, p, q in windows:
        part = mask[a:b, p:q]
        assert got[i] is None if not part.size else abs(got[i] - part.mean()) < 1e-12
