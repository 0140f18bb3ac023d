"""Boxes in other reference systems: edge points stay in the batch of their box, and nulls, NaN and repeated keys count as in Spark's min and max."""

import math
import os
import subprocess
import sys
import time
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.functions import geodesy
from geoloom.operators import grid


def around(move, w, s, e, n):
    """The box around moved edge points, point by point; a point with an unknown coordinate doesn't count."""
    at = []
    for i in range(21):
        x, y = (None if None in (a, b) else a + (b - a) * (i / 20) for a, b in ((w, e), (s, n)))
        at += [(x, s), (x, n), (w, y), (e, y)]
    at = [move(x, y) for x, y in at if x is not None and y is not None]
    return tuple(f(k[i] for k in at) for f in (min, max) for i in (0, 1)) if at else (None,) * 4


def forward(x, y):
    return tuple(map(float, geodesy.forward(np.array(x), np.array(y), 38, False)))


def met(spark):
    df = spark.range(20_000).select("id", (F.col("id") % 400 * 250 + 400_000).cast("double").alias("minx"), (F.col("id") % 700 * 250 + 3e6).alias("miny"), (F.col("id") % 60 + 1).alias("z"), F.lit("EPSG:32637").alias("crs"))
    return df.withColumn("maxx", F.col("minx") + 5000).withColumn("maxy", F.col("miny") + 5000)


def quick(found, condition):
    """20,000 boxes took 25 to 70 s when each edge point was a row of its own and went through interpreted lambdas."""
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in plan and "lambda" not in plan and plan.count("Repartition") == 1
    began = time.perf_counter()
    assert found.where(condition).count() == 20_000
    assert time.perf_counter() - began < 20


def test_reprojected_boxes_take_seconds(spark):
    quick(grid.reprojected(met(spark), "id", "EPSG:32638"), "minx < maxx")


def test_reprojected_boxes_with_unknown_corners_and_repeated_keys(spark):
    boxes = {1: (44.0, 40.0, 44.5, 40.5), 2: (None, 40.0, 44.5, 40.5), 3: (44.0, 40.0, 44.5, None), 4: (None, None, 44.5, 40.5), 5: (None,) * 4}
    rows = [(k, "EPSG:4326", *b) for k, b in boxes.items()] + [(6, "EPSG:4326", 44.0, 40.0, 44.1, 40.1), (6, "EPSG:32638", 100.0, 9e6, 200.0, 9.1e6), (7, "EPSG:32638", None, 1.0, 5.0, 2.0), (8, "EPSG:32638", math.nan, 1.0, 5.0, 2.0)]
    df = spark.createDataFrame(rows, "k int, crs string, minx double, miny double, maxx double, maxy double")
    got = {r.k: tuple(r)[1:] for r in grid.reprojected(df, "k", "EPSG:32638").collect()}
    for k, b in boxes.items():
        want = around(forward, *b)
        assert got[k] == (want if want[0] is None else pytest.approx(want, abs=1e-6))
    low = around(forward, 44.0, 40.0, 44.1, 40.1)
    assert got[6] == pytest.approx((100.0, low[1], low[2], 9.1e6), abs=1e-6)
    assert got[7] == (5.0, 1.0, 5.0, 2.0)
    assert got[8][0] == 5.0 and got[8][1] == 1.0 and math.isnan(got[8][2]) and got[8][3] == 2.0


def test_places_between_systems_by_row(spark):
    rows = [(1, 44.0, 40.0, 4326, 32638), (2, 5e5, 4.4e6, 32637, 32638), (3, 5e5, 4.4e6, 32637, 4326), (4, 7.0, 8.0, 32637, 32637), (5, None, 8.0, 32637, 32637), (6, None, 40.0, 4326, 32638)]
    df = spark.createDataFrame(rows, "k int, x double, y double, a int, b int")
    q = df.select("k", grid.between_systems(F.col("x"), F.col("y"), F.col("a"), F.col("b")).alias("p"))
    assert "lambda" not in q._jdf.queryExecution().optimizedPlan().toString()
    got = {r.k: tuple(r.p) for r in q.collect()}
    for k, x, y, a, b in rows[:4]:
        assert got[k] == pytest.approx([float(v) for v in geodesy.between(np.array(x), np.array(y), a, b)], abs=1e-6)
    assert got[5] == (None, 8.0) and got[6] == (None, None)
    with pytest.raises(Exception, match="unknown reference system: 3857 or"):
        df.select(grid.between_systems(F.col("x"), F.col("y"), F.lit(3857), F.col("b"))).collect()


def test_wgs84_bounds_take_seconds(spark):
    quick(grid.wgs84_bounds(met(spark), "id", F.col("z"), F.lit(False)), "west < east")


def test_wgs84_bounds_without_a_zone(spark):
    df = spark.createDataFrame([(1, 5e5, 4e6, 5.1e5, 4.1e6, 38, False), (2, 5e5, 4e6, 5.1e5, 4.1e6, None, None)], "k int, minx double, miny double, maxx double, maxy double, z int, s boolean")
    got = {r.k: tuple(r)[1:] for r in grid.wgs84_bounds(df, "k", F.col("z"), F.col("s")).collect()}
    assert got[1][0] == pytest.approx(45.0) and got[2] == (None, got[1][1], None, got[1][3])


def test_utm_bounds_take_seconds(spark):
    deg = spark.range(20_000).select("id", (F.col("id") % 350 - 175).cast("double").alias("west"), (F.col("id") % 120 - 60).cast("double").alias("south"))
    quick(grid.utm_bounds(deg.withColumn("east", F.col("west") + 0.5).withColumn("north", F.col("south") + 0.25), "id"), "minx < maxx")


def test_utm_bounds_without_a_corner(spark):
    df = spark.createDataFrame([(1, 44.0, 40.0, 44.5, 40.5), (2, None, 40.0, 44.5, 40.5)], "k int, west double, south double, east double, north double")
    got = {r.k: tuple(r)[1:] for r in grid.utm_bounds(df, "k").collect()}
    assert got[2] == (None,) * 5 and got[1] == pytest.approx((38, *around(forward, 44.0, 40.0, 44.5, 40.5)), abs=1e-6)


def test_workers_need_no_package(tmp_path):
    """A driver that has the package by sys.path alone, in a folder of its own."""
    root = str(Path(grid.__file__).resolve().parents[2])
    code = f"""import sys
sys.path.insert(0, {root!r})
from geoloom import session
from geoloom.plans import registry
s = session.build("local[2]", 2)
for name in ("q_reprojected", "q_wgs84_bounds", "q_utm_bounds", "q_band_control_points"):
    print(name, registry.QUERIES[name](s, "/root/testdata/sf0.001").count(), len(registry.QUERIES[name](s, "/root/testdata/sf0.001").take(1)))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=150)
    assert done.returncode == 0, done.stderr[-2000:]
    assert [x.split()[-1] for x in done.stdout.splitlines()] == ["1"] * 4
