"""Reference systems: columns and arrays agree over 10,000 places of both halves, local and scanned, composed both ways."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.functions import columns, geodesy
from geoloom.operators import grid


@pytest.fixture(scope="module")
def places():
    r = np.random.default_rng(0)
    zone, south = r.integers(1, 61, 10_000), r.random(10_000) < 0.5
    lon, lat = zone * 6 - 183 + r.uniform(-3.2, 3.2, 10_000), r.uniform(0, 84, 10_000) * np.where(south, -0.95, 1)
    epsg = np.where(south, 32700, 32600) + zone
    xy = np.array([geodesy.to_utm(np.array([a]), np.array([b]), int(e)) for a, b, e in zip(lon, lat, epsg, strict=True)])[:, :, 0]
    return zone, south, lon, lat, xy


def test_arrays_go_there_and_back(places):
    zone, south, lon, lat, xy = places
    assert geodesy.to_utm(np.array([15.0]), np.array([0.0]), 32633) == (pytest.approx(500000), pytest.approx(0, abs=1e-6))
    back = np.array([geodesy.from_utm(np.array([x]), np.array([y]), int((32700 if s else 32600) + z)) for (x, y), s, z in zip(xy, south, zone, strict=True)])[:, :, 0]
    assert np.abs(back[:, 0] - lon).max() < 1e-10 and np.abs(back[:, 1] - lat).max() < 1e-10
    with pytest.raises(ValueError, match="unknown reference system"):
        geodesy.between(np.zeros(1), np.zeros(1), 3857, 4326)


def test_columns_agree_with_arrays_and_compose(spark, places, tmp_path):
    zone, south, lon, lat, xy = places
    rows = [(i, int(z), bool(s), float(a), float(b), float(x), float(y)) for i, (z, s, a, b, (x, y)) in enumerate(zip(zone, south, lon, lat, xy, strict=True))]
    local = spark.createDataFrame(rows, "i int, zone int, south boolean, lon double, lat double, x double, y double")
    local.write.parquet(str(tmp_path / "p"))
    for df in (local, spark.read.parquet(str(tmp_path / "p"))):
        there = columns.utm_place(F.col("lon"), F.col("lat"), F.col("zone"), F.col("south"))
        back = columns.wgs84_from_utm(F.col("x"), F.col("y"), F.col("zone"), F.col("south"))
        again = columns.utm_from_wgs84(*back, F.col("zone"), F.col("south"))
        began = time.perf_counter()
        far = df.select(F.greatest(F.abs(there["x"] - F.col("x")), F.abs(there["y"] - F.col("y"))).alias("there"), F.greatest(*[F.abs(a - F.col(b)) for a, b in zip(back, ("lon", "lat"), strict=True)]).alias("back"), F.greatest(*[F.abs(a - F.col(b)) for a, b in zip(again, "xy", strict=True)]).alias("again"))
        most = far.agg(*[F.max(k).alias(k) for k in far.columns]).first()
        assert time.perf_counter() - began < 20
        assert most.there < 1e-6 and most.back < 1e-10 and most.again < 1e-6


def test_boxes_between_zones(spark):
    boxes = spark.createDataFrame([(1, "EPSG:32638", 500000.0, 4400000.0, 510000.0, 4410000.0), (2, "EPSG:4326", 44.0, 40.0, 44.1, 40.1), (3, "EPSG:32639", 1.0, 2.0, 3.0, 4.0)], "k int, crs string, minx double, miny double, maxx double, maxy double")
    got = {r.k: (r.minx, r.miny, r.maxx, r.maxy) for r in grid.reprojected(boxes, "k", "EPSG:32639").collect()}
    f = np.arange(21) / 20
    for k, epsg, (w, s, e, n) in ((1, 32638, (500000.0, 4400000.0, 510000.0, 4410000.0)), (2, 4326, (44.0, 40.0, 44.1, 40.1))):
        x = np.concatenate((w + (e - w) * f, w + (e - w) * f, np.full(21, w), np.full(21, e)))
        y = np.concatenate((np.full(21, s), np.full(21, n), s + (n - s) * f, s + (n - s) * f))
        u, v = geodesy.between(x, y, epsg, 32639)
        assert got[k] == pytest.approx((u.min(), v.min(), u.max(), v.max()), abs=1e-5)
    assert got[3] == (1.0, 2.0, 3.0, 4.0)
