"""Warps by blocks against every pixel's exact place."""

import numpy as np
import pytest

from geoloom.functions import geodesy
from geoloom.operators import raster, warp
from geoloom.operators.models import Spline

GRID = warp.GRID


def image(h, w, seed=0, holes=0.05):
    r = np.random.default_rng(seed)
    x = np.add.outer(np.sin(np.arange(h) / 7) * 40, np.cos(np.arange(w) / 9) * 30) + r.normal(0, 3, (h, w))
    return x, r.random((h, w)) >= holes


def pixels(spark, images):
    rows = [(n, r, q, float(x[r, q]), float(-2 * x[r, q]), bool(ok[r, q])) for n, (x, ok) in images.items() for r in range(x.shape[0]) for q in range(x.shape[1])]
    return spark.createDataFrame(rows, "name string, row int, col int, v double, w double, valid boolean")


def at_places(x, ok, sx, sy, kernel):
    """Values at exact source places, pixel by pixel."""
    out = {}
    for (r, q), px, py in zip(np.ndindex(*sx.shape), sx.ravel(), sy.ravel(), strict=True):
        half = 0.5 if kernel == "bilinear" else 0.0
        c0, r0, near = int(np.floor(px - half)), int(np.floor(py - half)), []
        fx, fy = px - half - c0, py - half - r0
        for i, j, w in ([(0, 0, 1.0)] if kernel == "nearest" else [(i, j, (fy if i else 1 - fy) * (fx if j else 1 - fx)) for i in (0, 1) for j in (0, 1)]):
            if w > 1e-9 and 0 <= r0 + i < x.shape[0] and 0 <= c0 + j < x.shape[1] and ok[r0 + i, c0 + j]:
                near.append((w, x[r0 + i, c0 + j]))
        if near:
            out[r, q] = sum(w * v for w, v in near) / sum(w for w, _ in near)
    return out


def centres(h, w):
    return np.meshgrid(np.arange(w) + 0.5, np.arange(h) + 0.5)


@pytest.mark.parametrize("kernel", ["bilinear", "nearest"])
def test_same_system_equals_every_pixel(spark, kernel):
    x, ok = image(70, 90)
    src, dst = (2.0, 0.0, 100.0, 0.0, -2.0, 400.0), (3.1371, 0.2113, 90.0171, -0.1093, -2.7177, 410.0313)
    df = pixels(spark, {"a": (x, ok)})
    got = warp.to_grid(df, spark.createDataFrame([("a", 90, 70, *src, 32638)], GRID), spark.createDataFrame([("a", 80, 60, *dst, 32638)], GRID), ("v", "w"), kernel, 32)
    sx, sy = warp.invert(src, *warp.apply(dst, *centres(60, 80)))
    want = at_places(x, ok, sx, sy, kernel)
    rows = {(r.row, r.col): (r.v, r.w) for r in got.collect()}
    assert rows.keys() == want.keys()
    assert max(abs(rows[k][0] - want[k]) + abs(rows[k][1] + 2 * want[k]) for k in want) < 1e-8


def test_same_system_equals_the_join_by_pixel(spark):
    x, ok = image(40, 40, 2, 0)
    keys = dict(zip("abcdef", (2.0, 0.0, 100.0, 0.0, -2.0, 400.0), strict=True)), dict(zip("abcdef", (1.5, 0.0, 101.0, 0.0, -1.5, 397.0), strict=True))
    df = pixels(spark, {"a": (x, ok)})
    grid = spark.createDataFrame([(r, q) for r in range(30) for q in range(30)], "row int, col int")
    want = {(r.row, r.col): r.value for r in raster.bilinear(grid, df.selectExpr("row", "col", "v AS value"), *keys).collect() if r.value is not None}
    got = warp.to_grid(df, spark.createDataFrame([("a", 40, 40, *keys[0].values(), 32638)], GRID), spark.createDataFrame([("a", 30, 30, *keys[1].values(), 32638)], GRID), ("v",), side=16)
    rows = {(r.row, r.col): r.v for r in got.collect()}
    assert rows.keys() == want.keys() and max(abs(rows[k] - want[k]) for k in want) < 1e-9


@pytest.mark.parametrize("source,target", [(32638, 32639), (4326, 32638), (32638, 4326), (32733, 32734)])
def test_between_systems_within_an_eighth_of_a_pixel(source, target):
    """The lattice against the exact place of each pixel, over a block far from both middles."""
    lon, lat = (47.9, 40.2) if target != 32734 else (17.9, -33.0)
    x0, y0 = (np.array([k]) for k in (lon, lat))
    tx, ty = geodesy.between(x0, y0, 4326, target)
    sx, sy = geodesy.between(x0, y0, 4326, source)
    step = lambda e: 1e-4 if e == 4326 else 10.0
    row = dict(zip("abcdef", (step(target), 0, tx[0], 0, -step(target), ty[0]), strict=True)) | dict(zip(("s_a", "s_b", "s_c", "s_d", "s_e", "s_f"), (step(source), 0, sx[0] - 3000 * step(source), 0, -step(source), sy[0] + 3000 * step(source)), strict=True)) | {"epsg": target, "s_epsg": source}
    exact = warp.by_system(row)
    for top, left in ((0, 0), (5120, 10240)):
        at = warp.lattice(exact, top, left, 256, 256)
        xx, yy = np.meshgrid(np.arange(256) + left + 0.5, np.arange(256) + top + 0.5)
        want = np.stack(exact(xx.ravel(), yy.ravel())).reshape(2, 256, 256)
        assert np.hypot(*(at - want)).max() <= 0.125


def test_pixels_between_zones(spark):
    x, ok = image(60, 60, 4)
    cx, cy = geodesy.between(np.array([47.95]), np.array([40.2]), 4326, 32638)
    tx, ty = geodesy.between(np.array([47.95]), np.array([40.2]), 4326, 32639)
    src, dst = (10.0, 0.0, float(cx[0]) - 300, 0.0, -10.0, float(cy[0]) + 300), (10.0, 0.0, float(tx[0]) - 300, 0.0, -10.0, float(ty[0]) + 300)
    got = warp.to_grid(pixels(spark, {"a": (x, ok)}), spark.createDataFrame([("a", 60, 60, *src, 32638)], GRID), spark.createDataFrame([("a", 60, 60, *dst, 32639)], GRID), ("v",), side=32)
    sx, sy = warp.invert(src, *geodesy.between(*warp.apply(dst, *centres(60, 60)), 32639, 32638))
    want = at_places(x, ok, sx, sy, "bilinear")
    rows = {(r.row, r.col): r.v for r in got.collect()}
    both = rows.keys() & want.keys()
    assert len(both) > 2500 and len(rows.keys() ^ want.keys()) < 60
    assert np.median([abs(rows[k] - want[k]) for k in both]) < 0.5


def test_spline_equals_the_dense_sum_over_the_whole_image(spark):
    r = np.random.default_rng(7)
    x, ok = image(96, 128, 5, 0)
    src = (2.0, 0.0, 1000.0, 0.0, -2.0, 9000.0)
    pts = np.column_stack((r.uniform(0, 128, 150), r.uniform(0, 96, 150)))
    mx, my = warp.apply(src, pts[:, 0] + 2 * np.sin(pts[:, 1] / 20), pts[:, 1] + 2 * np.cos(pts[:, 0] / 25))
    points = spark.createDataFrame([("a", i, float(a), float(b), float(p), float(q)) for i, (a, b, (p, q)) in enumerate(zip(mx, my, pts, strict=True))], "name string, ord int, mx double, my double, sx double, sy double")
    sources = spark.createDataFrame([("a", 128, 96)], "name string, width int, height int")
    grids = spark.createDataFrame([("a", 128, 96, *src, 32638), ("none", 16, 16, *src, 32638)], GRID)
    got = warp.by_control_points(pixels(spark, {"a": (x, ok)}), sources, points, grids, ("v",), side=32, bound=0.02)
    at = np.column_stack([k.ravel() for k in warp.apply(src, *centres(96, 128))])
    mid = (np.array([mx.min(), my.min()]) + np.array([mx.max(), my.max()])) / 2
    dense = Spline(np.column_stack((mx, my)) - mid, pts, float(max(mx.max() - mx.min(), my.max() - my.min())))(at - mid)
    sx, sy = (dense[:, k].reshape(96, 128) for k in (0, 1))
    row = {k: v for k, v in zip("abcdef", src, strict=True)} | warp.splines(points).first().asDict()
    whole = np.concatenate([np.concatenate([warp.lattice(warp.by_spline(row), a, b, 32, 32, 0.02) for b in range(0, 128, 32)], axis=2) for a in range(0, 96, 32)], axis=1)
    assert np.hypot(whole[0] - sx, whole[1] - sy).max() <= 0.02
    want, rows = at_places(x, ok, sx, sy, "bilinear"), {(k.row, k.col): k.v for k in got.collect()}
    both = rows.keys() & want.keys()
    assert len(both) > 0.98 * len(want) and len(rows.keys() ^ want.keys()) < 60
    assert max(abs(rows[k] - want[k]) for k in both) < 0.02 * 2 * 45


def test_images_without_overlap_or_points_have_no_rows(spark):
    x, ok = image(20, 20)
    t = (1.0, 0.0, 0.0, 0.0, -1.0, 0.0)
    df, src = pixels(spark, {"a": (x, ok)}), spark.createDataFrame([("a", 20, 20, *t, 32638)], GRID)
    assert warp.to_grid(df, src, spark.createDataFrame([("a", 20, 20, 1.0, 0.0, 500.0, 0.0, -1.0, 0.0, 32638)], GRID), ("v",), side=16).count() == 0
    assert warp.to_grid(df, src, src.limit(0), ("v",), side=16).count() == 0
    few = spark.createDataFrame([("a", 0, 0.0, 0.0, 1.0, 1.0), ("a", 1, 1.0, 0.0, 1.0, 1.0)], "name string, ord int, mx double, my double, sx double, sy double")
    assert warp.by_control_points(df, src, few, src, ("v",), side=16).count() == 0
