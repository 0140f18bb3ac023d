"""Previews: the kernel's two passes against a direct sum, area means, and canvases."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.operators import preview

SIZES = "name string, width int, height int, out_width int, out_height int"


def weights(n, out):
    """Weights of one axis in plain Python."""
    scale = n / out
    wide = max(scale, 1.0)
    rows = []
    for o in range(out):
        mid = (o + 0.5) * scale
        lo, hi = max(int(mid - 3 * wide + 0.5), 0), min(int(mid + 3 * wide + 0.5), n)
        w = []
        for i in range(lo, hi):
            x = (i - mid + 0.5) / wide
            w.append(1.0 if x == 0 else math.sin(math.pi * x) * math.sin(math.pi * x / 3) * 3 / (math.pi * x) ** 2 if abs(x) < 3 else 0.0)
        rows.append((lo, [int(k / sum(w) * 2**22 + (0.5 if k >= 0 else -0.5)) for k in w]))
    return rows


def direct(x, out_w, out_h):
    """Byte image by two direct sums."""
    def along(y, n, out):
        if n == out:
            return y
        return np.array([[min(max((sum(int(v) * k for v, k in zip(line[lo : lo + len(ks)], ks, strict=True)) + 2**21) >> 22, 0), 255) for lo, ks in weights(n, out)] for line in y])

    return along(along(x, x.shape[1], out_w).T, x.shape[0], out_h).T


def rows(spark, images):
    return spark.createDataFrame([(n, r, q, int(x[r, q]), 255 - int(x[r, q]), bool(ok[r, q])) for n, (x, ok) in images.items() for r in range(x.shape[0]) for q in range(x.shape[1])], "name string, row int, col int, r int, g int, valid boolean")


def image(h, w, seed):
    r = np.random.default_rng(seed)
    return r.integers(0, 256, (h, w)), r.random((h, w)) < 0.8


def test_kernel_passes_equal_direct_sums(spark):
    images = {"a": image(37, 61, 1), "b": image(20, 20, 2), "c": image(9, 50, 3)}
    to = {"a": (23, 14), "b": (20, 20), "c": (17, 9)}
    df = rows(spark, images)
    sizes = spark.createDataFrame([(n, x.shape[1], x.shape[0], *to[n]) for n, (x, _) in images.items()], SIZES)
    got = {(r.name, r.row, r.col): (r.r, r.g) for r in preview.resized(df, sizes, ("r", "g")).collect()}
    for n, (x, _) in images.items():
        a, b = direct(x, *to[n]), direct(255 - x, *to[n])
        assert a.shape == (to[n][1], to[n][0])
        assert all(got.pop((n, r, q)) == (a[r, q], b[r, q]) for r in range(a.shape[0]) for q in range(a.shape[1]))
    assert not got


def test_area_means_equal_direct_sums(spark):
    x, ok = image(31, 45, 4)
    sizes = spark.createDataFrame([("a", 45, 31, 13, 7)], SIZES)
    got = {(r.row, r.col): r.r for r in preview.averaged(rows(spark, {"a": (x, ok)}), sizes, ("r",)).collect()}
    cover = lambda n, out: np.array([[max(0.0, min((i + 1) * out / n, o + 1) - max(i * out / n, o)) for i in range(n)] for o in range(out)])
    wy, wx = cover(31, 7), cover(45, 13)
    want = (wy @ (x * ok) @ wx.T) / (wy @ ok @ wx.T)
    assert got.keys() == {(r, q) for r in range(7) for q in range(13)} and all(got[k] == pytest.approx(want[k]) for k in got)


def test_whole_previews_and_canvas(spark):
    x, ok = image(40, 80, 5)
    df = rows(spark, {"a": (x, ok)}).withColumn("b", F.lit(7))
    grids = spark.createDataFrame([("a", 80, 40)], "name string, width int, height int")
    small, sizes = preview.reference_preview(df, grids, 30)
    assert (sizes.first().out_width, sizes.first().out_height) == (30, 15) and small.count() == 450
    low, high = np.percentile(x[ok], (2, 98))
    y = np.where(ok, np.floor(np.clip((x - low) / (high - low + 1e-8), 0, 1) * 255), 0).astype(int)
    want = direct(y, 30, 15)
    assert all(want[r.row, r.col] == r.r for r in small.collect())
    other = preview.georeferenced_preview(df, grids, 20)
    assert other.count() == 200 and other.agg(F.max("r")).first()[0] == 255
    both = preview.side_by_side(small, other.select(*small.columns), sizes.select("name", F.col("out_width").alias("width")))
    assert both.count() == 650 and both.agg(F.max("col")).first()[0] == 49
