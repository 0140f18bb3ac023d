"""Previews: images made smaller by a separable windowed kernel or by area means, stretched to bytes, and put side by side."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.columns import c, d, preview_side
from geoloom.operators import raster

#: Lobes of the kernel, and bits behind the point of its weights (they are whole numbers, so sums are exact).
LOBES, BITS = 3, 22


def truncated_side(side: Column, width: Column, height: Column, most: int) -> Column:
    """Side of a preview whose longer side is at most `most`, cut down to a whole number, as preview_side() rounds it."""
    return (side * F.least(d(1), d(most) / F.greatest(width, height).cast("double"))).cast("int")


def kernel(x: Column) -> Column:
    """sinc(x) sinc(x / 3) inside three units, else 0."""
    a = d(math.pi) * x
    inside = F.sin(a) * F.sin(a / d(LOBES)) * d(LOBES) / (a * a)
    return F.when(x == 0, d(1)).when(F.abs(x) < d(LOBES), inside).otherwise(d(0))


def axis_weights(sizes: DataFrame, side: str, out: str) -> DataFrame:
    """name, o (place along the smaller axis), i (place along the axis), k (whole weight) of images (name, and their sides before and after)."""
    scale = c(side).cast("double") / c(out).cast("double")
    wide = F.greatest(scale, d(1))
    e = sizes.select("name", c(side).alias("n"), scale.alias("scale"), wide.alias("wide"), F.explode(F.sequence(F.lit(0), c(out) - 1)).alias("o"))
    e = e.withColumn("mid", (c("o") + d(0.5)) * c("scale"))
    first = F.greatest((c("mid") - d(LOBES) * c("wide") + d(0.5)).cast("int"), F.lit(0))
    last = F.least((c("mid") + d(LOBES) * c("wide") + d(0.5)).cast("int"), c("n"))
    e = e.select("name", "o", "mid", "wide", F.sequence(first, last - 1).alias("at")).withColumn("w", F.transform("at", lambda i: kernel((i - c("mid") + d(0.5)) / c("wide"))))
    e = e.withColumn("all", F.aggregate("w", d(0), lambda a, x: a + x)).select("name", "o", "all", F.explode(F.arrays_zip("at", "w")).alias("p"))
    k = c("p.w") / c("all") * d(1 << BITS)
    return e.select("name", "o", c("p.at").alias("i"), F.when(k < 0, k - d(0.5)).otherwise(k + d(0.5)).cast("int").alias("k"))


def to_byte(total: Column) -> Column:
    return F.least(F.greatest(F.shiftright(total + F.lit(1 << (BITS - 1)), BITS), F.lit(0)), F.lit(255)).cast("int")


def resized(pixels: DataFrame, sizes: DataFrame, bands: tuple[str, ...] = ("r", "g", "b")) -> DataFrame:
    """name, row, col and bands (bytes) of dense images, brought to the sides that sizes says (name, width, height, out_width, out_height): along columns first, then along rows, each pass rounded to bytes. An axis that keeps its length is passed over."""

    def along(df: DataFrame, axis: str, side: str, out: str) -> DataFrame:
        keep = "row" if axis == "col" else "col"
        change = sizes.where(c(side) != c(out))
        j = df.join(axis_weights(change, side, out).withColumnRenamed("i", axis), ["name", axis])
        sums = j.groupBy("name", keep, c("o").alias(axis)).agg(*[to_byte(F.sum(c(b).cast("long") * c("k"))).alias(b) for b in bands])
        same = df.join(sizes.where(c(side) == c(out)).select("name"), "name", "left_semi")
        return sums.select(*df.columns).unionByName(same)

    rows = pixels.select("name", "row", "col", *bands)
    return along(along(rows, "col", "width", "out_width"), "row", "height", "out_height")


def averaged(pixels: DataFrame, sizes: DataFrame, bands: tuple[str, ...], valid: str = "valid") -> DataFrame:
    """name, row, col and bands (means by covered area of valid pixels; none without any) of images brought to out_width, out_height."""
    j = pixels.where(valid).join(sizes, "name")

    def shares(k: str, side: str, out: str) -> Column:
        """The one or more cells that a pixel lies in along an axis, and how much of each it covers."""
        by = c(out).cast("double") / c(side).cast("double")
        low, high = c(k) * by, (c(k) + 1) * by
        first, last = F.floor(low).cast("int"), F.greatest(F.ceil(high).cast("int") - 1, F.floor(low).cast("int"))
        return F.transform(F.sequence(first, last), lambda o: F.struct(o.alias("o"), (F.least(high, (o + 1).cast("double")) - F.greatest(low, o.cast("double"))).alias("w")))

    e = j.withColumn("_y", F.explode(shares("row", "height", "out_height"))).withColumn("_x", F.explode(shares("col", "width", "out_width")))
    e = e.where((c("_y.o") < c("out_height")) & (c("_x.o") < c("out_width")) & (c("_y.w") > 0) & (c("_x.w") > 0))
    w = c("_y.w") * c("_x.w")
    return e.groupBy("name", c("_y.o").alias("row"), c("_x.o").alias("col")).agg(*[(F.sum(w * c(b)) / F.sum(w)).alias(b) for b in bands])


def reference_preview(pixels: DataFrame, grids: DataFrame, most: int = 1600) -> tuple[DataFrame, DataFrame]:
    """Bytes of pictures (name, row, col, r, g, b, valid) stretched (cut down; a band of fewer than 100 valid pixels is 0) and then brought to at most `most` a side by the kernel; and their sizes (name, width, height, out_width, out_height)."""
    sizes = grids.select("name", "width", "height", *[F.greatest(truncated_side(c(k), c("width"), c("height"), most), F.lit(1)).alias(f"out_{k}") for k in ("width", "height")])
    stretched = raster.stretched(pixels, ("r", "g", "b"), 100, "truncate", "name")
    return resized(stretched, sizes), sizes


def georeferenced_preview(pixels: DataFrame, grids: DataFrame, most: int) -> DataFrame:
    """Bytes of pictures brought to at most `most` a side by area means and then stretched (rounded; too few valid pixels are an error). Cells without a valid pixel have no row, which is black."""
    sizes = grids.select("name", "width", "height", *[preview_side(c(k), c("width"), c("height"), most).alias(f"out_{k}") for k in ("width", "height")])
    return raster.stretched(averaged(pixels, sizes, ("r", "g", "b")).withColumn("valid", F.lit(True)), ("r", "g", "b"), 100, "round", "name")


def side_by_side(left: DataFrame, right: DataFrame, widths: DataFrame) -> DataFrame:
    """One canvas for each name: left pixels, and right ones behind the left image's width (widths: name, width)."""
    moved = right.join(widths.select("name", c("width").alias("_w")), "name").withColumn("col", c("col") + c("_w")).select(*left.columns)
    return left.unionByName(moved)
