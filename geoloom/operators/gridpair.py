"""Moving and reference image of each scene on the reference's grid: values, validity, [0, 1] and bytes, as a matcher takes them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions.columns import LEAST, MOST, c, d, finite, grey
from geoloom.operators import raster, warp

RGB = ("r", "g", "b")


def normalised(pixels: DataFrame, bands: tuple[str, ...], least: int) -> DataFrame:
    """Adds to each band its [0, 1] value between percentiles (band01) and its byte (band8); invalid pixels are 0, too few valid ones an error."""
    named = pixels.select("*", *[c(b).alias(f"{b}01") for b in bands])
    unit = raster.stretched(named, tuple(f"{b}01" for b in bands), least, "unit", "name")
    return unit.select("*", *[F.when(c("valid"), F.rint(c(f"{b}01") * d(255))).otherwise(d(0)).cast("int").alias(f"{b}8") for b in bands])


def loaded(moving: DataFrame, moving_grids: DataFrame, reference: DataFrame, reference_grids: DataFrame, out_nodata: float = -9999.0, least: int = 1000, side: int = warp.SIDE, as_grey: bool = False) -> DataFrame:
    """name, row, col; for either image (mov_, ref_) each band, valid, [0, 1] and byte: one row for each pixel of the reference.

    moving, reference: name, row, col, r, g, b, valid. Moving bands come bilinearly, their validity from the nearest pixel; a moving pixel
    counts where both say so and its values are possible. as_grey: one band, grey, mixed from the three first (in the moving image before it is warped).
    """
    bands = ("grey",) if as_grey else RGB
    one = lambda df: df.select("name", "row", "col", grey(c("r"), c("g"), c("b")).cast("double").alias("grey"), "valid") if as_grey else df.select("name", "row", "col", *RGB, "valid")
    moving, reference = one(moving), one(reference)
    values = warp.to_grid(moving, moving_grids, reference_grids, bands, "bilinear", side)
    flags = warp.to_grid(moving.select("name", "row", "col", c("valid").cast("int").alias("ok"), F.lit(True).alias("valid")), moving_grids, reference_grids, ("ok",), "nearest", side).where("ok = 1").select("name", "row", "col", F.lit(True).alias("near"))
    possible = lambda b: finite(b) & (c(b) >= d(LEAST)) & (c(b) <= d(MOST))
    every = F.lit(True)
    for b in bands:
        every = every & possible(b)
    at = reference.select("name", "row", "col")
    moved = at.join(values, ["name", "row", "col"], "left").join(flags, ["name", "row", "col"], "left").withColumn("valid", F.coalesce("near", F.lit(False)) & every).drop("near")
    moved = moved.select("name", "row", "col", *[F.when(possible(b), c(b)).otherwise(d(out_nodata)).alias(b) for b in bands], "valid")
    of = lambda df, name: normalised(df, bands, least).select("name", "row", "col", *[c(k).alias(f"{name}_{k}") for k in ("valid", *bands, *(f"{b}01" for b in bands), *(f"{b}8" for b in bands))])
    return of(moved, "mov").join(of(reference, "ref"), ["name", "row", "col"])
