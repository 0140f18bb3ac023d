"""Tile time series of many blocks, from band pixels to tiles and observations.

Pixels: block_id, row, col, acq_day, scene_ord, scene_id, and for each band a value and whether it is valid. A scene's valid
pixels are those of its first band alone.
"""

from __future__ import annotations

import math
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.functions.columns import c, d
from geoloom.operators import coverage, grid

BANDS = ("R", "G", "B", "N")


class Rules(NamedTuple):
    """Block size, tile and step in pixels; days a pixel needs; share of such pixels in a tile; share of valid pixels in a day; days a tile needs; metres a pixel; core within the block (west, south, east, north; the block's north-west corner is 0, 0)."""

    side: int
    tile: int
    step: int
    dates: int
    share: float
    valid: float
    days: int
    res: float
    core: tuple[float, float, float, float]


def scene_valid(pixels: DataFrame) -> DataFrame:
    return pixels.select("block_id", "row", "col", "acq_day", "scene_ord", "scene_id", c(f"valid_{BANDS[0]}").alias("valid"))


def found(pixels: DataFrame, rules: Rules) -> DataFrame:
    """Repeatedly covered windows inside the core of their block that do not overlap, with their place in the order they were taken."""
    own = scene_valid(pixels)
    days = own.where("valid").select("block_id", "row", "col", "acq_day").distinct().groupBy("block_id", "row", "col").agg(F.count(F.lit(1)).cast("int").alias("date_count"))
    # pixels that were never valid add nothing to a window's sums; blocks x grid rows are not made for them
    stats = coverage.windows(days, rules.side, rules.side, rules.tile, rules.step, rules.dates, ("block_id",))
    box = grid.candidate_bounds(d(0), d(0), c("row"), c("col"), rules.tile, rules.res)
    inside = coverage.candidates(stats, rules.share).where(grid.inside(box, *map(d, rules.core)))
    return coverage.nonoverlapping(inside, rules.tile)


def observed(pixels: DataFrame, tiles: DataFrame, rules: Rules) -> DataFrame:
    """block_id, place, acq_day, valid_fraction and the scenes used (in order, joined) of each day on which enough of a tile is valid. Tiles do not overlap, so a pixel's cell names its tile."""
    cell = math.gcd(rules.tile, rules.step)
    n = rules.tile // cell - 1
    at = tiles.select("block_id", "place", F.explode(F.sequence(F.lit(0), F.lit(n))).alias("i"), "row", "col").withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(n))))
    at = at.select("block_id", "place", (c("row") / cell + c("i")).cast("int").alias("crow"), (c("col") / cell + c("j")).cast("int").alias("ccol"))
    own = scene_valid(pixels).where("valid").withColumn("crow", F.floor(c("row") / cell).cast("int")).withColumn("ccol", F.floor(c("col") / cell).cast("int")).join(at, ["block_id", "crow", "ccol"])
    by = ("block_id", "place", "acq_day")
    shares = own.select(*by, "row", "col").distinct().groupBy(*by).agg((F.count(F.lit(1)) / d(rules.tile**2)).alias("valid_fraction")).where(c("valid_fraction") >= rules.valid)
    used = own.select(*by, "scene_ord", "scene_id").distinct().groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("scene_ord", "scene_id"))), lambda x: x["scene_id"]), " | ").alias("source_scene_ids"))
    return shares.join(used, list(by))


def extracted(pixels: DataFrame, rules: Rules) -> tuple[DataFrame, DataFrame]:
    """Tiles and their observations. Only tiles with enough valid days take a number, in the order they were taken."""
    tiles = found(pixels, rules)
    days = observed(pixels, tiles, rules)
    counted = days.groupBy("block_id", "place").agg(F.count(F.lit(1)).alias("distinct_date_count"), F.array_join(F.array_sort(F.collect_list("acq_day")), " | ").alias("dates")).where(c("distinct_date_count") >= rules.days)
    number = F.row_number().over(W.partitionBy("block_id").orderBy("place"))
    named = tiles.join(counted, ["block_id", "place"]).withColumn("tile_id", F.format_string("%s_TS_%06d", "block_id", number))
    box = grid.candidate_bounds(d(0), d(0), c("row"), c("col"), rules.tile, rules.res)
    out = named.select("block_id", "tile_id", *[v.alias(k) for k, v in box.items()], "distinct_date_count", "dates", "repeated_fraction", "mean_date_count", "max_date_count", "row", "col")
    name = F.format_string(f"%s_%s_{''.join(BANDS)}_{rules.tile}_{rules.res:g}m", "tile_id", "acq_day")
    return out, days.join(named.select("block_id", "place", "tile_id"), ["block_id", "place"]).select("block_id", "tile_id", "acq_day", "valid_fraction", "source_scene_ids", name.alias("observation"))


def footprints(tiles: DataFrame) -> DataFrame:
    """Tiles as polygons in text form."""
    corner = lambda x, y: F.concat_ws(" ", c(x).cast("string"), c(y).cast("string"))
    ring = F.concat_ws(", ", *[corner(x, y) for x, y in (("west", "south"), ("east", "south"), ("east", "north"), ("west", "north"), ("west", "south"))])
    return tiles.select("block_id", "tile_id", "distinct_date_count", "dates", F.concat(F.lit("POLYGON (("), ring, F.lit("))")).alias("geometry"))


def day_mosaic(pixels: DataFrame, nodata: float = -9999.0) -> DataFrame:
    """By pixel and day: each band's first valid value in scene order, and whether any scene is valid there by its first band."""
    first = [F.coalesce(F.min_by(F.when(c(f"valid_{b}"), c(b)), F.when(c(f"valid_{b}"), F.struct("scene_ord", b))), d(nodata)).alias(b) for b in BANDS]
    return pixels.groupBy("block_id", "row", "col", "acq_day").agg(*first, F.bool_or(f"valid_{BANDS[0]}").alias("valid"))


def observation_pixels(pixels: DataFrame, tiles: DataFrame, observations: DataFrame, rules: Rules) -> DataFrame:
    """tile_id, acq_day, row and col in the tile, and the bands of each observation."""
    t = tiles.select("block_id", "tile_id", c("row").alias("y"), c("col").alias("x"))
    at = t.withColumn("dy", F.explode(F.sequence(F.lit(0), F.lit(rules.tile - 1)))).withColumn("dx", F.explode(F.sequence(F.lit(0), F.lit(rules.tile - 1))))
    at = at.join(observations.select("tile_id", "acq_day"), "tile_id").select("block_id", "tile_id", "acq_day", (c("y") + c("dy")).alias("row"), (c("x") + c("dx")).alias("col"), "dy", "dx")
    j = at.join(day_mosaic(pixels), ["block_id", "row", "col", "acq_day"], "left")
    return j.select("tile_id", "acq_day", c("dy").alias("row"), c("dx").alias("col"), *[F.coalesce(b, d(-9999.0)).alias(b) for b in BANDS])
