"""Repeated coverage: days per pixel, window statistics from step cells, tile selection, per-day mosaics."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.functions.columns import c, d


def date_count(pixels: DataFrame, grid: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Days on which a pixel was valid in any scene, for every pixel of the grid. Days are first made distinct with their pixel, so the shuffle carries one row a pixel and day."""
    days = pixels.where("valid").select(*by, "row", "col", "acq_day").distinct()
    counted = days.groupBy(*by, "row", "col").agg(F.count(F.lit(1)).cast("int").alias("date_count"))
    return grid.join(counted, [*by, "row", "col"], "left").na.fill(0, ["date_count"])


def dense_grid(spark, height: int, width: int) -> DataFrame:
    return spark.range(height * width).select(F.floor(c("id") / width).cast("int").alias("row"), (c("id") % width).cast("int").alias("col"))


def repeated(counts: DataFrame, least: int) -> DataFrame:
    return counts.withColumn("repeated", c("date_count") >= least)


def windows(counts: DataFrame, height: int, width: int, tile: int, step: int, least_dates: int, by: tuple[str, ...] = ()) -> DataFrame:
    """Statistics of every window (tile pixels wide, each step pixels): share of repeated pixels, their mean count, and the greatest count of all pixels.

    Pixels are summed once into cells of the common divisor of tile and step; each cell then goes to the windows over it.
    """
    cell = math.gcd(tile, step)
    on = c("date_count") >= least_dates
    cells = counts.groupBy(*by, F.floor(c("row") / cell).cast("int").alias("crow"), F.floor(c("col") / cell).cast("int").alias("ccol")).agg(
        F.count_if(on).alias("n"), F.coalesce(F.sum(F.when(on, c("date_count"))), F.lit(0)).alias("total"), F.max("date_count").alias("most")
    )

    def starts(at: str, side: int):
        """Window starts that cover a cell."""
        first = F.greatest(F.lit(0), F.ceil((c(at) * cell - tile + cell) / d(step)).cast("int"))
        last = F.least(F.lit((side - tile) // step), F.floor(c(at) * cell / d(step)).cast("int"))
        return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))

    over = cells.withColumn("wrow", F.explode(starts("crow", height))).withColumn("wcol", F.explode(starts("ccol", width)))
    out = over.groupBy(*by, (c("wrow") * step).alias("row"), (c("wcol") * step).alias("col")).agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.max("most").alias("max_date_count"))
    return out.select(*by, "row", "col", (c("n") / d(tile * tile)).alias("repeated_fraction"), F.when(c("n") > 0, c("total") / c("n").cast("double")).otherwise(d(0)).alias("mean_date_count"), "max_date_count")


def candidates(stats: DataFrame, least_fraction: float) -> DataFrame:
    return stats.where(c("repeated_fraction") >= least_fraction)


def nonoverlapping(found: DataFrame, tile: int, by: str = "block_id") -> DataFrame:
    """Windows taken in the order of fraction, mean and maximum (all falling), then row and column, each unless it overlaps one taken before; `place` is the order. A block's candidates are bounded by its grid, so a block is one group."""

    def greedy(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["repeated_fraction", "mean_date_count", "max_date_count", "row", "col"], ascending=[False, False, False, True, True])
        taken: list[int] = []
        cells: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for i, (r, k) in enumerate(zip(pdf["row"], pdf["col"], strict=True)):
            a, b = r // tile, k // tile
            if all(abs(r - y) >= tile or abs(k - x) >= tile for u in (a - 1, a, a + 1) for v in (b - 1, b, b + 1) for y, x in cells.get((u, v), ())):
                cells.setdefault((a, b), []).append((r, k))
                taken.append(i)
        out = pdf.iloc[taken].copy()
        out["place"] = range(1, len(out) + 1)
        return out

    schema = f"{found.select(by).schema.simpleString()[7:-1].replace(':', ' ')}, row int, col int, repeated_fraction double, mean_date_count double, max_date_count int, place int"
    return found.select(by, "row", "col", "repeated_fraction", "mean_date_count", "max_date_count").groupBy(by).applyInPandas(greedy, schema)


def tile_days(pixels: DataFrame, tiles: DataFrame, tile: int, least_fraction: float, least_days: int) -> DataFrame:
    """Days on which a large enough share of a tile's pixels is valid, for tiles with enough such days. A pixel counts once a day."""
    own = pixels.where("valid").select("row", "col", "acq_day").distinct()
    cells = F.struct(F.floor(c("row") / tile).cast("int").alias("r"), F.floor(c("col") / tile).cast("int").alias("k"))
    near = tiles.select("tile_id", c("row").alias("y"), c("col").alias("x"))
    near = near.withColumn("cell", F.explode(F.array_distinct(F.flatten(F.transform(F.array(F.lit(0), F.lit(tile - 1)), lambda i: F.transform(F.array(F.lit(0), F.lit(tile - 1)), lambda j: F.struct(F.floor((c("y") + i) / tile).cast("int").alias("r"), F.floor((c("x") + j) / tile).cast("int").alias("k"))))))))
    inside = (c("row") >= c("y")) & (c("row") < c("y") + tile) & (c("col") >= c("x")) & (c("col") < c("x") + tile)
    days = own.withColumn("cell", cells).join(near, "cell").where(inside).groupBy("tile_id", "acq_day").agg((F.count(F.lit(1)) / d(tile * tile)).alias("valid_fraction")).where(c("valid_fraction") >= least_fraction)
    return days.withColumn("n_days", F.count(F.lit(1)).over(W.partitionBy("tile_id"))).where(c("n_days") >= least_days)


def tile_table(days: DataFrame) -> DataFrame:
    """tile_id, distinct_date_count and the days joined by ' | '."""
    return days.groupBy("tile_id").agg(F.count_distinct("acq_day").alias("distinct_date_count"), F.array_join(F.array_sort(F.collect_set("acq_day")), " | ").alias("dates"))


def mosaic(pixels: DataFrame) -> DataFrame:
    """By pixel and day: the first valid value in scene order, whether any scene was valid, and how many scenes were."""
    first = F.min_by(F.when(c("valid"), c("value")), F.when(c("valid"), F.struct("scene_ord", "value")))
    return pixels.groupBy("row", "col", "acq_day").agg(first.alias("value"), F.bool_or("valid").alias("valid"), F.count_distinct(F.when(c("valid"), c("scene_ord"))).alias("n_scenes"))


def tile_validity(pixels: DataFrame, tile: int, height: int, width: int, least: float, by: str = "scene_ord") -> DataFrame:
    """By scene: tiles, those of full shape with enough valid pixels, and those rejected for shape or validity. A pixel is valid if all its rows are."""
    one = pixels.groupBy(by, "row", "col").agg(F.bool_and("valid").alias("ok"))
    trow, tcol = F.floor(c("row") / tile), F.floor(c("col") / tile)
    tiles = one.groupBy(by, trow.alias("trow"), tcol.alias("tcol")).agg(F.count_if("ok").alias("n_ok"))
    h, w = F.least(F.lit(tile), F.lit(height) - c("trow") * tile), F.least(F.lit(tile), F.lit(width) - c("tcol") * tile)
    full, enough = (h == tile) & (w == tile), c("n_ok") / (h * w).cast("double") >= least
    return tiles.groupBy(by).agg(F.count(F.lit(1)).alias("raw_tiles"), F.count_if(full & enough).alias("valid_tiles"), F.count_if(~full).alias("rejected_shape"), F.count_if(full & ~enough).alias("rejected_valid_ratio"))
