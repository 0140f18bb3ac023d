"""Raster kernels on pixel rows: contrast stretches, decimation, resampling to another grid."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.columns import apply_affine, c, d, invert_affine


def limits(pixels: DataFrame, bands: tuple[str, ...], by: str = "scene") -> DataFrame:
    """Per image: number of valid pixels, and the 2nd and 98th percentile, least and greatest value of each band over them."""
    v = pixels.where("valid")
    out = [F.count(F.lit(1)).alias("n_valid")]
    for b in bands:
        p = F.percentile(b, F.array(d(0.02), d(0.98)))
        out += [F.get(p, F.lit(0)).alias(f"{b}_low"), F.get(p, F.lit(1)).alias(f"{b}_high"), F.min(b).alias(f"{b}_min"), F.max(b).alias(f"{b}_max")]
    return v.groupBy(by).agg(*out)


def unit(v: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest((v - low) / (high - low + d(1e-8)), d(0)), d(1))


def stretched(pixels: DataFrame, bands: tuple[str, ...], least: int, kind: str, by: str = "scene") -> DataFrame:
    """Bands stretched between their percentiles; invalid pixels are 0.

    kind `truncate`: bytes cut down to whole numbers, bands with fewer than `least` valid pixels stay 0. kind `round`:
    bytes rounded half to even, limits fall back to least and greatest, too few valid pixels are an error. kind `unit`:
    values in [0, 1], too few valid pixels are an error.
    """
    j = pixels.join(limits(pixels, bands, by), by, "left")
    enough = F.coalesce(c("n_valid"), F.lit(0)) >= least
    failed = F.raise_error(F.lit("too few valid pixels")).cast("double")
    out = []
    for b in bands:
        low, high = c(f"{b}_low"), c(f"{b}_high")
        if kind == "round":
            flat = high <= low
            low, high = F.when(flat, c(f"{b}_min")).otherwise(low), F.when(flat, c(f"{b}_max")).otherwise(high)
        x = unit(c(b), low, high)
        y = {"truncate": F.floor(x * d(255)).cast("int"), "round": F.rint(x * d(255)).cast("int"), "unit": x}[kind]
        y = F.when(enough, y).otherwise(F.lit(0) if kind == "truncate" else failed)
        out.append(F.when(c("valid"), y).otherwise(F.lit(0)).alias(b))
    return j.select(*[k for k in pixels.columns if k not in bands], *out)


def decimated(pixels: DataFrame, factor: int, value: str = "value", by: tuple[str, ...] = ()) -> DataFrame:
    """Average of each factor x factor cell."""
    return pixels.groupBy(*by, F.floor(c("row") / factor).cast("int").alias("row"), F.floor(c("col") / factor).cast("int").alias("col")).agg(F.avg(value).alias(value))


def source_place(source: dict[str, float], target: dict[str, float]) -> tuple[Column, Column]:
    """Where a target pixel's centre lies in the source grid, in pixels."""
    s, t = ({k: d(v) for k, v in x.items()} for x in (source, target))
    return invert_affine(s, *apply_affine(t, c("col") + d(0.5), c("row") + d(0.5)))


def nearest(grid: DataFrame, pixels: DataFrame, source: dict[str, float], target: dict[str, float]) -> DataFrame:
    """Value of the source pixel under each target pixel's centre; null outside."""
    x, y = source_place(source, target)
    at = grid.select("row", "col", F.floor(x).cast("int").alias("sc"), F.floor(y).cast("int").alias("sr"))
    return at.join(pixels.select(c("row").alias("sr"), c("col").alias("sc"), "value"), ["sr", "sc"], "left").select("row", "col", "value")


def bilinear(grid: DataFrame, pixels: DataFrame, source: dict[str, float], target: dict[str, float]) -> DataFrame:
    """Weighted mean of the four source pixels around each target pixel's centre; missing ones leave their weight to the others."""
    x, y = source_place(source, target)
    u, v = x - d(0.5), y - d(0.5)
    at = grid.select("row", "col", F.floor(u).cast("int").alias("c0"), F.floor(v).cast("int").alias("r0"), (u - F.floor(u)).alias("fx"), (v - F.floor(v)).alias("fy"))
    near = F.array(*[F.struct((c("r0") + i).alias("sr"), (c("c0") + j).alias("sc"), ((c("fy") if i else 1 - c("fy")) * (c("fx") if j else 1 - c("fx"))).alias("w")) for i in (0, 1) for j in (0, 1)])
    e = at.select("row", "col", F.explode(near).alias("n")).select("row", "col", "n.*").where("w > 0")
    j = e.join(pixels.where("value is not null").select(c("row").alias("sr"), c("col").alias("sc"), "value"), ["sr", "sc"])
    means = j.groupBy("row", "col").agg((F.sum(c("w") * c("value")) / F.sum("w")).alias("value"))
    return grid.select("row", "col").join(means, ["row", "col"], "left")


def best_mosaic(pixels: DataFrame, most_cloud: float, factor: float = 6.5535) -> DataFrame:
    """Per pixel the value of the least cloudy scene below a limit, scaled to 1 ... 65535 and truncated; 0 where no scene has one."""
    v = F.least(F.greatest(c("value") * d(factor), d(1)), d(65535)).cast("int")
    ok = (c("cloud") < most_cloud) & c("value").isNotNull()
    return pixels.groupBy("row", "col").agg(F.coalesce(F.min_by(F.when(ok, v), F.when(ok, F.struct("cloud", "ord"))), F.lit(0)).alias("value"))
