"""Point pairs: thinning, removal of copies, balanced selection, gates, robust thresholds. Ties always end in `ord`."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.functions.columns import c, d, finite


def best_first(*more: str) -> list[Column]:
    return [F.desc("conf"), *map(F.col, more or ("ord",))]


def inside(x: str, y: str, width: float, height: float) -> Column:
    return (c(x) >= 0) & (c(x) < width) & (c(y) >= 0) & (c(y) < height)


def raw_valid(m: DataFrame, shape0: tuple[int, int], shape1: tuple[int, int]) -> DataFrame:
    """Pairs with finite points inside both images (width, height)."""
    return m.where(finite("x0") & finite("y0") & finite("x1") & finite("y1") & inside("x0", "y0", *shape0) & inside("x1", "y1", *shape1))


def spatial_thin(m: DataFrame, cell: int, most: int, width: int, height: int) -> DataFrame:
    """At most `most` pairs of each scene and reference cell: the most confident ones."""
    cells = m.where(inside("x1", "y1", width, height)).withColumn("cx", F.floor(c("x1") / d(cell))).withColumn("cy", F.floor(c("y1") / d(cell)))
    w = W.partitionBy("scene", "cx", "cy").orderBy(*best_first())
    return cells.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= most).drop("rn")


def without_copies(m: DataFrame, columns: tuple[str, ...], step: float, by: tuple[str, ...] = ("scene",)) -> DataFrame:
    """One pair for each rounded key: the most confident, the first of equals; first_ord is where the key first came."""
    keys = [F.rint(c(x) / d(step)) for x in columns]
    names = [f"k{i}" for i in range(len(keys))]
    m = m.select("*", *[k.alias(n) for k, n in zip(keys, names, strict=True)])
    w = W.partitionBy(*by, *names)
    out = m.withColumn("rn", F.row_number().over(w.orderBy(*best_first()))).withColumn("first_ord", F.min("ord").over(w))
    return out.where("rn = 1").drop("rn", *names)


def merge_stats(m: DataFrame, step: float) -> DataFrame:
    """How many pairs of each scene stay after removal of copies."""
    before = m.groupBy("scene").agg(F.count(F.lit(1)).alias("n_input"))
    after = without_copies(m, ("x0", "y0", "x1", "y1"), step).groupBy("scene").agg(F.count(F.lit(1)).alias("n_merged"))
    return before.join(after, "scene").withColumn("n_removed", F.col("n_input") - F.col("n_merged"))


def confidence_gate(m: DataFrame, least: float, keep_percent: float) -> DataFrame:
    """Pairs at or above both a fixed confidence and the scene's percentile; compared in single precision."""
    cut = m.groupBy("scene").agg(F.greatest(d(least), F.percentile("conf", d((100 - keep_percent) / 100))).cast("float").alias("cut"))
    return m.join(cut, "scene").where(c("conf").cast("float") >= c("cut"))


def filter_ladder(m: DataFrame, cell: int, most: int, size: int, least: float, keep: float, step: float, need: int) -> DataFrame:
    """Counts after each stage of filtering by scene, and the reason of the first stage that leaves too few."""
    stage = confidence_gate(m, least, keep)
    thin = without_copies(spatial_thin(stage, cell, most, size, size), ("x0", "y0"), step)

    def n(x: DataFrame, name: str) -> DataFrame:
        return x.groupBy("scene").agg(F.count(F.lit(1)).alias(name))

    j = n(m, "n_raw").join(n(stage, "n_conf"), "scene", "left").join(n(thin, "n_spatial"), "scene", "left").na.fill(0)
    reason = F.lit(None).cast("string")
    for name in ("spatial", "conf", "raw"):
        text = F.format_string(f"too_few_matches_{'raw' if name == 'raw' else f'after_{name}'}(%d)", f"n_{name}")
        reason = F.when(c(f"n_{name}") < need, text).otherwise(reason)
    return j.withColumn("reason", reason)


def balanced(m: DataFrame, width: float, height: float, grid: int, most: int, least: float = 0.0) -> DataFrame:
    """At most `most` points of each scene, taken round by round: one of every cell, then a second one, the most confident first. A scene with no more than that keeps all, in its own order."""
    m = m.where(c("conf") >= least)
    n = m.groupBy("scene").agg(F.count(F.lit(1)).alias("n"))
    m = m.join(n, "scene").withColumn("cx", F.least(F.lit(grid - 1), F.floor(c("x1") / d(width / grid)))).withColumn("cy", F.least(F.lit(grid - 1), F.floor(c("y1") / d(height / grid))))
    few = (c("n") <= most) | F.lit(most <= 0)
    ok = few | inside("x1", "y1", width, height)
    m = m.where(ok).withColumn("round", F.row_number().over(W.partitionBy("scene", "cy", "cx").orderBy(*best_first())))
    m = m.where(few | (c("round") <= most))  # later rounds have `most` pairs of their own cell before them; what a scene's task sorts is bounded by that
    order = W.partitionBy("scene").orderBy("round", "cy", "cx")
    place = F.when(few, F.row_number().over(W.partitionBy("scene").orderBy("ord"))).otherwise(F.row_number().over(order))
    return m.withColumn("place", place).where(few | (c("place") <= most)).drop("n", "round")


def best_candidate(t: DataFrame) -> DataFrame:
    """The viable candidate with the most inliers of each scene; the first of equals."""
    w = W.partitionBy("scene").orderBy(F.desc("inliers"), "ord")
    return t.where("viable").withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


def coverage_ratio(m: DataFrame, cell: int, width: int, height: int) -> DataFrame:
    """Share of cells that have a point, by scene."""
    cells = -(-width // cell) * -(-height // cell)
    cx, cy = F.floor(c("x1") / d(cell)), F.floor(c("y1") / d(cell))
    return m.where(inside("x1", "y1", width, height)).groupBy("scene").agg((F.count_distinct(F.struct(cx.alias("x"), cy.alias("y"))) / d(cells)).alias("coverage"))


def homography_residual(h: tuple[float, ...]) -> Column:
    """Distance of the mapped moving point from the reference point; h has nine coefficients row by row."""
    w = d(h[6]) * c("x0") + d(h[7]) * c("y0") + d(h[8])
    x, y = (d(h[0]) * c("x0") + d(h[1]) * c("y0") + d(h[2])) / w, (d(h[3]) * c("x0") + d(h[4]) * c("y0") + d(h[5])) / w
    return F.sqrt((x - c("x1")) * (x - c("x1")) + (y - c("y1")) * (y - c("y1")))


def prior_gate(m: DataFrame, h: tuple[float, ...], most: float) -> DataFrame:
    """By scene: pairs, those near the prior model, and the median and 90th percentile of all distances."""
    r = m.withColumn("residual", homography_residual(h))
    return r.groupBy("scene").agg(F.count(F.lit(1)).alias("n"), F.count_if(c("residual") <= most).alias("n_after_prior_gate"), F.median("residual").alias("median_px"), F.percentile("residual", d(0.9)).alias("p90_px"))


def robust_threshold(r: DataFrame, value: str, least: float, k: float) -> DataFrame:
    """By scene: median, median absolute deviation, and the larger of a fixed distance and median + k scaled deviations."""
    med = r.groupBy("scene").agg(F.median(value).alias("median"))
    dev = r.join(med, "scene").groupBy("scene", "median").agg(F.median(F.abs(c(value) - c("median"))).alias("mad"))
    return dev.withColumn("threshold", F.greatest(d(least), c("median") + d(k) * d(1.4826) * c("mad")))


def bad_geometry(median: Column, p90: Column, most_median: float = 10.0, most_p90: float = 30.0) -> Column:
    """Whether known residuals are too large; unknown ones are not."""
    return F.coalesce(median > d(most_median), F.lit(False)) | F.coalesce(p90 > d(most_p90), F.lit(False))


def worst_removed(r: DataFrame, value: str, threshold: float, fraction: float) -> DataFrame:
    """Pairs above the threshold that one round removes: the worst, at most a fraction of all, one at least."""
    n = F.count(F.lit(1)).over(W.partitionBy("scene"))
    out = r.withColumn("cap", F.greatest(F.lit(1), F.floor(n * d(fraction)))).where(c(value) > threshold)
    return out.withColumn("rn", F.row_number().over(W.partitionBy("scene").orderBy(F.desc(value), "ord"))).where("rn <= cap").drop("rn", "cap")


def fold_blocks(m: DataFrame, block: int, width: int, height: int) -> DataFrame:
    """Pairs by scene and spatial block of reference points; indexes are clipped to the image's blocks."""
    def index(x: str, side: int) -> Column:
        return F.least(F.greatest(F.floor(c(x) / d(block)), F.lit(0)), F.lit(max(0, (side - 1) // block)))

    return m.groupBy("scene", index("x1", width).alias("bx"), index("y1", height).alias("by")).agg(F.count(F.lit(1)).alias("n"))


def folds(blocks: DataFrame, most: int) -> DataFrame:
    """Block to fold: blocks by falling count (then place) go to the fold with the fewest pairs so far (then the lowest number). A scene with one block has no folds."""
    listed = blocks.groupBy("scene").agg(F.array_sort(F.collect_list(F.struct((-c("n")).alias("neg"), "bx", "by"))).alias("b")).where(F.size("b") >= 2)
    k = F.least(F.greatest(F.lit(2), F.lit(most)), F.size("b"))
    start = F.struct(F.array_repeat(F.lit(0).cast("long"), k).alias("load"), F.array().cast("array<struct<bx:long,by:long,fold:int>>").alias("out"))

    def put(a: Column, x: Column) -> Column:
        at = (F.array_position(a["load"], F.array_min(a["load"])) - 1).cast("int")
        load = F.transform(a["load"], lambda v, i: v - F.when(i == at, x["neg"]).otherwise(F.lit(0)))
        return F.struct(load.alias("load"), F.concat(a["out"], F.array(F.struct(x["bx"].alias("bx"), x["by"].alias("by"), at.alias("fold")))).alias("out"))

    return listed.select("scene", F.explode(F.aggregate("b", start, put, lambda a: a["out"])).alias("x")).select("scene", "x.*")


def tile_status(t: DataFrame, least_side: int, least_valid: float) -> DataFrame:
    """First reason why a tile is not matched, in a fixed order; `eligible` where none holds."""
    status = F.when((c("h") < least_side) | (c("w") < least_side), "skip_small").when(c("valid") < least_valid, "skip_low_valid").when((c("x1") <= c("x0")) | (c("y1") <= c("y0")), "skip_empty_pred_window").when(c("ref_valid") <= 0, "skip_empty_ref").otherwise("eligible")
    return t.withColumn("status", status)
