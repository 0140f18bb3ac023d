"""Coarse-to-fine matching of whole scenes: a coarse model predicts each tile's window, tile pairs are filtered and gated by it, and what is left joins the coarse pairs.

Models are a table keyed by scene, so scenes of any number are one job. Every tile ends in one of nine states; tiles whose worker failed are
rows like any other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.functions.columns import c, d
from geoloom.operators import grid, models, points

MODELS = "scene long, kind string, h array<double>"
PAIRS = ("scene", "ord", "x0", "y0", "x1", "y1", "conf")


def fitted(pairs: DataFrame, kind: str = "homography", px: float = 8.0, iters: int = 5000, sure: float = 0.999, seed: int = 7, scenes_at_once: int = 200) -> DataFrame:
    """MODELS: the coarse model (nine coefficients, row by row) of each scene's pairs; null where none could be fitted."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values("ord")
        h = models.ransac(p[["x0", "y0"]].to_numpy(float), p[["x1", "y1"]].to_numpy(float), kind, px, iters, sure, seed + int(key[0]))
        return pd.DataFrame([(int(key[0]), kind, None if h is None else np.asarray(h, float).ravel().tolist())], columns=["scene", "kind", "h"])

    return pairs.repartition(scenes_at_once, "scene").groupBy("scene").applyInPandas(run, MODELS)


def mapped(h: Column, x: Column, y: Column) -> tuple[Column, Column]:
    """A place by the nine coefficients of an array column."""
    k = [F.get(h, F.lit(i)) for i in range(9)]
    w = k[6] * x + k[7] * y + k[8]
    return (k[0] * x + k[1] * y + k[2]) / w, (k[3] * x + k[4] * y + k[5]) / w


def valid_fractions(windows: DataFrame, valid: DataFrame, name: str, box: tuple[str, str, str, str]) -> DataFrame:
    """windows (scene, tile_id, and a box of whole pixels: first row, row after the last, first column, column after the last) with the share of their pixels that valid (scene, row, col) lists. Windows meet the rows of pixels, not pixels: each row has its valid columns in order, and a window counts those between its ends."""
    y0, y1, x0, x1 = map(c, box)
    some = windows.where((y1 > y0) & (x1 > x0)).select("scene", "tile_id", x0.alias("_x0"), x1.alias("_x1"), F.explode(F.sequence(y0, y1 - 1)).alias("row"))
    rows = valid.select("scene", "row", "col").distinct().groupBy("scene", "row").agg(F.array_sort(F.collect_list("col")).alias("cols"))
    inside = F.size(F.filter("cols", lambda q: (q >= c("_x0")) & (q < c("_x1"))))
    counted = some.join(rows, ["scene", "row"]).groupBy("scene", "tile_id").agg(F.sum(inside).alias("_n"))
    area = ((y1 - y0) * (x1 - x0)).cast("double")
    return windows.join(counted, ["scene", "tile_id"], "left").withColumn(name, F.when(area > 0, F.coalesce("_n", F.lit(0)) / area)).drop("_n")


def tile_plan(images: DataFrame, coarse_models: DataFrame, moving: DataFrame, reference: DataFrame, tile: int, overlap: int, least_side: int, least_valid: float, margin: int) -> DataFrame:
    """Every tile of the images (scene, h, w): tile_id (row by row from 0), its window, mov_valid_frac, the predicted window, ref_valid_frac, and status, null where the tile is to be matched. moving, reference: valid pixels (scene, row, col). Scenes without a model have no tiles, as their coarse stage failed."""
    t = grid.tiles(images.join(coarse_models.where("h is not null").select("scene", c("h").alias("model")), "scene"), tile, overlap)
    t = t.withColumn("tile_id", (F.row_number().over(W.partitionBy("scene").orderBy("y0", "x0")) - 1).cast("int"))
    t = valid_fractions(t, moving, "mov_valid_frac", ("y0", "y1", "x0", "x1"))
    right, low = c("x1") - 1, c("y1") - 1
    corners = [(c("x0"), c("y0")), (right, c("y0")), (c("x0"), low), (right, low), ((c("x0") + right) / d(2), (c("y0") + low) / d(2))]
    window = grid.predicted_window([mapped(c("model"), x.cast("double"), y.cast("double")) for x, y in corners], float(margin), c("h"), c("w"))
    t = t.select("*", *[v.cast("int").alias(k) for k, v in zip(("ry0", "ry1", "rx0", "rx1"), window, strict=True)])
    t = valid_fractions(t, reference, "ref_valid_frac", ("ry0", "ry1", "rx0", "rx1"))
    small = (c("y1") - c("y0") < least_side) | (c("x1") - c("x0") < least_side)
    status = F.when(small, "skip_small").when(c("mov_valid_frac") < least_valid, "skip_low_valid").when((c("ry1") <= c("ry0")) | (c("rx1") <= c("rx0")), "skip_empty_pred_window").when(F.coalesce("ref_valid_frac", d(0)) <= 0, "skip_empty_ref")
    return t.withColumn("status", status)


def refined(plan: DataFrame, pairs: DataFrame, errors: DataFrame, least_conf: float, keep_percent: float, cell: int, most: int, most_px: float) -> tuple[DataFrame, DataFrame]:
    """Diagnostics of each tile of the plan, and the pairs that tiles add, in coordinates of whole images.

    pairs: scene, tile_id, ord, x0, y0, x1, y1, conf in the tile's and its window's own coordinates; errors: scene, tile_id, error of tiles whose worker
    failed, which count for nothing else. Diagnostics: the plan's columns, n_raw_matches, n_after_conf, n_after_spatial, prior_residual_median_px,
    prior_residual_p90_px, n_after_prior_gate, status, error.
    """
    key = ["scene", "tile_id"]
    open_tiles = plan.where("status is null").join(errors.select(*key), key, "left_anti")
    local = pairs.join(open_tiles.select(*key, "y0", "x0", "ry0", "ry1", "rx0", "rx1", "model").withColumnsRenamed({"x0": "off_x", "y0": "off_y"}), key)
    cut = local.groupBy(*key).agg(F.greatest(d(least_conf), F.percentile("conf", d((100 - keep_percent) / 100))).cast("float").alias("cut"))
    sure = local.join(cut, key).where(c("conf").cast("float") >= c("cut"))
    inside = (c("x1") >= 0) & (c("x1") < c("rx1") - c("rx0")) & (c("y1") >= 0) & (c("y1") < c("ry1") - c("ry0"))
    cells = [F.floor(c(k) / d(cell)).alias(f"_{k}") for k in ("x1", "y1")]
    thin = sure.where(inside).select("*", *cells).withColumn("_n", F.row_number().over(W.partitionBy(*key, "_x1", "_y1").orderBy(F.desc("conf"), "ord"))).where(c("_n") <= most)
    whole = thin.select(*key, "ord", "conf", "model", *[(c(a) + c(b)).alias(a) for a, b in (("x0", "off_x"), ("y0", "off_y"), ("x1", "rx0"), ("y1", "ry0"))])
    px, py = mapped(c("model"), c("x0"), c("y0"))
    gated = whole.withColumn("residual", F.sqrt((px - c("x1")) * (px - c("x1")) + (py - c("y1")) * (py - c("y1"))))
    n = lambda df, name: df.groupBy(*key).agg(F.count("*").alias(name))
    prior = gated.groupBy(*key).agg(F.median("residual").alias("prior_residual_median_px"), F.percentile("residual", d(0.9)).alias("prior_residual_p90_px"), F.count("*").alias("n_after_spatial"), F.count_if(c("residual") <= most_px).alias("n_after_prior_gate"))
    found = plan.join(n(local, "n_raw_matches"), key, "left").join(n(sure, "n_after_conf"), key, "left").join(prior, key, "left").join(errors.select(*key, "error"), key, "left")
    counts = [F.when(c("status").isNull() & c("error").isNull(), F.coalesce(k, F.lit(0))).alias(k) for k in ("n_raw_matches", "n_after_conf", "n_after_spatial", "n_after_prior_gate")]
    error = F.when(c("status").isNull(), c("error"))
    none = lambda k: F.coalesce(k, F.lit(0)) == 0
    status = F.coalesce("status", F.when(c("error").isNotNull(), "worker_error").when(none("n_raw_matches"), "zero_raw").when(none("n_after_spatial"), "rejected_by_tile_filter").when(none("n_after_prior_gate"), "rejected_by_prior_gate").otherwise("used_refined"))
    diagnostics = found.select(*[k for k in plan.columns if k not in ("status", "model")], *counts, "prior_residual_median_px", "prior_residual_p90_px", error.alias("error"), status.alias("status"))
    return diagnostics, gated.where(c("residual") <= most_px).select("scene", "tile_id", "ord", "x0", "y0", "x1", "y1", "conf")


def joined(coarse: DataFrame, fine: DataFrame) -> DataFrame:
    """PAIRS: each scene's coarse pairs, then those of its tiles in order, numbered anew from 0."""
    both = coarse.select(*PAIRS, F.lit(-1).alias("tile_id")).unionByName(fine.select(*PAIRS, "tile_id"))
    place = F.row_number().over(W.partitionBy("scene").orderBy("tile_id", "ord")) - 1
    return both.select(*[place.cast("long").alias("ord") if k == "ord" else c(k) for k in PAIRS])


def merged(pairs: DataFrame, src_step: float, dst_step: float) -> DataFrame:
    """Pairs of which rounding makes one place on either side: the most confident, the first of equals."""
    keys = [F.rint(c(k) / d(s)).alias(f"_{k}") for k, s in (("x0", src_step), ("y0", src_step), ("x1", dst_step), ("y1", dst_step))]
    w = W.partitionBy("scene", "_x0", "_y0", "_x1", "_y1").orderBy(*points.best_first())
    return pairs.select("*", *keys).withColumn("_n", F.row_number().over(w)).where("_n = 1").select(*pairs.columns)


def tile_counters(diagnostics: DataFrame) -> DataFrame:
    """By scene: how many tiles there are and how many ended in which group of states."""
    of = lambda *names: F.count_if(c("status").isin(*names))
    return diagnostics.groupBy("scene").agg(
        F.count("*").alias("n_tiles_total"), of("used_refined").alias("n_tiles_used"), of("skip_small").alias("n_tiles_skip_small"), of("skip_low_valid").alias("n_tiles_skip_valid"), of("skip_empty_pred_window", "skip_empty_ref").alias("n_tiles_skip_empty_ref"),
        of("zero_raw").alias("n_tiles_zero_raw"), of("worker_error", "rejected_by_tile_filter").alias("n_tiles_rejected_filter"), of("rejected_by_prior_gate").alias("n_tiles_rejected_prior"),
    )
