"""Whole jobs as compositions: matching with its ladder of filters, georeferencing states, dataset routing and tiling, band stacks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.columns import c, d
from geoloom.operators import coverage, models, points
from geoloom.sources import shared

BANDS = ("R", "G", "B", "N")
MODELS = {"homography_ransac": ("homography", 4), "affine_ransac": ("affine", 3), "tps": (None, 3)}


def kept(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, for what several branches read."""
    path = shared.scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def match_ladder(m: DataFrame, model: str, side: int, least: float = 0.2, keep: float = 100.0, cell: int = 128, most: int = 8, step: float = 0.25, need: int = 12, strong: int = 80, **options) -> DataFrame:
    """Result of each scene: pairs are gated by confidence, thinned and freed of copies, then go to the model; the first stage that leaves too few gives the reason, and only scenes that pass reach the model. Columns of models.RESULT, and n_raw, n_conf, n_spatial."""
    if model not in MODELS:
        raise ValueError(f"unknown filter model: {model}")
    kind, fewest = MODELS[model]
    fewest = max(fewest, need)
    gated = kept(points.confidence_gate(m, least, keep))
    thin = kept(points.without_copies(points.spatial_thin(gated, cell, most, side, side), ("x0", "y0"), step))
    n = lambda x, name: x.groupBy("scene").agg(F.count(F.lit(1)).cast("int").alias(name))
    counts = n(m, "n_raw").join(n(gated, "n_conf"), "scene", "left").join(n(thin, "n_spatial"), "scene", "left").na.fill(0)
    reason = F.when(c("n_raw") < need, F.format_string("too_few_matches_raw(%d)", "n_raw")).when(c("n_conf") < fewest, F.format_string("too_few_matches_after_conf(%d)", "n_conf")).when(c("n_spatial") < fewest, F.format_string("too_few_matches_after_spatial(%d)", "n_spatial"))
    counts = counts.withColumn("early", reason)
    passing = thin.join(counts.where("early is null").select("scene"), "scene", "left_semi")
    result = models.ransac_filter(passing, kind, need=need, strong=strong, **options) if kind else models.spline_filter(passing, side, side, need=need, strong=strong, **options)
    j = counts.join(result, "scene", "left")
    return j.select("scene", F.coalesce("ok", F.lit(False)).alias("ok"), F.coalesce("exportable", F.lit(False)).alias("exportable"), F.coalesce("early", "reason").alias("reason"), "n_raw", "n_conf", "n_spatial", F.coalesce("n_before", F.lit(0)).alias("n_before"), F.coalesce("n_inliers", F.lit(0)).alias("n_inliers"), "inlier_ratio", F.coalesce("n_iters", F.lit(0)).alias("n_iters"), "median_px", "p90_px")


def tile_filter(m: DataFrame, every: DataFrame, least: float, keep: float, cell: int, most: int, side: int) -> DataFrame:
    """Counts after each stage of a tile's filter, and its reason, for all tiles of `every` (scene)."""
    gated = points.confidence_gate(m, least, keep)
    thin = points.spatial_thin(gated, cell, most, side, side)
    n = lambda x, name: x.groupBy("scene").agg(F.count(F.lit(1)).alias(name))
    j = every.join(n(m, "n_raw"), "scene", "left").join(n(gated, "n_after_conf"), "scene", "left").join(n(thin, "n_after_spatial"), "scene", "left").na.fill(0)
    return j.withColumn("reason", F.when(c("n_raw") == 0, "no_raw_matches").when(c("n_after_conf") == 0, "no_matches_after_conf").when(c("n_after_spatial") == 0, "no_matches_after_spatial").otherwise("ok"))


def coarse_and_tiles(coarse: DataFrame, tiles: DataFrame) -> DataFrame:
    """Coarse pairs, then those of tiles: `ord` goes on after each scene's coarse pairs."""
    most = coarse.groupBy("scene").agg((F.max("ord") + 1).alias("from_ord"))
    late = tiles.join(most, "scene", "left").withColumn("ord", c("ord") + F.coalesce("from_ord", F.lit(0))).drop("from_ord")
    return coarse.unionByName(late.select(*coarse.columns))


def batch_of(place: Column, size: int) -> Column:
    """Number of the batch of a place counted from 1."""
    return F.floor((place - 1) / F.lit(size)).cast("long")


#: Where the work on a scene can raise an error, in order.
STAGES = ("matches", "template", "selection", "bands", "warp")


def georeferencing_state(s: DataFrame, need: int) -> DataFrame:
    """status and reason of a scene: the first thing that ends its work, in the order of the work. An error ends it at its own stage, before any later test, with its own text as the reason.

    Columns: has_template_dir, has_original_dir, has_matches, has_template, has_reference, has_crs (booleans), matches_total, gcps_selected, bands_found,
    bands_written, error (text or null); optional: error_stage (one of STAGES; null: warp), reference_path (of the selected reference, for its text).
    """
    few = lambda name, text: F.format_string(f"{text}(%d)", name)
    at = F.coalesce("error_stage", F.lit("warp")) if "error_stage" in s.columns else F.lit("warp")
    raised = lambda stage: (c("error").isNotNull() & (at == stage), "failed", c("error"))
    path = c("reference_path") if "reference_path" in s.columns else F.lit("")
    lost = F.concat(F.lit("FileNotFoundError('Selected matching reference no longer exists: "), path, F.lit("')"))
    ladder = (
        (~c("has_template_dir"), "skipped", F.lit("missing_template_scene_dir")),
        (~c("has_original_dir"), "skipped", F.lit("missing_original_scene_dir")),
        (~c("has_matches"), "skipped", F.lit("missing_matches_filtered")),
        (~c("has_template"), "skipped", F.lit("missing_rgb_template")),
        raised("matches"),
        (~c("has_reference"), "failed", lost),
        (c("matches_total") < need, "skipped", few("matches_total", "too_few_matches")),
        raised("template"),
        (~c("has_crs"), "skipped", F.lit("template_has_no_crs")),
        raised("selection"),
        (c("gcps_selected") < need, "skipped", few("gcps_selected", "too_few_gcps_after_selection")),
        raised("bands"),
        (c("bands_found") == 0, "skipped", F.lit("no_original_bands_found")),
        raised("warp"),
        (c("bands_written") > 0, "success", F.lit("")),
    )
    status, reason = F.when(F.lit(False), ""), F.when(F.lit(False), "")
    for test, name, text in ladder:
        status, reason = status.when(test, name), reason.when(test, text)
    return s.withColumn("status", status.otherwise("failed")).withColumn("reason", reason.otherwise("no_bands_written"))


def fewest_control_points(gcps: DataFrame, step: float) -> DataFrame:
    """By scene: the least number of control points that a band has left without copies."""
    kept = points.without_copies(gcps, ("sx", "sy"), step, ("scene", "band"))
    return kept.groupBy("scene", "band").agg(F.count(F.lit(1)).alias("n")).groupBy("scene").agg(F.min("n").alias("gcps_after_dedup_min"), F.count(F.lit(1)).alias("bands"))


def band_stack(pixels: DataFrame, radiometry: DataFrame, nodata: float) -> DataFrame:
    """From pixels and radiometry (scene, band, scale, offset: each scene's own): scene, row, col and the four bands on one grid, as single floats: value times scale plus offset, `nodata` where masked. Only pixels that all bands have."""
    one = F.when(c("valid"), (c("value").cast("float") * c("scale").cast("float") + c("offset").cast("float")).cast("float")).otherwise(F.lit(nodata).cast("float"))
    p = pixels.join(radiometry, ["scene", "band"]).select("scene", "row", "col", "band", one.alias("v"))
    wide = p.groupBy("scene", "row", "col").agg(*[F.max(F.when(c("band") == b, c("v"))).alias(b) for b in BANDS])
    return wide.where(" and ".join(f"{b} is not null" for b in BANDS))


def routed(chunks: DataFrame, rules: dict[str, list[str]]) -> DataFrame:
    """Chunks (name) by the prefix of their name: dataset, and a row for each mode; a name without a rule is an error."""
    dataset = F.coalesce(*[F.when(c("name").startswith(k), F.lit(k)) for k in rules])
    modes = F.coalesce(*[F.when(c("name").startswith(k), F.array(*map(F.lit, v))) for k, v in rules.items()])
    known = F.when(dataset.isNull(), F.raise_error(F.concat(F.lit("Unknown chunk name: "), c("name")))).otherwise(dataset)
    return chunks.withColumn("dataset", known).withColumn("mode", F.explode(modes))


def tiling_report(pixels: DataFrame, bands: DataFrame, chunks: DataFrame, rules: dict[str, list[str]], tile: int, height: int, width: int, least: float) -> DataFrame:
    """dataset (with the mode, unless it is native), scene, raw_tiles, valid_tiles, rejected_shape, rejected_valid_ratio of each routed scene that has all four bands. pixels: valid, and valid_float where the float mode's mask is another (it leaves out the float missing value as well); bands: scene_ord, band; chunks: scene_ord, name."""
    whole = bands.groupBy("scene_ord").agg(F.count_distinct(F.when(c("band").isin(*BANDS), c("band"))).alias("n")).where(c("n") == len(BANDS)).select("scene_ord")
    own = pixels.join(whole, "scene_ord")
    float_mask = c("valid_float") if "valid_float" in pixels.columns else c("valid")
    count = lambda mask, mode: coverage.tile_validity(own.withColumn("valid", mask), tile, height, width, least).withColumn("floats", F.lit(mode))
    tiles = count(c("valid"), False).unionByName(count(float_mask, True))
    r = routed(chunks, rules).withColumn("floats", c("mode") == "float32")
    name = F.when(c("mode") == "native", c("dataset")).otherwise(F.concat_ws("-", "dataset", "mode"))
    return tiles.join(r, ["scene_ord", "floats"]).select(name.alias("dataset"), "scene_ord", "raw_tiles", "valid_tiles", "rejected_shape", "rejected_valid_ratio")


def by_dataset(report: DataFrame) -> DataFrame:
    """Sums of a tiling report by dataset."""
    return report.groupBy("dataset").agg(F.count(F.lit(1)).alias("scenes"), *[F.sum(k).alias(k) for k in ("raw_tiles", "valid_tiles", "rejected_shape", "rejected_valid_ratio")])


def mean_validity(pixels: DataFrame, tile: int) -> DataFrame:
    """By scene and tile: share of valid pixel rows."""
    at = [F.floor(c(k) / tile).alias(f"t{k}") for k in ("row", "col")]
    return pixels.groupBy("scene_ord", *at).agg(F.avg(c("valid").cast("double")).alias("valid_fraction"))


def one_band(files: DataFrame, band: str) -> DataFrame:
    """scene, path of a band, for scenes that must have exactly one file of it; none or several is an error."""
    n = F.count_if(c("band") == band)
    path = F.when(n == 1, F.min(F.when(c("band") == band, c("path")))).otherwise(F.raise_error(F.concat(F.lit(f"expected one {band} band: "), c("scene"))))
    return files.groupBy("scene").agg(path.alias("path"))


def prior_gated(m: DataFrame, tiles: DataFrame, h: tuple[float, ...], most: float) -> DataFrame:
    """Tile pairs in coordinates of the whole images (tiles: tile_id, mov_x, mov_y, ref_x, ref_y), where the coarse model leaves at most a distance."""
    j = m.join(tiles, "tile_id")
    j = j.withColumn("x0", c("x0") + c("mov_x")).withColumn("y0", c("y0") + c("mov_y")).withColumn("x1", c("x1") + c("ref_x")).withColumn("y1", c("y1") + c("ref_y"))
    return j.withColumn("residual", points.homography_residual(h)).where(c("residual") <= d(most)).select(*m.columns, "residual")
