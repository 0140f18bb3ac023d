"""The catalogue: band files, scenes, lists of scenes, configuration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.functions.columns import OFFSETS, c, is_band_file, is_quicklook, scene_key, scene_times, stem
from geoloom.operators import grid
from geoloom.sources import shared


def parts(path: Column | str) -> Column:
    """A path's components: paths sort by these, not as strings."""
    return F.split(c(path), "/")


def band_files(files: DataFrame) -> DataFrame:
    """path, scene, band of band files; files whose scene name does not fit are left out."""
    b = files.where(is_band_file("path")).select("path", scene_key("path").alias("scene"), F.regexp_extract(stem("path"), "_([BGNR])$", 1).alias("band"))
    return b.where(c("scene") != "")


def strict_scene_key(path: Column | str) -> Column:
    """As scene_key, but a name that does not fit is an error."""
    return F.when(scene_key(path) != "", scene_key(path)).otherwise(F.raise_error(F.concat(F.lit("no scene name: "), c(path))).cast("string"))


def scene_groups(bands: DataFrame) -> DataFrame:
    """Paths of each scene, in order."""
    return bands.groupBy("scene").agg(F.array_sort(F.collect_set("path")).alias("paths"))


def driver_pick(bands: DataFrame, prefer: str) -> DataFrame:
    """One file of each scene: the preferred band's .tif, else its .tiff, else the first .tif, else the first file."""
    rank = F.when(c("path").endswith(f"_{prefer}.tif"), 0).when(c("path").endswith(f"_{prefer}.tiff"), 1).when(c("path").endswith(".tif"), 2).otherwise(3)
    return bands.groupBy("scene").agg(F.min_by("path", F.struct(rank.alias("r"), "path")).alias("driver"))


def band_counts(bands: DataFrame) -> DataFrame:
    """Files of each band by scene, and whether red, green and blue are there exactly once."""
    n = bands.groupBy("scene").agg(*[F.count_if(c("band") == b).alias(f"n_{b.lower()}") for b in "RGBN"])
    return n.withColumn("complete", (c("n_r") == 1) & (c("n_g") == 1) & (c("n_b") == 1))


def same_grid(meta: DataFrame) -> DataFrame:
    """Whether all rasters of a scene share size, reference system and transform."""
    grid = F.struct(*[c(x) for x in ("width", "height", "crs", "a", "b", "c", "d", "e", "f")])
    return meta.groupBy("scene").agg((F.count_distinct(grid) == 1).alias("same_grid"))


def required(files: DataFrame, message: str) -> DataFrame:
    """The files; that there are none is an error (one task looks for a first row)."""
    if files.isEmpty():
        raise ValueError(message)
    return files


def rgb_checked(bands: DataFrame, meta: DataFrame) -> DataFrame:
    """scene, path_R, path_G, path_B, error: the first of what is wrong with a scene's colour bands, in order: the number of files of R, G, B, a file without header (meta), grids that differ."""
    grid = F.struct(*[c(x) for x in ("width", "height", "crs", "a", "b", "c", "d", "e", "f")])
    seen = bands.join(meta.select("path", grid.alias("grid")), "path", "left")
    one = [F.count_if(c("band") == b).alias(f"n_{b}") for b in "RGB"] + [F.min(F.when(c("band") == b, c("path"))).alias(f"path_{b}") for b in "RGB"]
    colour = F.when(c("band").isin(*"RGB"), c("grid"))
    g = seen.groupBy("scene").agg(*one, F.count_if(c("band").isin(*"RGB") & c("grid").isNull()).alias("bare"), F.min(colour).alias("low"), F.max(colour).alias("high"))
    wrong = [F.when(c(f"n_{b}") != 1, F.format_string(f"expected exactly 1 {b} band, found %d", f"n_{b}")) for b in "RGB"]
    wrong += [F.when(c("bare") > 0, "no header"), F.when(~c("low").eqNullSafe(c("high")), "grid mismatch")]
    return g.select("scene", *[f"path_{b}" for b in "RGB"], F.coalesce(*wrong).alias("error"))


def rgb_files(bands: DataFrame, meta: DataFrame) -> DataFrame:
    """scene, path_R, path_G, path_B; a scene whose colour bands aren't three files of one grid is an error."""
    r = rgb_checked(bands, meta)
    first = F.when(c("error").isNull(), c("path_R")).otherwise(F.raise_error(F.concat(c("scene"), F.lit(": "), c("error"))).cast("string"))
    return r.select("scene", first.alias("path_R"), "path_G", "path_B")


def scene_index(bands: DataFrame, roots: dict[str, int], meta: DataFrame | None = None, target: str | None = None) -> DataFrame:
    """One row a scene with its four paths and times: the first in the order of roots, then of paths; scenes without all bands in one folder are left out. With headers of files (meta), also crs, native bounds, resolution and missing value of the red band; places without a reference system are left out before the first is taken. With a target reference system, bounds are in that one."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    order = F.coalesce(*[F.when(c("path").startswith(r + "/"), F.lit(o)) for r, o in sorted(roots.items())])
    wide = bands.withColumn("root", order).where(c("root").isNotNull()).groupBy("scene", "root", folder.alias("folder")).agg(*[F.min(F.when(c("band") == b, c("path"))).alias(f"path_{b}") for b in "RGBN"])
    wide = wide.where(" and ".join(f"path_{b} is not null" for b in "RGBN"))
    header = []
    if meta is not None:
        wide = wide.join(meta.where("crs is not null").select(c("path").alias("path_R"), "crs", *raster_bounds(), F.abs("a").alias("res_x"), F.abs("e").alias("res_y"), "nodata"), "path_R")
        header = ["crs", "minx", "miny", "maxx", "maxy", "res_x", "res_y", "nodata"]
    first = W.partitionBy("scene").orderBy("root", parts("path_R"))
    one = wide.withColumn("rn", F.row_number().over(first)).where("rn = 1")
    t = scene_times("scene")
    out = one.select(c("scene").alias("scene_id"), *[t[k].alias(k) for k in ("acq_start", "acq_end", "acq_day", "processing_time")], *[f"path_{b}" for b in "RGBN"], *header)
    if meta is None or target is None:
        return out
    return out.drop("minx", "miny", "maxx", "maxy").join(grid.reprojected(out.select("scene_id", "crs", "minx", "miny", "maxx", "maxy"), "scene_id", target), "scene_id").select(*out.columns)


def raster_bounds() -> tuple[Column, ...]:
    """minx, miny, maxx, maxy of a north-up raster from its size and affine coefficients."""
    x, y = c("c") + c("a") * c("width"), c("f") + c("e") * c("height")
    return F.least("c", x).alias("minx"), F.least("f", y).alias("miny"), F.greatest("c", x).alias("maxx"), F.greatest("f", y).alias("maxy")


def scene_list(lines: DataFrame, comments: bool = True, distinct: bool = True) -> DataFrame:
    """Scene names of list files in order: trimmed, without blank and comment lines, base name of paths, first occurrence only."""
    text = F.trim(c("line"), F.lit(" \t\r\n\f\v"))
    t = lines.select("file", "pos", text.alias("t")).where(c("t") != "")
    if comments:
        t = t.where(~c("t").startswith("#"))
    t = t.select("file", "pos", F.substring_index(F.rtrim(c("t"), F.lit("/")), "/", -1).alias("scene"))
    if not distinct:
        return t
    return t.groupBy("scene").agg(F.min(F.struct("file", "pos")).alias("at")).select("at.file", "at.pos", "scene")


def missing(wanted: DataFrame, have: DataFrame) -> DataFrame:
    """Wanted scenes that are not there."""
    return wanted.join(have, "scene", "left_anti")


def numbered(scenes: DataFrame) -> DataFrame:
    """scenes with their places in order (from 0): sorted by ranges, counted by range, and numbered inside each; no task has them all."""
    spark = scenes.sparkSession
    path = shared.scratch(spark)
    scenes.repartitionByRange("scene").sortWithinPartitions("scene").withColumn("_id", F.monotonically_increasing_id()).write.parquet(path)
    dealt = spark.read.parquet(path)
    part = F.shiftright("_id", 33)
    counts = dealt.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))  # a row a range
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    return dealt.withColumn("_part", part).join(before, "_part").withColumn("place", c("_before") + c("_id").bitwiseAND(F.lit((1 << 33) - 1))).drop("_id", "_part", "_before")


def batch(scenes: DataFrame, start: int | None, end: int | None) -> DataFrame:
    """Scenes whose places in order lie from start to end, as Python slices a list (negative numbers count from the end)."""
    n = scenes.count() if (start or 0) < 0 or (end or 0) < 0 else 0
    lo = max(0, (start or 0) + (n if (start or 0) < 0 else 0))
    found = numbered(scenes).where(c("place") >= lo)
    if end is not None:
        found = found.where(c("place") < end + (n if end < 0 else 0))
    return found.drop("place").orderBy("scene")


def exact_or_one(files: DataFrame, exact: Column, pattern: Column) -> DataFrame:
    """By scene: the file with the exact name, else the only one that fits the pattern; how many fit tells why none is found."""
    m = files.groupBy("scene").agg(F.count_if(exact).alias("n_exact"), F.count_if(pattern).alias("n_pattern"), F.min(F.when(exact, c("path"))).alias("e"), F.min(F.when(pattern, c("path"))).alias("p"))
    return m.select("scene", "n_exact", "n_pattern", F.when(c("n_exact") == 1, c("e")).when((c("n_exact") == 0) & (c("n_pattern") == 1), c("p")).alias("path"))


def first_match(files: DataFrame, patterns: list[str]) -> DataFrame:
    """By scene: the first file in order of the first pattern that any file fits."""
    rank = F.lit(len(patterns))
    for i, p in reversed(list(enumerate(patterns))):
        rank = F.when(F.substring_index("path", "/", -1).rlike(p), i).otherwise(rank)
    return files.withColumn("rank", rank).where(c("rank") < len(patterns)).groupBy("scene").agg(F.min_by("path", F.struct("rank", "path")).alias("path"))


def settings(scenes: DataFrame, config: DataFrame, everywhere: tuple[float, list[str]] | None = None) -> DataFrame:
    """Neighbour settings by scene: those for all scenes if given, else the scene's own, else none."""
    j = scenes.join(config.select("scene", "overlap", "directions"), "scene", "left")
    if everywhere is None:
        return j
    return j.withColumn("overlap", F.lit(everywhere[0])).withColumn("directions", F.array(*map(F.lit, everywhere[1])))


def georeferencing_status(scenes: DataFrame, templates: DataFrame, originals: DataFrame, matches: DataFrame, least: int) -> DataFrame:
    """Status and the first reason, in a fixed order, why a scene cannot be georeferenced."""
    j = scenes.join(templates.select("scene", F.lit(True).alias("t")), "scene", "left").join(originals.select("scene", F.lit(True).alias("o")), "scene", "left").join(matches.select("scene", "n_matches"), "scene", "left")
    reason = F.when(c("t").isNull(), "missing_template_scene_dir").when(c("o").isNull(), "missing_original_scene_dir").when(c("n_matches").isNull(), "missing_matches_filtered").when(c("n_matches") < least, F.format_string("too_few_matches(%d)", "n_matches"))
    return j.select("scene", F.when(reason.isNull(), "success").otherwise("skipped").alias("status"), reason.alias("reason"))


def tile_paths(files: DataFrame, datasets: list[str] | None = None) -> DataFrame:
    """path, dataset, scene, tile_name of tile files below dataset/scene/."""
    t = files.where(c("path").rlike(r"(?i)\.tiff?$")).select("*", F.element_at(parts("path"), -3).alias("dataset"), F.element_at(parts("path"), -2).alias("scene"), stem("path").alias("tile_name"))
    return t.where(c("dataset").isin(datasets)) if datasets else t


#: Names of a scene's template and reference below its folder, in order (callers with other names pass their own), and of the original bands.
TEMPLATES, REFERENCES = [r"^template_rgb_utm.*\.tif$", r"^template_rgb_native.*\.tif$"], [r"^sentinel2_rgb_utm.*\.tif$"]
ORIGINAL = r"_[BGNR]\.tiff?$"


def scene_inputs(current: DataFrame, legacy: DataFrame, templates: list[str] | None = None, references: list[str] | None = None) -> DataFrame:
    """scene, template, reference, legacy (whether both come from the legacy folder): the current folder's files (scene, path) where it has both kinds, else the legacy one's where that has both, else nulls."""

    def of(files: DataFrame, name: str) -> DataFrame:
        t, r = first_match(files, templates or TEMPLATES).select("scene", c("path").alias("t")), first_match(files, references or REFERENCES).select("scene", c("path").alias("r"))
        return t.join(r, "scene").select("scene", F.struct("t", "r").alias(name))

    every = current.select("scene").union(legacy.select("scene")).distinct()
    j = every.join(of(current, "now"), "scene", "left").join(of(legacy, "old"), "scene", "left")
    found = F.coalesce("now", "old")
    return j.select("scene", found["t"].alias("template"), found["r"].alias("reference"), (c("now").isNull() & c("old").isNotNull()).alias("legacy"))


def original_bands(files: DataFrame) -> DataFrame:
    """scene, band, path, n of the original band files (scene, path), in order of their paths; quicklooks are none."""
    name = F.substring_index("path", "/", -1)
    found = files.where(name.rlike(ORIGINAL) & ~is_quicklook("path")).withColumn("band", F.regexp_extract(name, r"_([BGNR])\.tiff?$", 1))
    return found.select("scene", "band", "path", F.row_number().over(W.partitionBy("scene").orderBy("path")).alias("n"))


def georeferenced_band(files: DataFrame) -> DataFrame:
    """scene, band, path of georeferenced bands (scene, path): the file that is named exactly, else the only one; null and an error where several or none fit."""
    name = F.substring_index("path", "/", -1)
    f = files.withColumn("band", F.regexp_extract(name, r"_([BGNR])_georef_tps\.tif$", 1)).where("band <> ''")
    keyed = f.select(F.struct("scene", "band").alias("scene"), "path", (name == F.concat("scene", F.lit("_"), "band", F.lit("_georef_tps.tif"))).alias("exact"))
    one = exact_or_one(keyed, c("exact"), F.lit(True))
    return one.select("scene.scene", "scene.band", "path", F.when(c("path").isNull(), F.format_string("expected one band, found %d", "n_pattern")).alias("error"))


def aligned_root(files: DataFrame) -> DataFrame:
    """files (root, path) of the aligned folder below each root that has one, else those of the root itself."""
    inside = F.startswith("path", F.concat("root", F.lit("/aligned/")))
    has = files.groupBy("root").agg(F.bool_or(inside).alias("_has"))
    return files.join(has, "root").where(~c("_has") | inside).withColumn("base", F.when(c("_has"), F.concat("root", F.lit("/aligned"))).otherwise(c("root"))).drop("_has")


FIELDS = ("overlap", "directions")


def checked_settings(config: DataFrame) -> DataFrame:
    """scene, overlap, directions, error of configuration entries (scene, entry: a JSON object): unknown fields, an overlap that is missing, no number or outside [0, 1), directions that are no list or none of the known ones."""
    e = config.withColumn("m", F.from_json("entry", "map<string,string>")).withColumn("unknown", F.array_sort(F.array_except(F.map_keys("m"), F.array(*map(F.lit, FIELDS)))))
    overlap = F.get(F.map_values(F.map_filter("m", lambda k, v: k == "overlap")), F.lit(0)).try_cast("double")
    text = F.get(F.map_values(F.map_filter("m", lambda k, v: k == "directions")), F.lit(0))
    listed = F.from_json(text, "array<string>")
    up = F.transform(listed, F.upper)
    bad = F.array_except(up, F.array(*map(F.lit, OFFSETS)))
    error = (
        F.when(c("m").isNull(), "no object")
        .when(F.size("unknown") > 0, F.concat(F.lit("unknown fields: "), F.array_join("unknown", ",")))
        .when(overlap.isNull() | F.isnan(overlap) | (overlap < 0) | (overlap >= 1), "overlap is no number in [0, 1)")
        .when(text.isNotNull() & (listed.isNull() | ~F.startswith(F.ltrim(text), F.lit("["))), "directions are no list")
        .when(F.size(bad) > 0, F.concat(F.lit("unknown directions: "), F.array_join(F.array_distinct(bad), ",")))
    )
    every = F.array(*[F.lit(k) for k in OFFSETS if k != "C"])
    ok = error.isNull()
    return e.select("scene", F.when(ok, overlap).alias("overlap"), F.when(ok, F.concat(F.array(F.lit("C")), F.array_remove(F.array_distinct(F.coalesce(up, every)), "C"))).alias("directions"), error.alias("error"))


def everywhere(use: bool, overlap: float | None, directions: list[str] | None) -> tuple[float, list[str]] | None:
    """The settings for all scenes that settings() takes, from a job's flags; flags that contradict each other are an error."""
    if not use:
        if overlap is not None or directions is not None:
            raise ValueError("overlap and directions need the flag for all scenes")
        return None
    if overlap is None or not 0 <= overlap < 1:
        raise ValueError("all scenes need an overlap in [0, 1)")
    up = list(dict.fromkeys(x.upper() for x in directions)) if directions else [k for k in OFFSETS if k != "C"]
    if bad := [x for x in up if x not in OFFSETS]:
        raise ValueError(f"unknown directions: {','.join(bad)}")
    return overlap, ["C", *[x for x in up if x != "C"]]
