"""Reference candidates of a scene: from its summary, by discovery, their checks, and which one was selected."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from geoloom.functions.columns import OFFSETS, c, d
from geoloom.operators import grid

SUMMARY = "multi_reference struct<candidates:array<struct<direction:string,path:string,crop_bounds:array<double>>>>"


def absolute(path: Column, folder: Column) -> Column:
    """A path below a folder, unless it begins at a root or names a store."""
    return F.when(path.startswith("/") | path.contains("://"), path).otherwise(F.concat(folder, F.lit("/"), path))


def configured(scenes: DataFrame) -> DataFrame:
    """scene, pos, direction, path, crop_bounds of each candidate, from scene, folder, summary (JSON or null), center (path) and bounds; a scene without candidates has its centre as `C`."""
    s = scenes.withColumn("found", F.from_json("summary", SUMMARY)["multi_reference"]["candidates"])
    own = F.transform("found", lambda x: F.struct(F.upper(x["direction"]).alias("direction"), absolute(x["path"], c("folder")).alias("path"), x["crop_bounds"].alias("crop_bounds")))
    alone = F.array(F.struct(F.lit("C").alias("direction"), c("center").alias("path"), c("bounds").alias("crop_bounds")))
    return s.select("scene", F.posexplode(F.when(F.size("found") > 0, own).otherwise(alone)).alias("pos", "x")).select("scene", "pos", "x.*")


def missing(candidates: DataFrame, files: DataFrame) -> DataFrame:
    """Candidates whose path is no file."""
    return candidates.join(files.select("path").distinct(), "path", "left_anti")


def discovered(files: DataFrame, center: str, prefix: str) -> DataFrame:
    """folder, direction, path of reference files by name (center.tif, then prefixDIRECTION.tif in order of their paths); pos is their order."""
    name, folder = F.element_at(F.split("path", "/"), -1), F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    direction = F.when(name == center, "C").when(name.startswith(prefix) & name.endswith(".tif"), F.regexp_replace(F.substring(name, len(prefix) + 1, F.lit(1 << 20)), r"\.tif$", ""))
    f = files.select(folder.alias("folder"), direction.alias("direction"), "path").where("direction is not null")
    return f.withColumn("pos", F.row_number().over(W.partitionBy("folder").orderBy(c("direction") != "C", "path")) - 1)


def checked(scenes: DataFrame) -> DataFrame:
    """scene, expected, actual, errors, status. scenes: scene, directions (configured or null), actual (listed in the summary or null); lists are compared in their order."""
    expected = F.when(c("directions").isNull(), F.array().cast("array<string>")).otherwise(grid.directions(c("directions")))
    actual = F.coalesce(F.transform("actual", F.upper), F.array().cast("array<string>"))
    show = lambda a: F.concat(F.lit("["), F.array_join(a, ", "), F.lit("]"))
    s = scenes.select("scene", c("directions").isNull().alias("no_config"), c("actual").isNull().alias("no_summary"), expected.alias("expected"), actual.alias("actual"))
    differ = F.concat(F.lit("candidate directions "), show(c("actual")), F.lit(" != expected "), show(c("expected")))
    errors = F.array_compact(F.array(F.when(c("no_config"), "scene is missing from multi-reference config"), F.when(c("no_summary"), "missing scene_prep_summary.json"), F.when(c("actual") != c("expected"), differ)))
    return s.select("scene", "expected", "actual", errors.alias("errors"), F.when(F.size(errors) == 0, "PASS").otherwise("FAIL").alias("status"))


def grid_errors(candidates: DataFrame) -> DataFrame:
    """Candidates with what differs from their scene's centre: size, reference system, resolution, and place for the overlap. Columns: w, h, crs, xres, yres, left, bottom of the candidate, the same with c_ for the centre, and overlap."""
    tolerance = F.greatest(c("c_xres"), c("c_yres"), d(1.0)) * d(0.01)
    dx = F.coalesce(*[F.when(c("direction") == k, d(x)) for k, (x, _) in OFFSETS.items()], d(0))
    dy = F.coalesce(*[F.when(c("direction") == k, d(y)) for k, (_, y) in OFFSETS.items()], d(0))
    left, bottom = c("c_left") + dx * c("c_w") * c("c_xres") * (d(1) - c("overlap")), c("c_bottom") + dy * c("c_h") * c("c_yres") * (d(1) - c("overlap"))
    far = lambda a, b: F.abs(a - b) > tolerance
    rules = (
        ((c("w") != c("c_w")) | (c("h") != c("c_h")), "raster dimensions differ from center"),
        (~c("crs").eqNullSafe(c("c_crs")), "CRS differs from center"),
        (far(c("xres"), c("c_xres")), "x resolution differs from center"),
        (far(c("yres"), c("c_yres")), "y resolution differs from center"),
        (far(c("left"), left), "unexpected horizontal crop shift"),
        (far(c("bottom"), bottom), "unexpected vertical crop shift"),
    )
    return candidates.withColumn("errors", F.array_compact(F.array(*[F.when(test, F.concat("direction", F.lit(f": {text}"))) for test, text in rules])))


def outcomes(tried: DataFrame) -> DataFrame:
    """Candidates with status (ok, rejected, error) and whether they are selected: of the ok ones of a scene, that with the most inliers, the first of equals. tried: scene, pos, inliers, exportable, failure (message or null)."""
    status = F.when(c("failure").isNotNull(), "error").when(c("exportable"), "ok").otherwise("rejected")
    t = tried.withColumn("status", status)
    ok = c("status") == "ok"
    return t.withColumn("selected", ok & (F.row_number().over(W.partitionBy("scene").orderBy(F.when(ok, 0).otherwise(1), F.desc("inliers"), "pos")) == 1))


def selected(scenes: DataFrame) -> DataFrame:
    """scene, direction, path, reason of the reference that was used: georeferencing metadata before match documents; a path that is no file (`exists_*`) is looked for by its name in the scene's folder. Columns: meta_direction, meta_path, match_direction, match_path, folder, files (array of paths that exist)."""
    direction = F.upper(F.coalesce("meta_direction", "match_direction"))
    path = F.coalesce(c("meta_path"), F.when(c("meta_direction").isNotNull(), c("meta_reference")).otherwise(c("match_path")))
    near = F.concat("folder", F.lit("/"), F.element_at(F.split(path, "/"), -1))
    at = F.when(F.array_contains("files", path), path).when(F.array_contains("files", near), near)
    reason = F.when(direction.isNull(), "no_selected_reference_metadata").when(at.isNull(), "selected_reference_missing")
    return scenes.select("scene", F.when(reason.isNull(), direction).alias("direction"), F.when(direction.isNotNull(), at).alias("path"), reason.alias("reason"))
