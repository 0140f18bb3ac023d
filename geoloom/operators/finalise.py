"""Second phase of preprocessing: exported files that have come are brought to their scenes, and the scenes' summaries updated."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.columns import OFFSETS, c, d
from geoloom.operators import catalog, grid

#: What an export's name has after its scene, the files of a scene's folder, and the words of a summary.
EXPORT, RAW, CENTRE, SHIFTED = "_sentinel2_rgb_raw", "sentinel2_rgb_raw.tif", "sentinel2_rgb_utm.tif", "sentinel2_rgb_utm_ref_"
FINALISED, STRATEGY = "OK_GEE_DRIVE_EXPORT_FINALIZED", "gee_drive_sentinel2_rgb_then_warp_to_native_template_grid"
CANDIDATES = "array<struct<direction:string,path:string,crop_bounds:array<double>>>"
SUMMARY = f"scene string, status string, template_rgb_utm string, gee_local_raw string, sentinel_clipped array<string>, utm_epsg int, dstnodata int, grid_strategy string, multi_reference struct<overlap:double,directions:array<string>,candidates:{CANDIDATES}>, other map<string,string>"
#: The fields that finalising sets anew; the others of a summary stay.
SET = ("status", "template_rgb_utm", "gee_local_raw", "sentinel_clipped", "utm_epsg", "dstnodata", "grid_strategy", "multi_reference")


def exports(files: DataFrame) -> DataFrame:
    """scene, path, n_exact, n_pattern: the export of each scene among files (path), as catalog.exact_or_one()."""
    name = F.substring_index("path", "/", -1)
    own = files.select("path", F.regexp_extract(name, rf"^(.+){EXPORT}.*\.tiff?$", 1).alias("scene"), name.alias("name")).where("scene <> ''").distinct()
    exact = (c("name") == F.concat("scene", F.lit(f"{EXPORT}.tif"))) | (c("name") == F.concat("scene", F.lit(f"{EXPORT}.tiff")))
    return catalog.exact_or_one(own, exact, F.lit(True))


def candidates(centre: list[Column], overlap: Column, directions: Column) -> Column:
    """The centre and its shifted crops (direction, path, bounds), in the order that is asked for."""
    left, bottom, right, top = centre
    names, dx, dy = (F.array(*[F.lit(v) for v in x]) for x in (list(OFFSETS), [float(x) for x, _ in OFFSETS.values()], [float(y) for _, y in OFFSETS.values()]))

    def crop(name: Column) -> Column:
        at = F.array_position(names, name).cast("int")
        x, y = (F.element_at(k, at) * step for k, step in ((dx, (right - left) * (d(1) - overlap)), (dy, (top - bottom) * (d(1) - overlap))))
        path = F.when(name == "C", CENTRE).otherwise(F.concat(F.lit(SHIFTED), name, F.lit(".tif")))
        return F.struct(name.alias("direction"), path.alias("path"), F.array(left + x, bottom + y, right + x, top + y).alias("crop_bounds"))

    return F.transform(directions, crop)


def finalised(scenes: DataFrame, found: DataFrame, settings: DataFrame, epsg: int) -> DataFrame:
    """A report row a scene, and in `summary` what its summary is to say (null where it failed).

    scenes: scene, has_dir, template (path or null), folder, left, bottom, right, top (the centre's bounds); found: as exports(); settings:
    scene, overlap, directions (null: no shifted crops).
    """
    j = scenes.join(found, "scene", "left").join(settings, "scene", "left").na.fill(0, ["n_exact", "n_pattern"])
    error = (
        F.when(~c("has_dir"), F.concat(F.lit("missing scene folder: "), "scene"))
        .when(c("n_exact") > 1, F.format_string("several exact exports (%d)", "n_exact"))
        .when(c("path").isNull(), F.format_string("expected one export, found %d", "n_pattern"))
        .when(c("template").isNull(), F.concat(F.lit("no template: "), "scene"))
    )
    raw, centre = F.concat("folder", F.lit(f"/{RAW}")), F.concat("folder", F.lit(f"/{CENTRE}"))
    made = candidates([c(k) for k in ("left", "bottom", "right", "top")], c("overlap"), grid.directions(c("directions")))
    j = j.withColumn("error", error).withColumn("made", F.when(c("directions").isNotNull() & c("error").isNull(), made))
    multi = F.when(c("made").isNotNull(), F.struct(c("overlap"), F.filter(F.transform("made", lambda x: x["direction"]), lambda x: x != "C").alias("directions"), c("made").alias("candidates")))
    summary = F.struct(
        F.lit(FINALISED).alias("status"), c("template").alias("template_rgb_utm"), raw.alias("gee_local_raw"), F.array(centre).alias("sentinel_clipped"), F.lit(epsg).alias("utm_epsg"), F.lit(0).alias("dstnodata"), F.lit(STRATEGY).alias("grid_strategy"), multi.alias("multi_reference"),
    )
    ok = c("error").isNull()
    return j.select(
        "scene", F.when(ok, "OK").otherwise("FAILED").alias("status"), F.when(ok, c("path")).alias("drive_export"), F.when(ok, raw).alias("raw_path"), F.when(ok, centre).alias("center_reference"),
        F.when(ok, F.coalesce(F.size("made"), F.lit(1))).alias("reference_candidates"), "error", F.when(ok, summary).alias("summary"),
    )


def updated(existing: DataFrame, report: DataFrame) -> DataFrame:
    """SUMMARY rows: existing ones with the fields of SET as the report's summaries say (stale ones go), and new ones. Doing it again changes nothing."""
    new = report.where("summary is not null").select("scene", c("summary").alias("_s"))
    j = existing.join(new, "scene", "full")
    out = [F.when(c("_s").isNotNull(), c(f"_s.{k}")).otherwise(c(k)).alias(k) for k in SET]
    return j.select("scene", *out, "other")
