"""Queries over files, lists, configuration, reports, pixels and predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom.adapters import sql, table, v_config, v_files, v_lines, v_preds, v_reports, v_rgb
from geoloom.functions import columns as fc
from geoloom.functions.columns import c, d
from geoloom.operators import catalog, classify, raster, reports

BANDS_SQL = r"""bands AS (SELECT path, regexp_extract(stem, '^(20\d{6}T\d{6}_20\d{6}T\d{6}_[A-Za-z0-9]+_.*?)_[BGNR]$', 1) AS scene, regexp_extract(stem, '_([BGNR])$', 1) AS band
 FROM (SELECT path, regexp_replace(regexp_extract(path, '[^/]*$'), '\.[^.]*$', '') AS stem FROM v_files) WHERE NOT contains(path, '_1QK_') AND regexp_matches(stem, '_[BGNR]$'))"""
TEXT_SQL = r"""t AS (SELECT file, pos, trim(line, e' \t\r\n\f\v') AS t FROM v_lines), s AS (SELECT file, pos, regexp_extract(rtrim(t, '/'), '[^/]*$') AS scene FROM t WHERE t <> '' AND NOT starts_with(t, '#')),
firsts AS (SELECT file, pos, scene FROM (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY file, pos) AS rn FROM s) WHERE rn = 1)"""
PRED_SQL = """e AS (SELECT *, list_transform(logits, lambda x: exp(x - list_max(logits))) AS e FROM v_preds), p AS (SELECT *, list_transform(e, lambda x: x / (e[1] + e[2] + e[3] + e[4])) AS p FROM e),
preds AS (SELECT path, ord, dataset, scene, tile_name, CAST(list_position(p, list_max(p)) - 1 AS INT) AS pred_id, ['clear', 'cloud', 'shadow', 'snow'][list_position(p, list_max(p))] AS pred_label, p[1] AS prob_clear, p[2] AS prob_cloud, p[3] AS prob_shadow, p[4] AS prob_snow FROM p)"""


def bands(spark, sf):
    return catalog.band_files(v_files(spark, sf))


def scenes(spark, sf):
    return catalog.scene_list(v_lines(spark, sf))


def predictions(spark, sf):
    return classify.predictions(catalog.tile_paths(v_preds(spark, sf)))


def reference_scenes(spark, sf):
    return table(spark, sf, "customer").select(c("c_custkey").alias("scene"))


def meta(spark, sf):
    p = table(spark, sf, "part")
    one = lambda x: d(x)
    return p.select((c("p_partkey") % 97).alias("scene"), (c("p_size") * 0 + 100 + (c("p_partkey") % 97 % 5 == 0).cast("int") * c("p_size")).alias("width"), F.lit(100).alias("height"), F.lit("x").alias("crs"), *[one(i).alias(k) for i, k in enumerate("abcdef")])


def file_meta(spark, sf):
    """A header for each file: two widths, by the length of the path."""
    return v_files(spark, sf).select("path", (F.length("path") % 2 + 100).alias("width"), F.lit(100).alias("height"), F.lit("x").alias("crs"), *[d(i).alias(k) for i, k in enumerate("abcdef")]).distinct()


def georef(spark, sf):
    s = reference_scenes(spark, sf)
    return catalog.georeferencing_status(s, s.where("scene % 7 <> 0"), s.where("scene % 11 <> 0"), s.where("scene % 5 <> 0").select("scene", (c("scene") % 40).alias("n_matches")), 12)


def stretch(kind: str, least: int):
    def run(spark, sf):
        out = raster.stretched(v_rgb(spark, sf), ("r", "g", "b"), least, kind)
        if kind == "unit":
            return out.groupBy("scene").agg(*[F.round(F.avg(k), 6).alias(k) for k in "rgb"])
        return out.groupBy("scene").agg(*[F.sum(k).cast("long").alias(k) for k in "rgb"])

    return run


def stretch_sql(kind: str, least: int) -> str:
    lim = ", ".join(f"quantile_cont({b}::DOUBLE, 0.02) AS {b}l, quantile_cont({b}::DOUBLE, 0.98) AS {b}h, min({b}) AS {b}n, max({b}) AS {b}x" for b in "rgb")

    def value(b: str) -> str:
        lo, hi = f"{b}l", f"{b}h"
        if kind == "round":
            lo, hi = f"CASE WHEN {b}h <= {b}l THEN {b}n ELSE {b}l END", f"CASE WHEN {b}h <= {b}l THEN {b}x ELSE {b}h END"
        x = f"least(greatest(({b} - ({lo})) / (({hi}) - ({lo}) + 1e-8::DOUBLE), 0.0), 1.0)"
        x = {"truncate": f"CASE WHEN n >= {least} THEN floor({x} * 255) ELSE 0 END", "round": f"round_even({x} * 255, 0)", "unit": x}[kind]
        x = f"CASE WHEN valid THEN {x} ELSE 0 END"
        return f"round(avg({x}), 6) AS {b}" if kind == "unit" else f"sum({x})::BIGINT AS {b}"

    return sql(f"WITH lim AS (SELECT scene, count(*) AS n, {lim} FROM v_rgb WHERE valid GROUP BY 1) SELECT scene, {', '.join(map(value, 'rgb'))} FROM v_rgb JOIN lim USING (scene) GROUP BY 1", "v_rgb")


MASKS = {"plain": fc.valid_plain, "above": fc.valid_above, "between": fc.valid_between}


def masks(spark, sf):
    """Each validity rule over values that hold missing, infinite, undefined and extreme ones."""
    v = F.when(c("c_custkey") % 9 == 0, d(float("nan"))).when(c("c_custkey") % 9 == 1, d(float("inf"))).when(c("c_custkey") % 9 == 2, d(-9999)).when(c("c_custkey") % 9 == 3, d(-2e6)).when(c("c_custkey") % 9 == 4, d(3e20)).otherwise(c("c_acctbal"))
    t = table(spark, sf, "customer").select(v.alias("v"))
    return t.agg(*[F.count_if(f("v", -9999.0)).alias(f"n_{k}") for k, f in MASKS.items()], F.count_if(fc.cleaned("v", -9999.0, 0.0) == 0).alias("n_cleaned"))


QUERIES = {
    "q_band_files": (bands, sql(f"WITH {BANDS_SQL} SELECT path, scene, band FROM bands WHERE scene <> ''", "v_files")),
    "q_quicklooks": (
        lambda s, sf: v_files(s, sf).select(fc.is_quicklook("path").alias("quicklook")).groupBy("quicklook").agg(F.count(F.lit(1)).alias("n")),
        sql(r"SELECT contains(path, '_1QK_') OR regexp_matches(path, '_1QK\.tiff?$') AS quicklook, count(*) AS n FROM v_files GROUP BY 1", "v_files"),
    ),
    "q_scene_groups": (
        lambda s, sf: catalog.scene_groups(bands(s, sf)).select("scene", F.array_join("paths", ",").alias("paths")),
        sql(f"WITH {BANDS_SQL} SELECT scene, string_agg(DISTINCT path, ',' ORDER BY path) AS paths FROM bands WHERE scene <> '' GROUP BY 1", "v_files"),
    ),
    "q_driver_pick": (
        lambda s, sf: catalog.driver_pick(bands(s, sf), "R"),
        sql(f"WITH {BANDS_SQL} SELECT scene, path AS driver FROM (SELECT DISTINCT scene, path, row_number() OVER (PARTITION BY scene ORDER BY CASE WHEN ends_with(path, '_R.tif') THEN 0 WHEN ends_with(path, '_R.tiff') THEN 1 WHEN ends_with(path, '.tif') THEN 2 ELSE 3 END, path) AS rn FROM bands WHERE scene <> '') WHERE rn = 1", "v_files"),
    ),
    "q_band_counts": (
        lambda s, sf: catalog.band_counts(bands(s, sf)),
        sql(f"WITH {BANDS_SQL}, n AS (SELECT scene, count(*) FILTER (band = 'R') AS n_r, count(*) FILTER (band = 'G') AS n_g, count(*) FILTER (band = 'B') AS n_b, count(*) FILTER (band = 'N') AS n_n FROM bands WHERE scene <> '' GROUP BY 1) SELECT *, n_r = 1 AND n_g = 1 AND n_b = 1 AS complete FROM n", "v_files"),
    ),
    "q_rgb_checked": (
        lambda s, sf: catalog.rgb_checked(bands(s, sf).withColumn("scene", F.substring("scene", 1, 12)), file_meta(s, sf)),
        sql(
            f"""WITH {BANDS_SQL}, g AS (SELECT left(scene, 12) AS scene, count(*) FILTER (band = 'R') AS n_r, count(*) FILTER (band = 'G') AS n_g, count(*) FILTER (band = 'B') AS n_b, min(path) FILTER (band = 'R') AS "path_R", min(path) FILTER (band = 'G') AS "path_G",
 min(path) FILTER (band = 'B') AS "path_B", count(DISTINCT length(path) % 2) FILTER (band <> 'N') AS n_grids FROM bands WHERE scene <> '' GROUP BY 1)
SELECT scene, "path_R", "path_G", "path_B", CASE WHEN n_r <> 1 THEN 'expected exactly 1 R band, found ' || n_r WHEN n_g <> 1 THEN 'expected exactly 1 G band, found ' || n_g WHEN n_b <> 1 THEN 'expected exactly 1 B band, found ' || n_b WHEN n_grids > 1 THEN 'grid mismatch' END AS error FROM g""",
            "v_files",
        ),
    ),
    "q_same_grid": (
        lambda s, sf: catalog.same_grid(meta(s, sf)),
        "SELECT p_partkey % 97 AS scene, count(DISTINCT CASE WHEN p_partkey % 97 % 5 = 0 THEN 100 + p_size ELSE 100 END) = 1 AS same_grid FROM part GROUP BY 1",
    ),
    "q_scene_index": (
        lambda s, sf: catalog.scene_index(bands(s, sf).withColumn("scene", F.substring("scene", 1, 11)).withColumn("path", F.regexp_replace("path", r"/[^/]*(_[BGNR]\.)", r"/x$1")), {"/data/root1": 0, "/data/root0": 1, "/data/root2": 2}),
        sql(
            rf"""WITH {BANDS_SQL}, x AS (SELECT left(scene, 11) AS scene, regexp_replace(path, '/[^/]*(_[BGNR]\.)', '/x\1') AS path, band FROM bands WHERE scene <> ''),
w AS (SELECT scene, CASE path[11:11] WHEN '1' THEN 0 WHEN '0' THEN 1 ELSE 2 END AS root, min(path) FILTER (band = 'R') AS r, min(path) FILTER (band = 'G') AS g, min(path) FILTER (band = 'B') AS b, min(path) FILTER (band = 'N') AS n FROM x GROUP BY 1, 2)
SELECT scene AS scene_id, 'unknown' AS acq_start, 'unknown' AS acq_end, 'unknown' AS acq_day, 'unknown' AS processing_time, r AS "path_R", g AS "path_G", b AS "path_B", n AS "path_N" FROM (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY root, r) AS rn FROM w WHERE r IS NOT NULL AND g IS NOT NULL AND b IS NOT NULL AND n IS NOT NULL) WHERE rn = 1""",
            "v_files",
        ),
    ),
    "q_scene_times": (
        lambda s, sf: bands(s, sf).select("path", *[v.alias(k) for k, v in fc.scene_times("scene").items()]),
        sql(rf"WITH {BANDS_SQL}, t AS (SELECT path, regexp_extract_all(scene, '\d{{8}}T\d{{6}}') AS t FROM bands WHERE scene <> '') SELECT path, coalesce(t[1], 'unknown') AS acq_start, coalesce(t[2], 'unknown') AS acq_end, CASE WHEN len(t) >= 3 THEN t[-1] ELSE 'unknown' END AS processing_time, coalesce(left(t[1], 8), 'unknown') AS acq_day FROM t", "v_files"),
    ),
    "q_time_window": (
        lambda s, sf: (lambda w: bands(s, sf).select("scene").distinct().select("scene", w[0].alias("first_day"), w[1].alias("last_day")))(fc.time_window(fc.acquisition_date("scene"), 60)),
        sql(f"WITH {BANDS_SQL} SELECT DISTINCT scene, strftime(strptime(left(scene, 8), '%Y%m%d') - INTERVAL 60 DAY, '%Y-%m-%d') AS first_day, strftime(strptime(left(scene, 8), '%Y%m%d') + INTERVAL 60 DAY, '%Y-%m-%d') AS last_day FROM bands WHERE scene <> ''", "v_files"),
    ),
    "q_scene_list": (scenes, sql(f"WITH {TEXT_SQL} SELECT * FROM firsts", "v_lines")),
    "q_scene_list_all": (
        lambda s, sf: catalog.scene_list(v_lines(s, sf), comments=False, distinct=False).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("scene").alias("n_scenes")),
        sql(r"WITH t AS (SELECT trim(line, e' \t\r\n\f\v') AS t FROM v_lines) SELECT count(*) AS n, count(DISTINCT regexp_extract(rtrim(t, '/'), '[^/]*$')) AS n_scenes FROM t WHERE t <> ''", "v_lines"),
    ),
    "q_missing_scenes": (
        lambda s, sf: catalog.missing(scenes(s, sf).select("scene"), scenes(s, sf).where("file % 3 <> 0").select("scene")),
        sql(f"WITH {TEXT_SQL} SELECT scene FROM firsts WHERE file % 3 = 0", "v_lines"),
    ),
    "q_batch": (
        lambda s, sf: catalog.batch(bands(s, sf).select("scene").distinct(), 10, 60),
        sql(f"WITH {BANDS_SQL} SELECT DISTINCT scene FROM bands WHERE scene <> '' ORDER BY scene LIMIT 50 OFFSET 10", "v_files"),
    ),
    "q_settings": (
        lambda s, sf: catalog.settings(reference_scenes(s, sf), v_config(s, sf).where("scene % 3 = 0")).select("scene", "overlap", F.array_join("directions", ",").alias("directions")),
        sql("SELECT c_custkey AS scene, overlap, array_to_string(directions, ',') AS directions FROM customer LEFT JOIN (SELECT * FROM v_config WHERE scene % 3 = 0) ON scene = c_custkey", "v_config"),
    ),
    "q_exact_or_one": (
        lambda s, sf: catalog.exact_or_one(bands(s, sf), c("path").endswith("_R.tif"), c("path").rlike(r"_R\.tif")),
        sql(rf"WITH {BANDS_SQL}, m AS (SELECT scene, count(*) FILTER (ends_with(path, '_R.tif')) AS n_exact, count(*) FILTER (regexp_matches(path, '_R\.tif')) AS n_pattern, min(path) FILTER (ends_with(path, '_R.tif')) AS e, min(path) FILTER (regexp_matches(path, '_R\.tif')) AS p FROM bands WHERE scene <> '' GROUP BY 1) SELECT scene, n_exact, n_pattern, CASE WHEN n_exact = 1 THEN e WHEN n_exact = 0 AND n_pattern = 1 THEN p END AS path FROM m", "v_files"),
    ),
    "q_first_match": (
        lambda s, sf: catalog.first_match(bands(s, sf), [r"_N\.tif$", r"_B\.tiff?$"]),
        sql(rf"WITH {BANDS_SQL} SELECT scene, min(CASE WHEN regexp_matches(path, '_N\.tif$') THEN '0' || path ELSE '1' || path END)[2:] AS path FROM bands WHERE scene <> '' AND (regexp_matches(path, '_N\.tif$') OR regexp_matches(path, '_B\.tiff?$')) GROUP BY 1", "v_files"),
    ),
    "q_georef_status": (
        georef,
        "SELECT c_custkey AS scene, CASE WHEN r IS NULL THEN 'success' ELSE 'skipped' END AS status, r AS reason FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'missing_template_scene_dir' WHEN c_custkey % 11 = 0 THEN 'missing_original_scene_dir' WHEN c_custkey % 5 = 0 THEN 'missing_matches_filtered' WHEN c_custkey % 40 < 12 THEN 'too_few_matches(' || (c_custkey % 40) || ')' END AS r FROM customer)",
    ),
    "q_report_merge": (
        lambda s, sf: reports.merged(v_reports(s, sf)),
        sql("SELECT file, pos, scene, status, 0 AS part FROM (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY file DESC, pos DESC) AS rn FROM v_reports WHERE scene IS NOT NULL) WHERE rn = 1 UNION ALL SELECT file, pos, scene, status, 1 FROM v_reports WHERE scene IS NULL", "v_reports"),
    ),
    "q_report_header": (
        lambda s, sf: reports.with_common_header([v_reports(s, sf).where("pos % 2 = 0").select("scene", "status"), v_reports(s, sf).where("pos % 2 = 1").select("file", "status")]),
        sql("SELECT NULL AS file, scene, status FROM v_reports WHERE pos % 2 = 0 UNION ALL SELECT file, NULL, status FROM v_reports WHERE pos % 2 = 1", "v_reports"),
    ),
    "q_report_totals": (
        lambda s, sf: reports.totals(v_reports(s, sf), "assistant"),
        sql("SELECT count(*) FILTER (status = 'assistant') AS n_success, count(*) FILTER (status <> 'assistant') AS n_failed FROM v_reports", "v_reports"),
    ),
    "q_status_counts": (
        lambda s, sf: reports.status_counts(v_reports(s, sf), "file", ("user", "assistant")),
        sql("SELECT file, count(*) FILTER (status = 'user') AS n_user, count(*) FILTER (status = 'assistant') AS n_assistant FROM v_reports GROUP BY 1", "v_reports"),
    ),
    "q_report_json": (
        lambda s, sf: reports.as_json(v_reports(s, sf).select("pos", "status")).groupBy("value").agg(F.count(F.lit(1)).alias("n")),
        sql("""SELECT '{"pos":' || pos || ',"status":"' || status || '"}' AS value, count(*) AS n FROM v_reports GROUP BY 1""", "v_reports"),
    ),
    "q_validity_masks": (
        masks,
        "WITH t AS (SELECT CASE c_custkey % 9 WHEN 0 THEN 'nan'::DOUBLE WHEN 1 THEN 'inf'::DOUBLE WHEN 2 THEN -9999 WHEN 3 THEN -2e6 WHEN 4 THEN 3e20 ELSE c_acctbal END AS v FROM customer), f AS (SELECT v, isfinite(v) AND v <> -9999 AS ok FROM t) SELECT count(*) FILTER (ok) AS n_plain, count(*) FILTER (ok AND v > -1e6) AS n_above, count(*) FILTER (ok AND v > -1e6 AND v < 1e20) AS n_between, count(*) FILTER (NOT (ok AND v >= -1e6 AND v <= 1e20) OR v = 0) AS n_cleaned FROM f",
    ),
    "q_grey_and_scale": (
        lambda s, sf: v_rgb(s, sf).select("scene", fc.grey(c("r"), c("g") / d(1000), c("b")).alias("grey"), fc.scaled(c("r"), 0.5, 1.0, c("valid"), -1.0).alias("v")).groupBy("scene").agg(F.round(F.max("grey").cast("double"), 3).alias("grey"), F.sum(c("v").cast("double")).alias("v")),
        sql("SELECT scene, round(max((r * 0.2989::DOUBLE + g / 1000.0::DOUBLE * 0.5870::DOUBLE + b * 0.1140::DOUBLE)::FLOAT)::DOUBLE, 3) AS grey, sum(CASE WHEN valid THEN r::FLOAT * 0.5::FLOAT + 1.0::FLOAT ELSE -1.0::FLOAT END::DOUBLE) AS v FROM v_rgb GROUP BY 1", "v_rgb"),
    ),
    "q_preview_side": (
        lambda s, sf: table(s, sf, "part").select("p_partkey", fc.preview_side(c("p_size") * 37, c("p_size") * 37, c("p_partkey") + 1, 800).alias("w")),
        "SELECT p_partkey, greatest(1, round_even(p_size * 37 * least(1.0::DOUBLE, 800.0::DOUBLE / greatest(p_size * 37, p_partkey + 1)::DOUBLE), 0))::INT AS w FROM part",
    ),
    "q_stretch_preview": (stretch("truncate", 100), stretch_sql("truncate", 100)),
    "q_stretch_class": (stretch("truncate", 10), stretch_sql("truncate", 10)),
    "q_stretch_round": (stretch("round", 100), stretch_sql("round", 100)),
    "q_stretch_unit": (stretch("unit", 100), stretch_sql("unit", 100)),
    "q_normalised": (
        lambda s, sf: classify.normalised(v_rgb(s, sf), ("r", "g", "b"), (25.0, 30000.0, 50.0), (14.0, 20000.0, 30.0)).groupBy("scene").agg(*[F.round(F.sum(k), 4).alias(k) for k in "rgb"]),
        sql("SELECT scene, " + ", ".join(f"round(sum(CASE WHEN valid THEN ({b} - {m}::DOUBLE) / ({s}::DOUBLE + 1e-6::DOUBLE) ELSE 0 END), 4) AS {b}" for b, m, s in (("r", 25.0, 14.0), ("g", 30000.0, 20000.0), ("b", 50.0, 30.0))) + " FROM v_rgb GROUP BY 1", "v_rgb"),
    ),
    "q_softmax_argmax": (
        lambda s, sf: predictions(s, sf).select("path", "dataset", "scene", "tile_name", "pred_id", "pred_label", *[F.round(f"prob_{k}", 6).alias(f"prob_{k}") for k in classify.CLASSES]),
        sql(f"WITH {PRED_SQL} SELECT path, dataset, scene, tile_name, pred_id, pred_label, {', '.join(f'round(prob_{k}, 6) AS prob_{k}' for k in classify.CLASSES)} FROM preds", "v_preds"),
    ),
    "q_class_summary": (
        lambda s, sf: classify.class_summary(predictions(s, sf)),
        sql(f"WITH {PRED_SQL} SELECT c AS class, count(path) AS count, count(path) / greatest(1, (SELECT count(*) FROM preds))::DOUBLE AS fraction FROM (VALUES ('clear'), ('cloud'), ('shadow'), ('snow')) v(c) LEFT JOIN preds ON pred_label = c GROUP BY 1", "v_preds"),
    ),
    "q_by_dataset": (
        lambda s, sf: classify.counts_by(predictions(s, sf), "dataset"),
        sql(f"WITH {PRED_SQL} SELECT dataset, pred_label, count(*) AS count FROM preds GROUP BY 1, 2", "v_preds"),
    ),
    "q_by_scene": (
        lambda s, sf: classify.counts_by_dataset_and_scene(predictions(s, sf)),
        sql(f"WITH {PRED_SQL} SELECT dataset, scene, pred_label, count(*) AS count FROM preds GROUP BY GROUPING SETS ((dataset, pred_label), (dataset, scene, pred_label))", "v_preds"),
    ),
    "q_head_per_class": (
        lambda s, sf: classify.head_per_class(predictions(s, sf), 5).select("pred_label", "path", "rn"),
        sql(f"WITH {PRED_SQL} SELECT pred_label, path, rn FROM (SELECT *, row_number() OVER (PARTITION BY pred_label ORDER BY ord) AS rn FROM preds) WHERE rn <= 5", "v_preds"),
    ),
}
