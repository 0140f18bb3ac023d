"""Queries over point pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom.adapters import IMAGE, sql, v_matches
from geoloom.functions.columns import c, d, to_byte
from geoloom.operators import models, points

#: A mild projective map that most pairs nearly obey.
H = (1.0001, 0.0002, -0.5, -0.0001, 0.9999, 0.25, 1e-7, -1e-7, 1.0)
H_SQL = {k: f"({H[3 * i]!r}::DOUBLE * x0 + {H[3 * i + 1]!r}::DOUBLE * y0 + {H[3 * i + 2]!r}::DOUBLE)" for i, k in enumerate("xyw")}
RESIDUAL = f"residuals AS (SELECT *, sqrt((px - x1) * (px - x1) + (py - y1) * (py - y1)) AS residual FROM (SELECT *, {H_SQL['x']} / {H_SQL['w']} AS px, {H_SQL['y']} / {H_SQL['w']} AS py FROM v_matches))"
INSIDE = f"x1 >= 0 AND x1 < {IMAGE} AND y1 >= 0 AND y1 < {IMAGE}"


def residual(spark, sf):
    return v_matches(spark, sf).withColumn("residual", points.homography_residual(H))


def candidates(spark, sf):
    """Eight candidates a group of scenes, with inliers by distance from the model."""
    r = residual(spark, sf).groupBy("scene").agg(F.count_if(c("residual") <= 3.0).alias("inliers"))
    return r.select(F.floor(c("scene") / 4).alias("scene"), (c("scene") % 4).alias("ord"), "inliers", (c("inliers") >= 12).alias("viable"))


def cv_folds(spark, sf):
    b = points.fold_blocks(v_matches(spark, sf), 512, IMAGE, IMAGE)
    return b.join(points.folds(b, 5), ["scene", "bx", "by"], "left").select("scene", "bx", "by", "n", "fold")


def laddered(spark, sf):
    """Pairs as robust models get them: the most confident 60 % of a scene, 0.2 at least, and of those eight in a cell of 128 pixels."""
    return points.spatial_thin(points.confidence_gate(v_matches(spark, sf), 0.2, 60.0), 128, 8, IMAGE, IMAGE)


def tile_statuses(spark, sf):
    m = v_matches(spark, sf).select("ord", (c("ord") % 1200 + 1).alias("h"), (c("ord") * 7 % 1200 + 1).alias("w"), (c("ord") * 31 % 100 / d(100)).alias("valid"), F.lit(0).alias("x0"), (c("ord") % 5).alias("x1"), F.lit(0).alias("y0"), (c("ord") % 7).alias("y1"), (c("ord") * 13 % 10 / d(10)).alias("ref_valid"))
    return points.tile_status(m, 64, 0.2).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


#: Blocks one after another, the largest first, each to the fold with the least so far.
CV_SQL = sql(
    f"""WITH b AS (SELECT scene, least(greatest(floor(x1 / 512), 0), {(IMAGE - 1) // 512})::BIGINT AS bx, least(greatest(floor(y1 / 512), 0), {(IMAGE - 1) // 512})::BIGINT AS "by", count(*) AS n FROM v_matches GROUP BY ALL),
o AS (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY n DESC, bx, "by") AS k, count(*) OVER (PARTITION BY scene) AS blocks FROM b),
walk AS (SELECT DISTINCT scene, 0::BIGINT AS k, CAST([0 for i in range(least(5, blocks))] AS BIGINT[]) AS loads, NULL::INT AS fold FROM o WHERE blocks >= 2
 UNION ALL SELECT scene, k, [CASE WHEN i = f THEN loads[i] + n ELSE loads[i] END for i in range(1, len(loads) + 1)], CAST(f - 1 AS INT) FROM (SELECT w.scene, o.k, w.loads, o.n, list_position(w.loads, list_min(w.loads)) AS f FROM walk w JOIN o ON o.scene = w.scene AND o.k = w.k + 1))
SELECT o.scene, bx, "by", n, fold FROM o LEFT JOIN walk ON walk.scene = o.scene AND walk.k = o.k""",
    "v_matches",
).replace("WITH ", "WITH RECURSIVE ", 1)

QUERIES = {
    "q_raw_valid": (
        lambda s, sf: points.raw_valid(v_matches(s, sf), (IMAGE, IMAGE), (IMAGE, IMAGE)).groupBy("scene").agg(F.count(F.lit(1)).alias("n"), F.sum("ord").alias("ords")),
        sql(f"SELECT scene, count(*) AS n, sum(ord)::BIGINT AS ords FROM v_matches WHERE x0 >= 0 AND x0 < {IMAGE} AND y0 >= 0 AND y0 < {IMAGE} AND {INSIDE} GROUP BY 1", "v_matches"),
    ),
    "q_spatial_thin": (
        lambda s, sf: points.spatial_thin(v_matches(s, sf), 64, 2, IMAGE, IMAGE).select("scene", "ord", "x1", "y1", "conf"),
        sql(f"SELECT scene, ord, x1, y1, conf FROM (SELECT *, row_number() OVER (PARTITION BY scene, floor(x1 / 64), floor(y1 / 64) ORDER BY conf DESC, ord) AS rn FROM v_matches WHERE {INSIDE}) WHERE rn <= 2", "v_matches"),
    ),
    "q_conf_gate": (
        lambda s, sf: points.confidence_gate(v_matches(s, sf), 0.2, 60.0).select("scene", "ord", "conf"),
        sql("WITH cuts AS (SELECT scene, greatest(0.2::DOUBLE, quantile_cont(conf, 0.4))::FLOAT AS cut FROM v_matches GROUP BY 1) SELECT scene, ord, conf FROM v_matches JOIN cuts USING (scene) WHERE conf::FLOAT >= cut", "v_matches"),
    ),
    "q_dedup_pairs": (
        lambda s, sf: points.without_copies(v_matches(s, sf), ("x0", "y0", "x1", "y1"), 64).select("scene", "ord", "first_ord", "conf"),
        sql("SELECT scene, ord, first_ord, conf FROM (SELECT *, row_number() OVER (k ORDER BY conf DESC, ord) AS rn, min(ord) OVER k AS first_ord FROM v_matches WINDOW k AS (PARTITION BY scene, round_even(x0 / 64, 0), round_even(y0 / 64, 0), round_even(x1 / 64, 0), round_even(y1 / 64, 0))) WHERE rn = 1", "v_matches"),
    ),
    "q_dedup_moving": (
        lambda s, sf: points.without_copies(v_matches(s, sf), ("x0", "y0"), 64).select("scene", "ord", "first_ord", "conf"),
        sql("SELECT scene, ord, first_ord, conf FROM (SELECT *, row_number() OVER (k ORDER BY conf DESC, ord) AS rn, min(ord) OVER k AS first_ord FROM v_matches WINDOW k AS (PARTITION BY scene, round_even(x0 / 64, 0), round_even(y0 / 64, 0))) WHERE rn = 1", "v_matches"),
    ),
    "q_merge_stats": (
        lambda s, sf: points.merge_stats(v_matches(s, sf), 64),
        sql("SELECT scene, sum(n)::BIGINT AS n_input, count(*) AS n_merged, sum(n)::BIGINT - count(*) AS n_removed FROM (SELECT scene, count(*) AS n FROM v_matches GROUP BY scene, round_even(x0 / 64, 0), round_even(y0 / 64, 0), round_even(x1 / 64, 0), round_even(y1 / 64, 0)) GROUP BY 1", "v_matches"),
    ),
    "q_filter_ladder": (
        lambda s, sf: points.filter_ladder(v_matches(s, sf), 64, 1, IMAGE, 0.3, 50.0, 64, 850),
        sql(
            f"""WITH cuts AS (SELECT scene, greatest(0.3::DOUBLE, quantile_cont(conf, 0.5))::FLOAT AS cut FROM v_matches GROUP BY 1),
gated AS (SELECT m.* FROM v_matches m JOIN cuts USING (scene) WHERE conf::FLOAT >= cut),
thin AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scene, floor(x1 / 64), floor(y1 / 64) ORDER BY conf DESC, ord) AS rn FROM gated WHERE {INSIDE}) WHERE rn <= 1),
n AS (SELECT scene, (SELECT count(*) FROM v_matches m WHERE m.scene = s.scene) AS n_raw, (SELECT count(*) FROM gated g WHERE g.scene = s.scene) AS n_conf,
 (SELECT count(*) FROM (SELECT DISTINCT round_even(x0 / 64, 0), round_even(y0 / 64, 0) FROM thin t WHERE t.scene = s.scene)) AS n_spatial FROM (SELECT DISTINCT scene FROM v_matches) s)
SELECT scene, n_raw, n_conf, n_spatial, CASE WHEN n_raw < 850 THEN 'too_few_matches_raw(' || n_raw || ')' WHEN n_conf < 850 THEN 'too_few_matches_after_conf(' || n_conf || ')' WHEN n_spatial < 850 THEN 'too_few_matches_after_spatial(' || n_spatial || ')' END AS reason FROM n""",
            "v_matches",
        ),
    ),
    "q_gcp_round_robin": (
        lambda s, sf: points.balanced(v_matches(s, sf), IMAGE, IMAGE, 16, 300).select("scene", "ord", "place"),
        sql(
            f"""WITH n AS (SELECT *, count(*) OVER (PARTITION BY scene) AS n, least(15, floor(x1 / 250.0::DOUBLE)) AS cx, least(15, floor(y1 / 250.0::DOUBLE)) AS cy FROM v_matches),
r AS (SELECT *, row_number() OVER (PARTITION BY scene, cy, cx ORDER BY conf DESC, ord) AS round FROM n WHERE n <= 300 OR ({INSIDE})),
p AS (SELECT *, CASE WHEN n <= 300 THEN row_number() OVER (PARTITION BY scene ORDER BY ord) ELSE row_number() OVER (PARTITION BY scene ORDER BY round, cy, cx) END AS place FROM r)
SELECT scene, ord, place FROM p WHERE n <= 300 OR place <= 300""",
            "v_matches",
        ),
    ),
    "q_best_candidate": (
        lambda s, sf: points.best_candidate(candidates(s, sf)).select("scene", "ord", "inliers"),
        sql(f"WITH {RESIDUAL}, t AS (SELECT scene // 4 AS scene, scene % 4 AS ord, count(*) FILTER (residual <= 3.0) AS inliers FROM residuals GROUP BY residuals.scene) SELECT scene, ord, inliers FROM (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY inliers DESC, ord) AS rn FROM t WHERE inliers >= 12) WHERE rn = 1", "v_matches"),
    ),
    "q_coverage_ratio": (
        lambda s, sf: points.coverage_ratio(v_matches(s, sf), 64, IMAGE, IMAGE),
        sql(f"SELECT scene, count(DISTINCT (floor(x1 / 64), floor(y1 / 64))) / {float((-(-IMAGE // 64)) ** 2)}::DOUBLE AS coverage FROM v_matches WHERE {INSIDE} GROUP BY 1", "v_matches"),
    ),
    "q_homography_residual": (
        lambda s, sf: residual(s, sf).select("scene", "ord", F.round("residual", 6).alias("residual")),
        sql(f"WITH {RESIDUAL} SELECT scene, ord, round(residual, 6) AS residual FROM residuals", "v_matches"),
    ),
    "q_prior_gate": (
        lambda s, sf: points.prior_gate(v_matches(s, sf), H, 1.5).select("scene", "n", "n_after_prior_gate", F.round("median_px", 6).alias("median_px"), F.round("p90_px", 6).alias("p90_px"), points.bad_geometry(c("median_px"), c("p90_px"), 1.5, 2.4).alias("bad")),
        sql(f"WITH {RESIDUAL}, g AS (SELECT scene, count(*) AS n, count(*) FILTER (residual <= 1.5) AS n_after_prior_gate, median(residual) AS m, quantile_cont(residual, 0.9) AS p FROM residuals GROUP BY 1) SELECT scene, n, n_after_prior_gate, round(m, 6) AS median_px, round(p, 6) AS p90_px, m > 1.5 OR p > 2.4 AS bad FROM g", "v_matches"),
    ),
    "q_mad_threshold": (
        lambda s, sf: points.robust_threshold(residual(s, sf), "residual", 1.0, 3.0).select("scene", *[F.round(x, 6).alias(x) for x in ("median", "mad", "threshold")]),
        sql(f"WITH {RESIDUAL}, m AS (SELECT scene, median(residual) AS med FROM residuals GROUP BY 1), a AS (SELECT scene, med, median(abs(residual - med)) AS mad FROM residuals JOIN m USING (scene) GROUP BY 1, 2) SELECT scene, round(med, 6) AS median, round(mad, 6) AS mad, round(greatest(1.0::DOUBLE, med + 3.0::DOUBLE * 1.4826::DOUBLE * mad), 6) AS threshold FROM a", "v_matches"),
    ),
    "q_worst_removal": (
        lambda s, sf: points.worst_removed(residual(s, sf).withColumn("residual", F.round("residual", 6)), "residual", 2.0, 0.05).select("scene", "ord", "residual"),
        sql(f"WITH {RESIDUAL}, n AS (SELECT scene, ord, round(residual, 6) AS residual, count(*) OVER (PARTITION BY scene) AS n FROM residuals) SELECT scene, ord, residual FROM (SELECT *, row_number() OVER (PARTITION BY scene ORDER BY residual DESC, ord) AS rn FROM n WHERE residual > 2.0) WHERE rn <= greatest(1, floor(n * 0.05::DOUBLE))", "v_matches"),
    ),
    "q_fold_blocks": (
        lambda s, sf: points.fold_blocks(v_matches(s, sf), 512, IMAGE, IMAGE),
        sql(f"SELECT scene, least(greatest(floor(x1 / 512), 0), {(IMAGE - 1) // 512})::BIGINT AS bx, least(greatest(floor(y1 / 512), 0), {(IMAGE - 1) // 512})::BIGINT AS \"by\", count(*) AS n FROM v_matches GROUP BY 1, 2, 3", "v_matches"),
    ),
    "q_cv_folds": (cv_folds, CV_SQL),
    "q_tile_status": (
        tile_statuses,
        sql("SELECT CASE WHEN ord % 1200 + 1 < 64 OR ord * 7 % 1200 + 1 < 64 THEN 'skip_small' WHEN (ord * 31 % 100) / 100.0::DOUBLE < 0.2 THEN 'skip_low_valid' WHEN ord % 5 <= 0 OR ord % 7 <= 0 THEN 'skip_empty_pred_window' WHEN ord * 13 % 10 <= 0 THEN 'skip_empty_ref' ELSE 'eligible' END AS status, count(*) AS n FROM v_matches GROUP BY 1", "v_matches"),
    ),
    "q_confidence_bytes": (
        lambda s, sf: v_matches(s, sf).select(to_byte(c("conf"), c("ord") % 10 != 0).alias("byte")).groupBy("byte").agg(F.count(F.lit(1)).alias("n")),
        sql("SELECT CASE WHEN ord % 10 <> 0 THEN least(greatest(round_even(conf * 255.0::DOUBLE, 0), 0), 255)::INT ELSE 0 END AS byte, count(*) AS n FROM v_matches GROUP BY 1", "v_matches"),
    ),
    "q_ransac_homography": (lambda s, sf: models.ransac_filter(laddered(s, sf), px=2.5), None),
    "q_ransac_affine": (lambda s, sf: models.ransac_filter(laddered(s, sf), "affine", px=2.5), None),
    "q_tps_filter": (lambda s, sf: models.spline_filter(laddered(s, sf), IMAGE, IMAGE), None),
}
