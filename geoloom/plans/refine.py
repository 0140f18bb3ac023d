"""Queries over coarse-to-fine matching, with images of 64 pixels a side at most, so that all nine tile states come up."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom.adapters import sql, table, v_matches
from geoloom.functions.columns import c, d
from geoloom.operators import refine

TILE, OVERLAP, LEAST_SIDE, LEAST_VALID, MARGIN = 20, 4, 12, 0.3, 2
LEAST_CONF, CELL, MOST, MOST_PX = 0.9, 4, 2, 6.0


def inputs(spark, sf):
    """images, models, moving and reference masks, tile pairs, and tiles whose worker failed."""
    m = v_matches(spark, sf)
    scenes = m.select("scene").distinct()
    images = scenes.select("scene", (c("scene") * 8 + 8).cast("int").alias("h"), (F.lit(64) - c("scene") * 3).cast("int").alias("w"))
    one, zero = d(1), d(0)
    shift = (c("scene") * 37 % 90 - 40).cast("double") + d(0.25)
    shapes = scenes.select("scene", F.lit("affine").alias("kind"), F.array(one, zero, shift, zero, one, (c("scene") % 3).cast("double"), zero, zero, one).alias("h"))
    lines = table(spark, sf, "lineitem").where("l_returnflag <> 'N'")
    cells = lines.select((c("l_orderkey") % 8).alias("scene"), (c("l_partkey") % 16 * 4).cast("int").alias("r"), (F.floor(c("l_orderkey") / 8) % 16 * 4).cast("int").alias("q")).distinct()
    four = F.sequence(F.lit(0), F.lit(3))
    masks = cells.select("scene", "q", F.explode(F.transform(four, lambda i: c("r") + i)).alias("row")).select("scene", "row", F.explode(F.transform(four, lambda i: c("q") + i)).alias("col"))
    moving = masks.where("not (scene = 5 and col >= 30)")
    reference = masks.where("not (scene in (1, 4, 7) and col < 26)")
    tile = (c("ord") % 12).cast("int")
    some = c("scene") + c("ord") % 12
    local = m.where(some % 6 != 5).select(
        "scene", tile.alias("tile_id"), "ord", (c("x0") % d(20)).alias("x0"), (c("y0") % d(20)).alias("y0"),
        ((c("x0") % d(20)) + d(MARGIN) + F.when(some % 5 == 2, d(9)).otherwise((c("ord") % 7).cast("double"))).alias("x1"), ((c("y0") % d(20)) + (c("ord") % 5).cast("double")).alias("y1"),
        F.when(some % 7 == 4, c("conf") / d(2)).otherwise(c("conf")).alias("conf"),
    )
    errors = scenes.where("scene % 2 = 0").select("scene", F.lit(3).alias("tile_id"), F.concat(F.lit("out of memory in scene "), c("scene").cast("string")).alias("error"))
    return images, shapes, moving, reference, local, errors


def job(spark, sf):
    images, shapes, moving, reference, local, errors = inputs(spark, sf)
    plan = refine.tile_plan(images, shapes, moving, reference, TILE, OVERLAP, LEAST_SIDE, LEAST_VALID, MARGIN)
    return refine.refined(plan, local, errors, LEAST_CONF, 100.0, CELL, MOST, MOST_PX)


def tile_states(spark, sf):
    t, _ = job(spark, sf)
    return t.select("scene", "tile_id", "y0", "y1", "x0", "x1", F.round("mov_valid_frac", 9).alias("mov_valid_frac"), "ry0", "ry1", "rx0", "rx1", F.round("ref_valid_frac", 9).alias("ref_valid_frac"), "n_raw_matches", "n_after_conf", "n_after_spatial", "n_after_prior_gate", F.round("prior_residual_median_px", 6).alias("prior_residual_median_px"), F.round("prior_residual_p90_px", 6).alias("prior_residual_p90_px"), "error", "status")


def refined_pairs(spark, sf):
    """Coarse pairs (a hundredth of the size, so that they lie in the images) and refined ones, merged."""
    _, fine = job(spark, sf)
    coarse = v_matches(spark, sf).select("scene", "ord", *[(c(k) / d(100)).alias(k) for k in ("x0", "y0", "x1", "y1")], "conf")
    out = refine.merged(refine.joined(coarse, fine), 0.5, 0.5)
    return out.select("scene", "ord", *[F.round(k, 6).alias(k) for k in ("x0", "y0", "x1", "y1", "conf")])


def _starts(side: str) -> str:
    return f"list_distinct(list_append(range(0, greatest({side} - {TILE}, 0) + 1, {TILE - OVERLAP}), greatest({side} - {TILE}, 0)))"


TILES_SQL = f"""scenes AS (SELECT DISTINCT scene FROM v_matches),
images AS (SELECT scene, CAST(scene * 8 + 8 AS INT) AS h, CAST(64 - scene * 3 AS INT) AS w, CAST(scene * 37 % 90 - 40 AS DOUBLE) + 0.25::DOUBLE AS dx, CAST(scene % 3 AS DOUBLE) AS dy FROM scenes),
masks AS (SELECT scene, r * 4 + i.i AS "row", q * 4 + j.j AS col FROM (SELECT DISTINCT l_orderkey % 8 AS scene, l_partkey % 16 AS r, l_orderkey // 8 % 16 AS q FROM lineitem WHERE l_returnflag <> 'N'), range(4) i(i), range(4) j(j)),
ty AS (SELECT *, CAST(unnest({_starts("h")}) AS INT) AS y0 FROM images), tx AS (SELECT *, CAST(unnest({_starts("w")}) AS INT) AS x0 FROM ty),
windows AS (SELECT *, CAST(row_number() OVER (PARTITION BY scene ORDER BY y0, x0) - 1 AS INT) AS tile_id, least(y0 + {TILE}, h) AS y1, least(x0 + {TILE}, w) AS x1 FROM tx),
predicted AS (SELECT *, greatest(0, least(CAST(floor(y0 + dy) AS INT) - {MARGIN}, h)) AS ry0, greatest(0, least(CAST(ceil(y1 - 1 + dy) AS INT) + {MARGIN + 1}, h)) AS ry1,
 greatest(0, least(CAST(floor(x0 + dx) AS INT) - {MARGIN}, w)) AS rx0, greatest(0, least(CAST(ceil(x1 - 1 + dx) AS INT) + {MARGIN + 1}, w)) AS rx1 FROM windows),
plan AS (SELECT *, (SELECT count(*) FROM masks m WHERE m.scene = p.scene AND "row" >= y0 AND "row" < y1 AND col >= x0 AND col < x1 AND NOT (m.scene = 5 AND col >= 30)) / ((y1 - y0) * (x1 - x0))::DOUBLE AS mov_valid_frac,
 CASE WHEN (ry1 - ry0) * (rx1 - rx0) > 0 THEN (SELECT count(*) FROM masks m WHERE m.scene = p.scene AND "row" >= ry0 AND "row" < ry1 AND col >= rx0 AND col < rx1 AND NOT (m.scene IN (1, 4, 7) AND col < 26)) / ((ry1 - ry0) * (rx1 - rx0))::DOUBLE END AS ref_valid_frac FROM predicted p),
planned AS (SELECT *, CASE WHEN y1 - y0 < {LEAST_SIDE} OR x1 - x0 < {LEAST_SIDE} THEN 'skip_small' WHEN mov_valid_frac < {LEAST_VALID}::DOUBLE THEN 'skip_low_valid' WHEN ry1 <= ry0 OR rx1 <= rx0 THEN 'skip_empty_pred_window' WHEN coalesce(ref_valid_frac, 0) <= 0 THEN 'skip_empty_ref' END AS early,
 CASE WHEN scene % 2 = 0 AND tile_id = 3 THEN 'out of memory in scene ' || scene END AS failed FROM plan),
local AS (SELECT l.*, p.x0 AS off_x, p.y0 AS off_y, ry0, ry1, rx0, rx1, dx, dy FROM (SELECT scene, CAST(ord % 12 AS INT) AS tile_id, ord, x0 % 20.0::DOUBLE AS lx0, y0 % 20.0::DOUBLE AS ly0,
  (x0 % 20.0::DOUBLE) + {float(MARGIN)}::DOUBLE + CASE WHEN (scene + ord % 12) % 5 = 2 THEN 9.0::DOUBLE ELSE (ord % 7)::DOUBLE END AS lx1, (y0 % 20.0::DOUBLE) + (ord % 5)::DOUBLE AS ly1, CASE WHEN (scene + ord % 12) % 7 = 4 THEN conf / 2.0::DOUBLE ELSE conf END AS conf FROM v_matches WHERE (scene + ord % 12) % 6 <> 5) l
 JOIN planned p ON p.scene = l.scene AND p.tile_id = l.tile_id WHERE early IS NULL AND failed IS NULL),
sure AS (SELECT * FROM (SELECT *, min(conf) OVER (PARTITION BY scene, tile_id) AS low FROM local) WHERE conf::FLOAT >= greatest({LEAST_CONF}::DOUBLE, low)::FLOAT),
thin AS (SELECT *, lx0 + off_x AS gx0, ly0 + off_y AS gy0, lx1 + rx0 AS gx1, ly1 + ry0 AS gy1 FROM (SELECT *, row_number() OVER (PARTITION BY scene, tile_id, floor(lx1 / {CELL}), floor(ly1 / {CELL}) ORDER BY conf DESC, ord) AS n FROM sure WHERE lx1 >= 0 AND lx1 < rx1 - rx0 AND ly1 >= 0 AND ly1 < ry1 - ry0) WHERE n <= {MOST}),
gated AS (SELECT *, sqrt((gx0 + dx - gx1) * (gx0 + dx - gx1) + (gy0 + dy - gy1) * (gy0 + dy - gy1)) AS residual FROM thin)"""
STATES_SQL = f"""WITH {TILES_SQL}, raw_n AS (SELECT scene, tile_id, count(*) AS n FROM local GROUP BY ALL), conf_n AS (SELECT scene, tile_id, count(*) AS n FROM sure GROUP BY ALL),
prior AS (SELECT scene, tile_id, count(*) AS n, count(*) FILTER (residual <= {MOST_PX}) AS n_near, median(residual) AS med, quantile_cont(residual, 0.9) AS p90 FROM gated GROUP BY ALL)
SELECT p.scene, p.tile_id, y0, y1, x0, x1, round(mov_valid_frac, 9) AS mov_valid_frac, ry0, ry1, rx0, rx1, round(ref_valid_frac, 9) AS ref_valid_frac,
 CASE WHEN early IS NULL AND failed IS NULL THEN coalesce(r.n, 0) END AS n_raw_matches, CASE WHEN early IS NULL AND failed IS NULL THEN coalesce(k.n, 0) END AS n_after_conf, CASE WHEN early IS NULL AND failed IS NULL THEN coalesce(q.n, 0) END AS n_after_spatial, CASE WHEN early IS NULL AND failed IS NULL THEN coalesce(n_near, 0) END AS n_after_prior_gate,
 round(med, 6) AS prior_residual_median_px, round(p90, 6) AS prior_residual_p90_px, CASE WHEN early IS NULL THEN failed END AS error,
 coalesce(early, CASE WHEN failed IS NOT NULL THEN 'worker_error' WHEN coalesce(r.n, 0) = 0 THEN 'zero_raw' WHEN coalesce(q.n, 0) = 0 THEN 'rejected_by_tile_filter' WHEN n_near = 0 THEN 'rejected_by_prior_gate' ELSE 'used_refined' END) AS status
FROM planned p LEFT JOIN raw_n r ON r.scene = p.scene AND r.tile_id = p.tile_id LEFT JOIN conf_n k ON k.scene = p.scene AND k.tile_id = p.tile_id LEFT JOIN prior q ON q.scene = p.scene AND q.tile_id = p.tile_id"""
PAIRS_SQL = f"""WITH {TILES_SQL}, b AS (SELECT scene, -1 AS tile_id, ord, x0 / 100.0::DOUBLE AS x0, y0 / 100.0::DOUBLE AS y0, x1 / 100.0::DOUBLE AS x1, y1 / 100.0::DOUBLE AS y1, conf FROM v_matches UNION ALL SELECT scene, tile_id, ord, gx0, gy0, gx1, gy1, conf FROM gated WHERE residual <= {MOST_PX}),
o AS (SELECT * EXCLUDE (ord, tile_id), row_number() OVER (PARTITION BY scene ORDER BY tile_id, ord) - 1 AS ord FROM b)
SELECT scene, ord, round(x0, 6) AS x0, round(y0, 6) AS y0, round(x1, 6) AS x1, round(y1, 6) AS y1, round(conf, 6) AS conf FROM (SELECT *, row_number() OVER (PARTITION BY scene, round_even(x0 / 0.5::DOUBLE, 0), round_even(y0 / 0.5::DOUBLE, 0), round_even(x1 / 0.5::DOUBLE, 0), round_even(y1 / 0.5::DOUBLE, 0) ORDER BY conf DESC, ord) AS n FROM o) WHERE n = 1"""

QUERIES = {
    "q_tile_states": (tile_states, sql(STATES_SQL, "v_matches")),
    "q_tile_counters": (lambda s, sf: refine.tile_counters(job(s, sf)[0]), sql(f"""WITH states AS ({STATES_SQL}) SELECT scene, count(*) AS n_tiles_total, count(*) FILTER (status = 'used_refined') AS n_tiles_used, count(*) FILTER (status = 'skip_small') AS n_tiles_skip_small, count(*) FILTER (status = 'skip_low_valid') AS n_tiles_skip_valid,
 count(*) FILTER (status IN ('skip_empty_pred_window', 'skip_empty_ref')) AS n_tiles_skip_empty_ref, count(*) FILTER (status = 'zero_raw') AS n_tiles_zero_raw, count(*) FILTER (status IN ('worker_error', 'rejected_by_tile_filter')) AS n_tiles_rejected_filter, count(*) FILTER (status = 'rejected_by_prior_gate') AS n_tiles_rejected_prior
 FROM states GROUP BY scene""", "v_matches")),
    "q_refined_pairs": (refined_pairs, sql(PAIRS_SQL, "v_matches")),
}
