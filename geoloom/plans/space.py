"""Queries over blocks, tiles, boxes and coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom.adapters import sql, table, v_config, v_matches, v_pixels, v_scenes
from geoloom.functions import columns as fc
from geoloom.functions.columns import c, d
from geoloom.operators import coverage, grid, models, points, raster

STEP, MARGIN = 20000.0, 2048.0
SIDE, TILE, SCAN, DATES, SHARE = 64, 16, 4, 8, 0.75
TEMPLATE = {"a": 10.0, "b": 0.5, "c": 300000.0, "d": -0.5, "e": -10.0, "f": 4600000.0}
BAND = {"a": 2.0, "b": 0.0, "c": 299900.0, "d": 0.0, "e": -2.0, "f": 4600100.0}
SOURCE, TARGET = {"a": 10.0, "b": 0.0, "c": 0.0, "d": 0.0, "e": -10.0, "f": 640.0}, {"a": 7.0, "b": 1.0, "c": 20.0, "d": -1.0, "e": -7.0, "f": 600.0}

BLOCKS_SQL = f"""b AS (SELECT floor(min(minx) / {STEP}) * {STEP}::DOUBLE AS minx, floor(min(miny) / {STEP}) * {STEP}::DOUBLE AS miny, ceil(max(maxx) / {STEP}) * {STEP}::DOUBLE AS maxx, ceil(max(maxy) / {STEP}) * {STEP}::DOUBLE AS maxy FROM v_scenes),
ix AS (SELECT *, CAST((maxx - minx) / {STEP} AS INT) AS nx FROM b),
blocks AS (SELECT 'BLK_' || lpad(CAST(r.i * nx + q.i + 1 AS VARCHAR), 6, '0') AS block_id, minx + q.i * {STEP}::DOUBLE AS core_minx, miny + r.i * {STEP}::DOUBLE AS core_miny FROM ix, range(1000) q(i), range(1000) r(i) WHERE q.i < nx AND r.i < CAST((maxy - miny) / {STEP} AS INT))"""
PAIRS_SQL = f"{BLOCKS_SQL}, pairs AS (SELECT block_id, scene_id, acq_day FROM blocks JOIN v_scenes ON minx <= core_minx + {STEP + MARGIN} AND maxx >= core_minx - {MARGIN} AND miny <= core_miny + {STEP + MARGIN} AND maxy >= core_miny - {MARGIN})"
COUNT_SQL = f"""counts AS (SELECT g.r AS "row", h.c AS col, (SELECT 0) + coalesce(n, 0) AS date_count FROM range({SIDE}) g(r) CROSS JOIN range({SIDE}) h(c)
 LEFT JOIN (SELECT "row" AS pr, col AS pc, count(DISTINCT acq_day) AS n FROM v_pixels WHERE valid GROUP BY 1, 2) p ON pr = g.r AND pc = h.c)"""
WINDOW_SQL = f"""{COUNT_SQL}, stats AS (SELECT y.i AS "row", x.i AS col, count(*) FILTER (date_count >= {DATES}) / {float(TILE * TILE)}::DOUBLE AS repeated_fraction,
 coalesce(sum(date_count) FILTER (date_count >= {DATES})::DOUBLE / nullif(count(*) FILTER (date_count >= {DATES}), 0)::DOUBLE, 0.0::DOUBLE) AS mean_date_count, max(date_count) AS max_date_count
 FROM range(0, {SIDE - TILE + 1}, {SCAN}) y(i) CROSS JOIN range(0, {SIDE - TILE + 1}, {SCAN}) x(i) JOIN counts ON counts."row" >= y.i AND counts."row" < y.i + {TILE} AND col >= x.i AND col < x.i + {TILE} GROUP BY 1, 2)"""
TILES_SQL = "tiles AS (SELECT tile_id, y, x FROM (VALUES (1, 0, 0), (2, 5, 30), (3, 40, 12), (4, 48, 48)) t(tile_id, y, x))"
OFFSETS_SQL = "(VALUES " + ", ".join(f"('{k}', {float(x)}::DOUBLE, {float(y)}::DOUBLE)" for k, (x, y) in fc.OFFSETS.items()) + ") o(direction, dx, dy)"
CROPS_SQL = f"""listed AS (SELECT scene, overlap, west, south, list_distinct_ordered AS dirs FROM (SELECT *, list_prepend('C', list_filter(list_transform(directions, lambda x: upper(x)), lambda x, i: list_position(list_transform(directions, lambda z: upper(z)), x) = i)) AS list_distinct_ordered FROM v_config)),
e AS (SELECT scene, overlap, west, south, unnest(dirs) AS direction, unnest(range(len(dirs))) AS pos FROM listed),
crops AS (SELECT scene, pos, e.direction, west + dx * (0.5::DOUBLE * (1.0::DOUBLE - overlap)) AS west, south + dy * (0.5::DOUBLE * (1.0::DOUBLE - overlap)) AS south FROM e JOIN {OFFSETS_SQL} ON o.direction = e.direction)"""


def counts(spark, sf):
    return coverage.date_count(v_pixels(spark, sf), coverage.dense_grid(spark, SIDE, SIDE))


def stats(spark, sf):
    return coverage.windows(counts(spark, sf), SIDE, SIDE, TILE, SCAN, DATES)


def nonoverlap(spark, sf):
    """Repeatedly covered windows that do not overlap, with their place in the order they were taken; tiles are numbered in q_block_tiles, after those with too few days are gone."""
    found = coverage.candidates(stats(spark, sf), SHARE).withColumn("block_id", F.lit("BLK_000001"))
    return coverage.nonoverlapping(found, TILE)


def tiles(spark):
    return spark.createDataFrame([(1, 0, 0), (2, 5, 30), (3, 40, 12), (4, 48, 48)], "tile_id int, row int, col int")


def tile_days(spark, sf):
    return coverage.tile_days(v_pixels(spark, sf), tiles(spark), TILE, 0.004, 3)


def images(spark, sf):
    return table(spark, sf, "customer").select(c("c_custkey").alias("scene"), (c("c_custkey") * 7 % 3000 + 1).cast("int").alias("h"), (c("c_custkey") * 13 % 2500 + 1).cast("int").alias("w"))


def boxes(spark, sf):
    b = v_config(spark, sf)
    return b.select("scene", c("west").alias("west"), F.abs("south").alias("south"), (c("west") + d(0.5)).alias("east"), (F.abs("south") + d(0.25)).alias("north"))


def blocks(spark, sf):
    return grid.blocks(v_scenes(spark, sf), STEP, MARGIN)


def pairs(spark, sf):
    return grid.block_scenes(blocks(spark, sf), v_scenes(spark, sf), STEP, MARGIN)


def affine_roundtrip(spark, sf):
    t = {k: d(v) for k, v in TEMPLATE.items()}
    m = v_matches(spark, sf)
    x, y = fc.apply_affine(t, c("x0"), c("y0"))
    bx, by = fc.invert_affine(t, x, y)
    return m.select("scene", "ord", F.round(x, 4).alias("mx"), F.round(y, 4).alias("my"), (F.abs(bx - c("x0")) + F.abs(by - c("y0")) < 1e-6).alias("same"))


def source_values(spark, sf):
    return v_pixels(spark, sf).groupBy("row", "col").agg(F.max("value").alias("value"))


def tps_warp(spark, sf):
    """Source places of a coarse grid by each scene's spline through its balanced control points."""
    g = points.balanced(v_matches(spark, sf), 4000, 4000, 16, 1200)
    own = grid.control_points(g, TEMPLATE, BAND)
    ids = v_matches(spark, sf).select("scene").distinct().withColumn("id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long"))))
    at = ids.select("scene", "id", (d(300000) + (c("id") % 8) * 5000.0).alias("mx"), (d(4600000) - F.floor(c("id") / 8) * 5000.0).alias("my"))
    return models.spline_warp(own, at, 40000.0, 1e-6)


NEAREST = "(SELECT \"row\" AS tr, col AS tc, (-10.0::DOUBLE * (mx - 0.0) - 0.0 * (my - 640.0)) / -100.0::DOUBLE AS sx, (10.0::DOUBLE * (my - 640.0) - 0.0 * mx) / -100.0::DOUBLE AS sy FROM (SELECT g.r AS \"row\", h.c AS col, 7.0::DOUBLE * (h.c + 0.5::DOUBLE) + 1.0::DOUBLE * (g.r + 0.5::DOUBLE) + 20.0::DOUBLE AS mx, -1.0::DOUBLE * (h.c + 0.5::DOUBLE) + -7.0::DOUBLE * (g.r + 0.5::DOUBLE) + 600.0::DOUBLE AS my FROM range(64) g(r), range(64) h(c)))"

QUERIES = {
    "q_blocks": (
        lambda s, sf: blocks(s, sf).select("block_id", "core_minx", "core_miny", "core_maxx", "core_maxy", "expanded_minx", "expanded_maxy"),
        sql(f"WITH {BLOCKS_SQL} SELECT block_id, core_minx, core_miny, core_minx + {STEP}::DOUBLE AS core_maxx, core_miny + {STEP}::DOUBLE AS core_maxy, core_minx - {MARGIN}::DOUBLE AS expanded_minx, core_miny + {STEP}::DOUBLE + {MARGIN}::DOUBLE AS expanded_maxy FROM blocks", "v_scenes"),
    ),
    "q_block_scenes": (pairs, sql(f"WITH {PAIRS_SQL} SELECT * FROM pairs", "v_scenes")),
    "q_block_gate": (
        lambda s, sf: grid.block_gate(pairs(s, sf), 5),
        sql(f"WITH {PAIRS_SQL} SELECT block_id, count(*) AS n_scenes, count(DISTINCT acq_day) AS n_dates FROM pairs GROUP BY 1 HAVING count(DISTINCT acq_day) >= 5", "v_scenes"),
    ),
    "q_date_count": (counts, sql(f"WITH {COUNT_SQL} SELECT * FROM counts", "v_pixels")),
    "q_repeated_mask": (
        lambda s, sf: coverage.repeated(counts(s, sf), DATES).groupBy("repeated").agg(F.count(F.lit(1)).alias("n")),
        sql(f"WITH {COUNT_SQL} SELECT date_count >= {DATES} AS repeated, count(*) AS n FROM counts GROUP BY 1", "v_pixels"),
    ),
    "q_candidates": (
        lambda s, sf: coverage.candidates(stats(s, sf), SHARE).select("row", "col", "repeated_fraction", F.round("mean_date_count", 6).alias("mean_date_count"), "max_date_count"),
        sql(f'WITH {WINDOW_SQL} SELECT "row", col, repeated_fraction, round(mean_date_count, 6) AS mean_date_count, max_date_count FROM stats WHERE repeated_fraction >= {SHARE}', "v_pixels"),
    ),
    "q_candidates_in_core": (
        lambda s, sf: (lambda b: stats(s, sf).where((c("repeated_fraction") >= SHARE / 2) & grid.inside(b, d(40), d(-600), d(600), d(-40))).select("row", "col", "repeated_fraction", F.round("mean_date_count", 6).alias("mean_date_count"), "max_date_count", *[v.alias(k) for k, v in b.items()]))(grid.candidate_bounds(d(0), d(0), c("row"), c("col"), TILE, 10.0)),
        sql(f'WITH {WINDOW_SQL} SELECT "row", col, repeated_fraction, round(mean_date_count, 6) AS mean_date_count, max_date_count, 0.0::DOUBLE + col * 10.0::DOUBLE AS west, 0.0::DOUBLE - "row" * 10.0::DOUBLE - 160.0::DOUBLE AS south, 0.0::DOUBLE + col * 10.0::DOUBLE + 160.0::DOUBLE AS east, 0.0::DOUBLE - "row" * 10.0::DOUBLE AS north FROM stats WHERE repeated_fraction >= {SHARE / 2} AND col * 10 >= 40 AND -"row" * 10 - 160 >= -600 AND col * 10 + 160 <= 600 AND -"row" * 10 <= -40', "v_pixels"),
    ),
    "q_nonoverlap": (
        nonoverlap,
        sql(
            f"""WITH RECURSIVE {WINDOW_SQL}, c AS (SELECT *, row_number() OVER (ORDER BY repeated_fraction DESC, mean_date_count DESC, max_date_count DESC, "row", col) AS n FROM stats WHERE repeated_fraction >= {SHARE}),
walk AS (SELECT 0::BIGINT AS n, CAST([] AS BIGINT[]) AS taken, false AS ok UNION ALL
 SELECT c.n, CASE WHEN free THEN list_append(taken, c.n) ELSE taken END, free FROM (SELECT c.*, w.taken, NOT EXISTS (SELECT 1 FROM c o WHERE list_contains(w.taken, o.n) AND abs(o."row" - c."row") < {TILE} AND abs(o.col - c.col) < {TILE}) AS free FROM walk w JOIN c ON c.n = w.n + 1) c)
SELECT 'BLK_000001' AS block_id, "row", col, repeated_fraction, mean_date_count, max_date_count, row_number() OVER (ORDER BY n) AS place FROM c SEMI JOIN (SELECT n FROM walk WHERE ok) t USING (n)""".replace("WITH RECURSIVE ", "WITH "),
            "v_pixels",
        ).replace("WITH ", "WITH RECURSIVE ", 1),
    ),
    "q_tile_days": (
        lambda s, sf: tile_days(s, sf).select("tile_id", "acq_day", "valid_fraction"),
        sql(f"WITH {TILES_SQL}, days AS (SELECT tile_id, acq_day, count(*) / 256.0::DOUBLE AS valid_fraction FROM (SELECT DISTINCT \"row\", col, acq_day FROM v_pixels WHERE valid) p JOIN tiles ON \"row\" >= y AND \"row\" < y + 16 AND col >= x AND col < x + 16 GROUP BY 1, 2 HAVING count(*) / 256.0::DOUBLE >= 0.004) SELECT tile_id, acq_day, valid_fraction FROM (SELECT *, count(*) OVER (PARTITION BY tile_id) AS n FROM days) WHERE n >= 3", "v_pixels"),
    ),
    "q_tile_table": (
        lambda s, sf: coverage.tile_table(tile_days(s, sf).where(c("acq_day") < "19960101")),
        sql(f"WITH {TILES_SQL}, days AS (SELECT tile_id, acq_day FROM (SELECT DISTINCT \"row\", col, acq_day FROM v_pixels WHERE valid) p JOIN tiles ON \"row\" >= y AND \"row\" < y + 16 AND col >= x AND col < x + 16 GROUP BY 1, 2 HAVING count(*) / 256.0::DOUBLE >= 0.004), many AS (SELECT tile_id FROM days GROUP BY 1 HAVING count(*) >= 3) SELECT tile_id, count(*) AS distinct_date_count, string_agg(acq_day, ' | ' ORDER BY acq_day) AS dates FROM days SEMI JOIN many USING (tile_id) WHERE acq_day < '19960101' GROUP BY 1", "v_pixels"),
    ),
    "q_mosaic": (
        lambda s, sf: coverage.mosaic(v_pixels(s, sf)),
        sql('SELECT "row", col, acq_day, (min(struct_pack(s := scene_ord, v := value)) FILTER (valid)).v AS value, bool_or(valid) AS valid, count(DISTINCT scene_ord) FILTER (valid) AS n_scenes FROM v_pixels GROUP BY 1, 2, 3', "v_pixels"),
    ),
    "q_best_mosaic": (
        lambda s, sf: raster.best_mosaic(v_pixels(s, sf).select("row", "col", (c("value") * 100).alias("value"), (c("scene_ord") * 13 % 100).alias("cloud"), F.concat("acq_day", c("value").cast("string")).alias("ord")), 60),
        sql("SELECT \"row\", col, coalesce((min(struct_pack(a := scene_ord * 13 % 100, b := acq_day || CAST(value AS VARCHAR), v := trunc(least(greatest(value * 100 * 6.5535::DOUBLE, 1), 65535))::INT)) FILTER (scene_ord * 13 % 100 < 60)).v, 0) AS value FROM v_pixels GROUP BY 1, 2", "v_pixels"),
    ),
    "q_tile_validity": (
        lambda s, sf: coverage.tile_validity(v_pixels(s, sf), 10, SIDE, SIDE, 0.3),
        sql("WITH p AS (SELECT scene_ord, \"row\", col, bool_and(valid) AS ok FROM v_pixels GROUP BY 1, 2, 3), t AS (SELECT scene_ord, \"row\" // 10 AS tr, col // 10 AS tc, count(*) FILTER (ok) AS n FROM p GROUP BY 1, 2, 3), u AS (SELECT *, least(10, 64 - tr * 10) AS h, least(10, 64 - tc * 10) AS w FROM t) SELECT scene_ord, count(*) AS raw_tiles, count(*) FILTER (h = 10 AND w = 10 AND n / (h * w)::DOUBLE >= 0.3) AS valid_tiles, count(*) FILTER (h < 10 OR w < 10) AS rejected_shape, count(*) FILTER (h = 10 AND w = 10 AND n / (h * w)::DOUBLE < 0.3) AS rejected_valid_ratio FROM u GROUP BY 1", "v_pixels"),
    ),
    "q_axis_tiles": (
        lambda s, sf: grid.tiles(images(s, sf), 1120, 64).select("scene", "y0", "y1", "x0", "x1"),
        "WITH i AS (SELECT c_custkey AS scene, CAST(c_custkey * 7 % 3000 + 1 AS INT) AS h, CAST(c_custkey * 13 % 2500 + 1 AS INT) AS w FROM customer), y AS (SELECT *, unnest(list_distinct(list_append(range(0, greatest(h - 1120, 0) + 1, 1056), greatest(h - 1120, 0)))) AS y0 FROM i), x AS (SELECT *, unnest(list_distinct(list_append(range(0, greatest(w - 1120, 0) + 1, 1056), greatest(w - 1120, 0)))) AS x0 FROM y) SELECT scene, y0, least(y0 + 1120, h) AS y1, x0, least(x0 + 1120, w) AS x1 FROM x",
    ),
    "q_ragged_tiles": (
        lambda s, sf: grid.ragged_tiles(images(s, sf), 512, 128).groupBy("scene").agg(F.count(F.lit(1)).alias("n"), F.count_if("full").alias("n_full")),
        "WITH i AS (SELECT c_custkey AS scene, CAST(c_custkey * 7 % 3000 + 1 AS INT) AS h, CAST(c_custkey * 13 % 2500 + 1 AS INT) AS w FROM customer) SELECT scene, count(*) AS n, count(*) FILTER (h - y.i >= 512 AND w - x.i >= 512) AS n_full FROM i JOIN range(0, 3000, 384) y(i) ON y.i < h JOIN range(0, 3000, 384) x(i) ON x.i < w GROUP BY 1",
    ),
    "q_context_windows": (
        lambda s, sf: images(s, sf).select("scene", *[v.alias(k) for k, v in zip(("y0", "y1", "x0", "x1"), grid.context_window(c("h") - 100, c("h") + 50, F.lit(20), F.lit(900), c("h"), c("w"), 64), strict=True)]),
        "SELECT c_custkey AS scene, greatest(0, least(h - 164, h)) AS y0, greatest(0, least(h + 114, h)) AS y1, greatest(0, least(-44, w)) AS x0, greatest(0, least(964, w)) AS x1 FROM (SELECT c_custkey, CAST(c_custkey * 7 % 3000 + 1 AS INT) AS h, CAST(c_custkey * 13 % 2500 + 1 AS INT) AS w FROM customer)",
    ),
    "q_raster_shape": (
        lambda s, sf: v_scenes(s, sf).select("scene_id", *[v.alias(k) for k, v in zip(("height", "width"), grid.raster_shape(c("minx"), c("miny"), c("maxx") + c("ord") % 7, c("maxy"), 2.0), strict=True)]),
        sql("SELECT scene_id, round_even((maxy - miny) / 2.0::DOUBLE, 0)::INT AS height, round_even((maxx + ord % 7 - minx) / 2.0::DOUBLE, 0)::INT AS width FROM v_scenes", "v_scenes"),
    ),
    "q_directions": (
        lambda s, sf: v_config(s, sf).select("scene", F.array_join(grid.directions(c("directions")), ",").alias("directions")),
        sql(f"WITH {CROPS_SQL} SELECT scene, array_to_string(dirs, ',') AS directions FROM listed", "v_config"),
    ),
    "q_crop_bounds": (
        lambda s, sf: grid.shifted_crops(v_config(s, sf), 0.5),
        sql(f"WITH {CROPS_SQL} SELECT scene, pos, direction, west, south, west + 0.5::DOUBLE AS east, south + 0.5::DOUBLE AS north FROM crops", "v_config"),
    ),
    "q_download_bbox": (
        lambda s, sf: grid.download_box(v_config(s, sf), 0.5, 0.02),
        sql(f"WITH {CROPS_SQL} SELECT scene, min(west) - 0.02::DOUBLE AS west, min(south) - 0.02::DOUBLE AS south, max(west + 0.5::DOUBLE) + 0.02::DOUBLE AS east, max(south + 0.5::DOUBLE) + 0.02::DOUBLE AS north FROM crops GROUP BY 1", "v_config"),
    ),
    "q_affine_roundtrip": (
        affine_roundtrip,
        sql("SELECT scene, ord, round(10.0::DOUBLE * x0 + 0.5::DOUBLE * y0 + 300000.0::DOUBLE, 4) AS mx, round(-0.5::DOUBLE * x0 + -10.0::DOUBLE * y0 + 4600000.0::DOUBLE, 4) AS my, true AS same FROM v_matches", "v_matches"),
    ),
    "q_control_points": (
        lambda s, sf: grid.control_points(v_matches(s, sf), TEMPLATE, BAND).select("scene", "ord", *[F.round(k, 4).alias(k) for k in ("sx", "sy", "mx", "my")]),
        sql("WITH m AS (SELECT *, 10.0::DOUBLE * x0 + 0.5::DOUBLE * y0 + 300000.0::DOUBLE AS ax, -0.5::DOUBLE * x0 + -10.0::DOUBLE * y0 + 4600000.0::DOUBLE AS ay FROM v_matches) SELECT scene, ord, round((-2.0::DOUBLE * (ax - 299900.0::DOUBLE)) / -4.0::DOUBLE, 4) AS sx, round((2.0::DOUBLE * (ay - 4600100.0::DOUBLE)) / -4.0::DOUBLE, 4) AS sy, round(10.0::DOUBLE * x1 + 0.5::DOUBLE * y1 + 300000.0::DOUBLE, 4) AS mx, round(-0.5::DOUBLE * x1 + -10.0::DOUBLE * y1 + 4600000.0::DOUBLE, 4) AS my FROM m", "v_matches"),
    ),
    "q_gcp_dedup": (
        lambda s, sf: points.without_copies(grid.control_points(v_matches(s, sf), TEMPLATE, BAND), ("sx", "sy"), 500.0).select("scene", "ord", "first_ord"),
        sql("WITH m AS (SELECT *, 10.0::DOUBLE * x0 + 0.5::DOUBLE * y0 + 300000.0::DOUBLE AS ax, -0.5::DOUBLE * x0 + -10.0::DOUBLE * y0 + 4600000.0::DOUBLE AS ay FROM v_matches), g AS (SELECT scene, ord, conf, (-2.0::DOUBLE * (ax - 299900.0::DOUBLE)) / -4.0::DOUBLE AS sx, (2.0::DOUBLE * (ay - 4600100.0::DOUBLE)) / -4.0::DOUBLE AS sy FROM m) SELECT scene, ord, first_ord FROM (SELECT *, row_number() OVER (k ORDER BY conf DESC, ord) AS rn, min(ord) OVER k AS first_ord FROM g WINDOW k AS (PARTITION BY scene, round_even(sx / 500, 0), round_even(sy / 500, 0))) WHERE rn = 1", "v_matches"),
    ),
    "q_reproject_nearest": (
        lambda s, sf: raster.nearest(coverage.dense_grid(s, SIDE, SIDE), source_values(s, sf), SOURCE, TARGET),
        sql(f'SELECT tr AS "row", tc AS col, v AS value FROM {NEAREST} t LEFT JOIN (SELECT "row" AS r, col AS c, max(value) AS v FROM v_pixels GROUP BY 1, 2) p ON p.r = floor(sy) AND p.c = floor(sx)', "v_pixels"),
    ),
    "q_reproject_bilinear": (
        lambda s, sf: raster.bilinear(coverage.dense_grid(s, SIDE, SIDE), source_values(s, sf), SOURCE, TARGET).select("row", "col", F.round("value", 6).alias("value")),
        sql(f'WITH t AS (SELECT *, sx - 0.5::DOUBLE AS u, sy - 0.5::DOUBLE AS v FROM {NEAREST}), n AS (SELECT tr, tc, floor(v) + i AS r, floor(u) + j AS c, (CASE WHEN i = 1 THEN v - floor(v) ELSE 1 - (v - floor(v)) END) * (CASE WHEN j = 1 THEN u - floor(u) ELSE 1 - (u - floor(u)) END) AS w FROM t, range(2) a(i), range(2) b(j)) SELECT tr AS "row", tc AS col, round(sum(w * p.v) / sum(CASE WHEN p.v IS NOT NULL THEN w END), 6) AS value FROM n LEFT JOIN (SELECT "row" AS r, col AS c, max(value) AS v FROM v_pixels GROUP BY 1, 2) p ON p.r = n.r AND p.c = n.c AND w > 0 GROUP BY 1, 2', "v_pixels"),
    ),
    "q_decimated": (
        lambda s, sf: raster.decimated(source_values(s, sf), 8).select("row", "col", F.round("value", 6).alias("value")),
        sql('SELECT r // 8 AS "row", c // 8 AS col, round(avg(v), 6) AS value FROM (SELECT "row" AS r, col AS c, max(value) AS v FROM v_pixels GROUP BY 1, 2) GROUP BY 1, 2', "v_pixels"),
    ),
    "q_tps_warp": (tps_warp, None),
}
