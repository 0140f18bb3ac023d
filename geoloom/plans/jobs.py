"""Queries over whole jobs: tile time series of blocks, geodesy, references, matching, georeferencing states, tiling."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom.adapters import sql, table, v_config, v_matches, v_pixels, v_scenes
from geoloom.functions import columns as fc
from geoloom.functions.columns import c, d
from geoloom.operators import grid, jobs, references, selection
from geoloom.plans.points import H

#: Small blocks of 32 pixels of 10 m, tiles of 8 pixels every 4; a year counts as a day, so that the smallest tables repeat coverage.
RULES = selection.Rules(side=32, tile=8, step=4, dates=2, share=0.3, valid=0.2, days=3, res=10.0, core=(20.0, -300.0, 300.0, -20.0))
ROUTES = {"survey-2023": ["native"], "survey-2024": ["native", "float32"], "survey-2025": ["native", "float32"]}
IMAGE = 4096


def v_blocks(spark, sf):
    """Band pixels of four blocks."""
    t = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus")
    day = F.concat(F.date_format("l_shipdate", "yyyy"), F.lit("0101"))
    bands = {"R": "l_quantity", "G": "l_extendedprice", "B": "l_discount", "N": "l_tax"}
    valid = {b: (c("l_returnflag") != "N") | (c("l_quantity") > 40) if b == "R" else (c("l_linestatus") == "F") | (c("l_linenumber") == i) for i, b in enumerate(bands)}
    return t.select(
        F.format_string("BLK_%06d", (c("l_orderkey") % 2 + 1).cast("int")).alias("block_id"), (c("l_partkey") % 32).cast("int").alias("row"), (F.floor(c("l_orderkey") / 4) % 32).cast("int").alias("col"), day.alias("acq_day"),
        (c("l_suppkey") % 4).cast("int").alias("scene_ord"), F.concat(day, F.lit("_"), (c("l_suppkey") % 4).cast("string")).alias("scene_id"),
        *[c(v).cast("double").alias(k) for k, v in bands.items()], *[v.alias(f"valid_{k}") for k, v in valid.items()],
    )


V_BLOCKS = """v_blocks AS (SELECT 'BLK_' || lpad(CAST(l_orderkey % 2 + 1 AS VARCHAR), 6, '0') AS block_id, CAST(l_partkey % 32 AS INT) AS "row", CAST(l_orderkey // 4 % 32 AS INT) AS col, strftime(l_shipdate, '%Y') || '0101' AS acq_day,
 CAST(l_suppkey % 4 AS INT) AS scene_ord, strftime(l_shipdate, '%Y') || '0101_' || CAST(l_suppkey % 4 AS VARCHAR) AS scene_id, l_quantity::DOUBLE AS R, l_extendedprice::DOUBLE AS G, l_discount::DOUBLE AS B, l_tax::DOUBLE AS N,
 l_returnflag <> 'N' OR l_quantity > 40 AS valid_R, l_linestatus = 'F' OR l_linenumber = 1 AS valid_G, l_linestatus = 'F' OR l_linenumber = 2 AS valid_B, l_linestatus = 'F' OR l_linenumber = 3 AS valid_N FROM lineitem)"""
_LAST = RULES.side - RULES.tile + 1
TILES_SQL = f"""{V_BLOCKS}, counts AS (SELECT block_id, "row", col, count(DISTINCT acq_day) AS n FROM v_blocks WHERE valid_R GROUP BY 1, 2, 3),
stats AS (SELECT block_id, y.i AS "row", x.i AS col, count(*) FILTER (n >= {RULES.dates}) / {float(RULES.tile**2)}::DOUBLE AS repeated_fraction,
 coalesce(sum(n) FILTER (n >= {RULES.dates})::DOUBLE / nullif(count(*) FILTER (n >= {RULES.dates}), 0)::DOUBLE, 0.0::DOUBLE) AS mean_date_count, max(n) AS max_date_count
 FROM range(0, {_LAST}, {RULES.step}) y(i) CROSS JOIN range(0, {_LAST}, {RULES.step}) x(i) JOIN counts ON counts."row" >= y.i AND counts."row" < y.i + {RULES.tile} AND col >= x.i AND col < x.i + {RULES.tile} GROUP BY 1, 2, 3),
c AS (SELECT *, row_number() OVER (PARTITION BY block_id ORDER BY repeated_fraction DESC, mean_date_count DESC, max_date_count DESC, "row", col) AS n FROM stats
 WHERE repeated_fraction >= {RULES.share} AND col * 10 >= 20 AND -"row" * 10 - 80 >= -300 AND col * 10 + 80 <= 300 AND -"row" * 10 <= -20),
walk AS (SELECT DISTINCT block_id, 0::BIGINT AS n, CAST([] AS BIGINT[]) AS taken, false AS ok FROM c UNION ALL
 SELECT block_id, n, CASE WHEN free THEN list_append(taken, n) ELSE taken END, free FROM (SELECT c.block_id, c.n, w.taken, NOT EXISTS (SELECT 1 FROM c o WHERE o.block_id = c.block_id AND list_contains(w.taken, o.n) AND abs(o."row" - c."row") < {RULES.tile} AND abs(o.col - c.col) < {RULES.tile}) AS free FROM walk w JOIN c ON c.block_id = w.block_id AND c.n = w.n + 1) c),
tiles AS (SELECT c.*, row_number() OVER (PARTITION BY block_id ORDER BY n) AS place FROM c SEMI JOIN (SELECT block_id, n FROM walk WHERE ok) t USING (block_id, n)),
own AS (SELECT block_id, place, acq_day, p."row" AS pr, p.col AS pc, scene_ord, scene_id FROM v_blocks p JOIN tiles t USING (block_id) WHERE valid_R AND p."row" >= t."row" AND p."row" < t."row" + {RULES.tile} AND p.col >= t.col AND p.col < t.col + {RULES.tile}),
days AS (SELECT block_id, place, acq_day, count(DISTINCT pr * 100 + pc) / {float(RULES.tile**2)}::DOUBLE AS valid_fraction FROM own GROUP BY 1, 2, 3 HAVING count(DISTINCT pr * 100 + pc) / {float(RULES.tile**2)}::DOUBLE >= {RULES.valid}),
used AS (SELECT block_id, place, acq_day, string_agg(scene_id, ' | ' ORDER BY scene_ord) AS source_scene_ids FROM (SELECT DISTINCT block_id, place, acq_day, scene_ord, scene_id FROM own) GROUP BY 1, 2, 3),
enough AS (SELECT block_id, place, count(*) AS distinct_date_count, string_agg(acq_day, ' | ' ORDER BY acq_day) AS dates FROM days GROUP BY 1, 2 HAVING count(*) >= {RULES.days}),
named AS (SELECT t.*, distinct_date_count, dates, block_id || '_TS_' || lpad(CAST(row_number() OVER (PARTITION BY block_id ORDER BY place) AS VARCHAR), 6, '0') AS tile_id FROM tiles t JOIN enough USING (block_id, place))"""


def recursive(query: str) -> str:
    return f"WITH RECURSIVE {query}"


def block_tiles(spark, sf):
    """Flagship: from band pixels to numbered tiles of every block."""
    tiles, _ = selection.extracted(v_blocks(spark, sf), RULES)
    return tiles.withColumn("mean_date_count", F.round("mean_date_count", 6))


def utm_boxes(spark, sf):
    s = v_scenes(spark, sf)
    south = c("ord") % 2 == 1
    up = F.when(south, d(5000000)).otherwise(d(3000000))
    return s.select("scene_id", (c("minx") + d(400000)).alias("minx"), (c("miny") + up).alias("miny"), (c("maxx") + d(400000)).alias("maxx"), (c("maxy") + up).alias("maxy"), south.alias("is_south"), (c("ord") % 60 + 1).alias("zone_no"))


def wgs84_bounds(spark, sf):
    b = grid.wgs84_bounds(utm_boxes(spark, sf), "scene_id", c("zone_no"), c("is_south"))
    return b.select("scene_id", *[F.round(k, 7).alias(k) for k in ("west", "south", "east", "north")])


def _wgs84_sql() -> str:
    big, e, _, beta = fc.series()
    num = lambda v: f"{float(v)!r}::DOUBLE"
    a = "xi" + "".join(f" - {num(k)} * sin({num(2 * j)} * xi) * cosh({num(2 * j)} * eta)" for j, k in enumerate(beta, 1))
    b = "eta" + "".join(f" - {num(k)} * cos({num(2 * j)} * xi) * sinh({num(2 * j)} * eta)" for j, k in enumerate(beta, 1))
    steps, last = "", "s0"
    for i in range(1, 6):
        steps += f""", r{i} AS (SELECT *, sinh({num(e)} * atanh({num(e)} * t / sqrt(1 + t * t))) AS sigma FROM {last}),
n{i} AS (SELECT *, t * sqrt(1 + sigma * sigma) - sigma * sqrt(1 + t * t) AS near FROM r{i}),
s{i} AS (SELECT scene_id, lon, tau, t + (tau - near) / sqrt(1 + near * near) * (1 + {num(1 - e * e)} * t * t) / ({num(1 - e * e)} * sqrt(1 + t * t)) AS t FROM n{i})"""
        last = f"s{i}"
    return f"""WITH b AS (SELECT scene_id, minx + 400000 AS minx, miny + up AS miny, maxx + 400000 AS maxx, maxy + up AS maxy, ord % 2 = 1 AS south, ord % 60 + 1 AS zone FROM (SELECT *, CASE WHEN ord % 2 = 1 THEN 5000000 ELSE 3000000 END AS up FROM v_scenes)),
f AS (SELECT b.*, i / 20.0::DOUBLE AS f FROM b CROSS JOIN range(21) r(i)), g AS (SELECT *, minx + (maxx - minx) * f AS x, miny + (maxy - miny) * f AS y FROM f),
p AS (SELECT scene_id, south, zone, x, miny AS y FROM g UNION ALL SELECT scene_id, south, zone, x, maxy FROM g UNION ALL SELECT scene_id, south, zone, minx, y FROM g UNION ALL SELECT scene_id, south, zone, maxx, y FROM g),
k AS (SELECT scene_id, zone, (y - CASE WHEN south THEN {num(fc.SOUTH)} ELSE 0 END) / {num(fc.SCALE * big)} AS xi, (x - {num(fc.EAST)}) / {num(fc.SCALE * big)} AS eta FROM p),
ab AS (SELECT scene_id, zone, {a} AS a, {b} AS b FROM k),
s0 AS (SELECT scene_id, (zone * 6 - 183) + degrees(atan2(sinh(b), cos(a))) AS lon, sin(a) / sqrt(sinh(b) * sinh(b) + cos(a) * cos(a)) AS tau, sin(a) / sqrt(sinh(b) * sinh(b) + cos(a) * cos(a)) AS t FROM ab){steps}
SELECT scene_id, round(min(lon), 7) AS west, round(min(degrees(atan(t))), 7) AS south, round(max(lon), 7) AS east, round(max(degrees(atan(t))), 7) AS north FROM {last} GROUP BY 1"""


def summaries(spark, sf):
    """Scenes with a JSON summary for two thirds of them."""
    v = v_config(spark, sf)
    listed = F.transform("directions", lambda x, i: F.struct(x.alias("direction"), F.concat(F.when(i % 2 == 0, "/abs/").otherwise(""), F.lit("ref_"), x, F.lit(".tif")).alias("path"), F.array(c("west"), c("south"), c("west") + 1, c("south") + 1).alias("crop_bounds")))
    doc = F.to_json(F.struct(F.struct(listed.alias("candidates")).alias("multi_reference")))
    return v.select("scene", F.concat(F.lit("/scenes/"), c("scene").cast("string")).alias("folder"), F.when(c("scene") % 3 != 0, doc).alias("summary"), F.lit("/center.tif").alias("center"), F.array(d(0), d(1), d(2), d(3)).alias("bounds"), "directions")


def states(spark, sf):
    """Scenes in every state of georeferencing."""
    k = c("c_custkey")
    return table(spark, sf, "customer").select(
        k.alias("scene"), (k % 11 != 0).alias("has_template_dir"), (k % 13 != 0).alias("has_original_dir"), (k % 7 != 0).alias("has_matches"), (k % 17 != 0).alias("has_template"), (k % 19 != 0).alias("has_reference"), (k % 23 != 0).alias("has_crs"),
        (k * 7 % 40).cast("int").alias("matches_total"), (k * 5 % 40).cast("int").alias("gcps_selected"), (k % 5).cast("int").alias("bands_found"), (k % 3).cast("int").alias("bands_written"), F.when((k % 29 == 0) | (k % 31 == 0), "boom").alias("error"),
        F.when(k % 31 == 0, "matches").alias("error_stage"), F.concat(F.lit("/r/"), k.cast("string"), F.lit(".tif")).alias("reference_path"),
    )


def tried(spark, sf):
    k = c("c_custkey")
    return table(spark, sf, "customer").select((F.floor(k / 5)).alias("scene"), (k % 5).alias("pos"), (k * 37 % 50).alias("inliers"), (k * 37 % 50 >= 12).alias("exportable"), F.when(k % 7 == 0, "boom").alias("failure"))


def recorded(spark, sf):
    k = c("c_custkey")
    name = F.concat(F.lit("/x/ref_"), k.cast("string"), F.lit(".tif"))
    return table(spark, sf, "customer").select(
        k.alias("scene"), F.when(k % 3 == 0, "ne").alias("meta_direction"), F.when(k % 3 == 0, name).alias("meta_reference"), F.when(k % 6 == 0, "/y/used.tif").alias("meta_path"), F.when(k % 2 == 0, "c").alias("match_direction"), F.when(k % 2 == 0, name).alias("match_path"),
        F.lit("/s").alias("folder"), F.when(k % 5 == 0, F.array(name, F.lit("/y/used.tif"))).when(k % 5 == 1, F.array(F.concat(F.lit("/s/ref_"), k.cast("string"), F.lit(".tif")))).otherwise(F.array().cast("array<string>")).alias("files"),
    )


def band_files(spark):
    """Bands of eight scenes; one lacks its last."""
    return spark.range(32).select((c("id") % 8).cast("int").alias("scene_ord"), F.element_at(F.array(*map(F.lit, jobs.BANDS)), (F.floor(c("id") / 8) + 1).cast("int")).alias("band")).where("not (scene_ord = 5 and band = 'N')")


def chunks(spark):
    return spark.range(8).select(c("id").cast("int").alias("scene_ord"), F.format_string("survey-%d-part-%d", c("id") % 3 + 2023, "id").alias("name"))


def tiling(spark, sf):
    return jobs.tiling_report(v_pixels(spark, sf).withColumn("valid_float", c("valid") & (c("value") != 7)), band_files(spark), chunks(spark), ROUTES, 10, 64, 64, 0.05)


def gcps(spark, sf):
    bands = [grid.control_points(v_matches(spark, sf), {"a": 10.0, "b": 0.5, "c": 300000.0, "d": -0.5, "e": -10.0, "f": 4600000.0}, {"a": s, "b": 0.0, "c": 299900.0, "d": 0.0, "e": -s, "f": 4600100.0}).withColumn("band", F.lit(b)) for b, s in (("R", 2.0), ("G", 4.0))]
    return bands[0].unionByName(bands[1])


def stacked(spark, sf):
    t = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_returnflag").where("l_linenumber <= 4")
    p = t.select((c("l_orderkey") % 8).alias("scene"), c("l_orderkey").alias("row"), F.lit(0).alias("col"), F.element_at(F.array(*map(F.lit, jobs.BANDS)), c("l_linenumber").cast("int")).alias("band"), c("l_quantity").cast("double").alias("value"), (c("l_returnflag") != "R").alias("valid"))
    base = F.array(*[F.struct(F.lit(b).alias("band"), d(k).alias("scale"), d(o).alias("offset")) for b, k, o in (("R", 0.5, 1.0), ("G", 1.0, 0.0), ("B", 0.25, -3.0), ("N", 2.0, 0.5))])
    r = p.select("scene").distinct().select("scene", F.inline(base)).withColumn("scale", c("scale") + c("scene").cast("double") / d(4)).withColumn("offset", c("offset") - c("scene").cast("double"))
    return jobs.band_stack(p, r, -9999.0).select("scene", "row", "col", *[c(b).cast("double").alias(b) for b in jobs.BANDS])


def merged_pairs(spark, sf):
    m = v_matches(spark, sf).select("scene", "ord", "conf")
    return jobs.coarse_and_tiles(m.where("ord % 3 = 0"), m.where("ord % 3 = 1"))


def priors(spark, sf):
    tiles = spark.createDataFrame([(i, 10.0 * i, 5.0 * i, 10.0 * i + 1, 5.0 * i - 1) for i in range(8)], "tile_id long, mov_x double, mov_y double, ref_x double, ref_y double")
    m = v_matches(spark, sf).withColumnRenamed("scene", "tile_id")
    return jobs.prior_gated(m, tiles, H, 2.5).groupBy("tile_id").agg(F.count(F.lit(1)).alias("n"), F.round(F.max("residual"), 6).alias("worst"))


_AFFINE = "(SELECT *, 10.0::DOUBLE * x0 + 0.5::DOUBLE * y0 + 300000.0::DOUBLE AS ax, -0.5::DOUBLE * x0 + -10.0::DOUBLE * y0 + 4600000.0::DOUBLE AS ay FROM v_matches)"
_H = {k: f"({H[3 * i]!r}::DOUBLE * gx0 + {H[3 * i + 1]!r}::DOUBLE * gy0 + {H[3 * i + 2]!r}::DOUBLE)" for i, k in enumerate("xyw")}
_UP = "list_transform(directions, lambda x: upper(x))"
_EXPECTED = f"list_prepend('C', list_filter({_UP}, lambda x, i: x <> 'C' AND list_position({_UP}, x) = i))"

QUERIES = {
    "q_block_tiles": (block_tiles, recursive(f'{TILES_SQL} SELECT block_id, tile_id, col * 10.0::DOUBLE AS west, -"row" * 10.0::DOUBLE - 80.0::DOUBLE AS south, col * 10.0::DOUBLE + 80.0::DOUBLE AS east, -"row" * 10.0::DOUBLE AS north, distinct_date_count, dates, repeated_fraction, round(mean_date_count, 6) AS mean_date_count, max_date_count, "row", col FROM named')),
    "q_block_observations": (
        lambda s, sf: selection.extracted(v_blocks(s, sf), RULES)[1],
        recursive(f"{TILES_SQL} SELECT block_id, tile_id, acq_day, valid_fraction, source_scene_ids, tile_id || '_' || acq_day || '_RGBN_8_10m' AS observation FROM named JOIN days USING (block_id, place) JOIN used USING (block_id, place, acq_day)"),
    ),
    "q_block_mosaic": (
        lambda s, sf: selection.day_mosaic(v_blocks(s, sf)),
        f"WITH {V_BLOCKS} SELECT block_id, \"row\", col, acq_day, " + ", ".join(f"coalesce((min(struct_pack(s := scene_ord, v := {b})) FILTER (valid_{b})).v, -9999.0::DOUBLE) AS {b}" for b in selection.BANDS) + ", bool_or(valid_R) AS valid FROM v_blocks GROUP BY 1, 2, 3, 4",
    ),
    "q_wgs84_bounds": (wgs84_bounds, sql(_wgs84_sql(), "v_scenes")),
    "q_expanded_boxes": (
        lambda s, sf: v_config(s, sf).select("scene", *[v.alias(k) for k, v in zip(("west", "south", "east", "north"), grid.expand_box(c("west"), c("south"), c("west") + 1, c("south") + 2, 0.25), strict=True)]),
        sql("SELECT scene, west - 0.25::DOUBLE AS west, south - 0.25::DOUBLE AS south, west + 1 + 0.25::DOUBLE AS east, south + 2 + 0.25::DOUBLE AS north FROM v_config", "v_config"),
    ),
    "q_predicted_windows": (
        lambda s, sf: v_matches(s, sf).select("scene", "ord", *[v.alias(k) for k, v in zip(("top", "bottom", "left", "right"), grid.predicted_window([(c("x1"), c("y1")), (c("x0") + 100, c("y0")), (c("x0"), c("y0") + 50)], 32.0, F.lit(IMAGE), F.lit(IMAGE)), strict=True)]),
        sql(f"SELECT scene, ord, greatest(0, least(floor(least(y1, y0, y0 + 50) - 32), {IMAGE}))::BIGINT AS top, greatest(0, least(ceil(greatest(y1, y0, y0 + 50) + 32) + 1, {IMAGE}))::BIGINT AS bottom, greatest(0, least(floor(least(x1, x0 + 100, x0) - 32), {IMAGE}))::BIGINT AS \"left\", greatest(0, least(ceil(greatest(x1, x0 + 100, x0) + 32) + 1, {IMAGE}))::BIGINT AS \"right\" FROM v_matches", "v_matches"),
    ),
    "q_reference_candidates": (
        lambda s, sf: references.configured(summaries(s, sf)).select("scene", "pos", "direction", "path", F.array_join(F.transform("crop_bounds", lambda x: x.cast("int").cast("string")), ",").alias("bounds")),
        sql("""WITH e AS (SELECT scene, west, south, unnest(directions) AS x, CAST(unnest(range(len(directions))) AS INT) AS pos FROM v_config WHERE scene % 3 <> 0)
SELECT scene, pos, upper(x) AS direction, CASE WHEN pos % 2 = 0 THEN '/abs/' ELSE '/scenes/' || CAST(scene AS VARCHAR) || '/' END || 'ref_' || x || '.tif' AS path, concat_ws(',', west::INT, south::INT, west::INT + 1, south::INT + 1) AS bounds FROM e
UNION ALL SELECT scene, 0, 'C', '/center.tif', '0,1,2,3' FROM v_config WHERE scene % 3 = 0""", "v_config"),
    ),
    "q_checked_candidates": (
        lambda s, sf: references.checked(summaries(s, sf).select("scene", F.when(c("scene") % 4 != 0, c("directions")).alias("directions"), F.when(c("scene") % 3 != 0, F.when(c("scene") % 2 == 0, F.array_distinct(F.array_prepend("directions", "C"))).otherwise(c("directions"))).alias("actual"))).select("scene", F.array_join("expected", ",").alias("expected"), F.array_join("actual", ",").alias("actual"), F.size("errors").alias("n_errors"), "status"),
        sql(f"""WITH a AS (SELECT scene, scene % 4 = 0 AS nc, scene % 3 = 0 AS ns, CASE WHEN scene % 4 = 0 THEN [] ELSE {_EXPECTED} END AS expected,
 CASE WHEN scene % 3 = 0 THEN [] WHEN scene % 2 = 0 THEN list_prepend('C', list_filter({_UP}, lambda x, i: list_position(directions, directions[i]) = i)) ELSE {_UP} END AS actual FROM v_config)
SELECT scene, array_to_string(expected, ',') AS expected, array_to_string(actual, ',') AS actual, nc::INT + ns::INT + (expected <> actual)::INT AS n_errors, CASE WHEN nc OR ns OR expected <> actual THEN 'FAIL' ELSE 'PASS' END AS status FROM a""", "v_config"),
    ),
    "q_candidate_outcomes": (
        lambda s, sf: references.outcomes(tried(s, sf)),
        "WITH t AS (SELECT c_custkey // 5 AS scene, c_custkey % 5 AS pos, c_custkey * 37 % 50 AS inliers, c_custkey * 37 % 50 >= 12 AS exportable, CASE WHEN c_custkey % 7 = 0 THEN 'boom' END AS failure FROM customer), s AS (SELECT *, CASE WHEN failure IS NOT NULL THEN 'error' WHEN exportable THEN 'ok' ELSE 'rejected' END AS status FROM t) SELECT *, status = 'ok' AND row_number() OVER (PARTITION BY scene ORDER BY status <> 'ok', inliers DESC, pos) = 1 AS selected FROM s",
    ),
    "q_selected_reference": (
        lambda s, sf: references.selected(recorded(s, sf)),
        """WITH r AS (SELECT c_custkey AS scene, CASE WHEN c_custkey % 3 = 0 THEN 'NE' WHEN c_custkey % 2 = 0 THEN 'C' END AS direction, CASE WHEN c_custkey % 6 = 0 THEN '/y/used.tif' WHEN c_custkey % 3 = 0 OR c_custkey % 2 = 0 THEN '/x/ref_' || CAST(c_custkey AS VARCHAR) || '.tif' END AS path FROM customer),
a AS (SELECT scene, direction, CASE WHEN direction IS NULL THEN NULL WHEN scene % 5 = 0 THEN path WHEN scene % 5 = 1 AND scene % 6 <> 0 THEN '/s/ref_' || CAST(scene AS VARCHAR) || '.tif' END AS path FROM r)
SELECT scene, CASE WHEN path IS NOT NULL THEN direction END AS direction, path, CASE WHEN direction IS NULL THEN 'no_selected_reference_metadata' WHEN path IS NULL THEN 'selected_reference_missing' END AS reason FROM a""",
    ),
    "q_georeferencing_states": (
        lambda s, sf: jobs.georeferencing_state(states(s, sf), 12).select("scene", "status", "reason"),
        """WITH s AS (SELECT c_custkey AS k, c_custkey * 7 % 40 AS m, c_custkey * 5 % 40 AS g FROM customer), r AS (SELECT k, CASE WHEN k % 11 = 0 THEN 'missing_template_scene_dir' WHEN k % 13 = 0 THEN 'missing_original_scene_dir' WHEN k % 7 = 0 THEN 'missing_matches_filtered' WHEN k % 17 = 0 THEN 'missing_rgb_template'
 WHEN k % 31 = 0 THEN 'boom' WHEN k % 19 = 0 THEN 'FileNotFoundError(''Selected matching reference no longer exists: /r/' || CAST(k AS VARCHAR) || '.tif'')' WHEN m < 12 THEN 'too_few_matches(' || CAST(m AS VARCHAR) || ')' WHEN k % 23 = 0 THEN 'template_has_no_crs' WHEN g < 12 THEN 'too_few_gcps_after_selection(' || CAST(g AS VARCHAR) || ')' WHEN k % 5 = 0 THEN 'no_original_bands_found'
 WHEN k % 29 = 0 THEN 'boom' WHEN k % 3 > 0 THEN '' ELSE 'no_bands_written' END AS reason FROM s) SELECT k AS scene, CASE WHEN reason = '' THEN 'success' WHEN reason IN ('boom', 'no_bands_written') OR starts_with(reason, 'FileNotFound') THEN 'failed' ELSE 'skipped' END AS status, reason FROM r""",
    ),
    "q_fewest_control_points": (
        lambda s, sf: jobs.fewest_control_points(gcps(s, sf), 500.0),
        sql(f"WITH p AS (SELECT scene, b, (ax - 299900.0::DOUBLE) / s AS sx, (ay - 4600100.0::DOUBLE) / -s AS sy FROM {_AFFINE} CROSS JOIN (VALUES ('R', 2.0::DOUBLE), ('G', 4.0::DOUBLE)) v(b, s)), n AS (SELECT scene, b, count(DISTINCT (round_even(sx / 500, 0), round_even(sy / 500, 0))) AS n FROM p GROUP BY 1, 2) SELECT scene, min(n) AS gcps_after_dedup_min, count(*) AS bands FROM n GROUP BY 1", "v_matches"),
    ),
    "q_band_stack": (
        stacked,
        """WITH p AS (SELECT l_orderkey % 8 AS scene, l_orderkey AS "row", ['R', 'G', 'B', 'N'][CAST(l_linenumber AS INT)] AS band, CASE WHEN l_returnflag <> 'R' THEN l_quantity::FLOAT * (s + (l_orderkey % 8)::DOUBLE / 4.0::DOUBLE)::FLOAT + (o - (l_orderkey % 8)::DOUBLE)::FLOAT ELSE -9999.0::FLOAT END AS v FROM lineitem JOIN (VALUES (1, 0.5, 1.0), (2, 1.0, 0.0), (3, 0.25, -3.0), (4, 2.0, 0.5)) r(b, s, o) ON l_linenumber = b)
SELECT scene, "row", 0 AS col, max(v) FILTER (band = 'R')::DOUBLE AS R, max(v) FILTER (band = 'G')::DOUBLE AS G, max(v) FILTER (band = 'B')::DOUBLE AS B, max(v) FILTER (band = 'N')::DOUBLE AS N FROM p GROUP BY 1, 2 HAVING count(DISTINCT band) = 4""",
    ),
    "q_tiling_report": (
        tiling,
        sql("""WITH p AS (SELECT m, scene_ord, "row", col, bool_and(valid AND (m = '' OR value <> 7)) AS ok FROM v_pixels CROSS JOIN (VALUES (''), ('-float32')) v(m) WHERE scene_ord <> 5 GROUP BY ALL), t AS (SELECT m, scene_ord, "row" // 10 AS tr, col // 10 AS tc, count(*) FILTER (ok) AS n FROM p GROUP BY ALL), u AS (SELECT *, least(10, 64 - tr * 10) AS h, least(10, 64 - tc * 10) AS w FROM t),
r AS (SELECT m, scene_ord, count(*) AS raw_tiles, count(*) FILTER (h = 10 AND w = 10 AND n / 100.0::DOUBLE >= 0.05) AS valid_tiles, count(*) FILTER (h < 10 OR w < 10) AS rejected_shape, count(*) FILTER (h = 10 AND w = 10 AND n / 100.0::DOUBLE < 0.05) AS rejected_valid_ratio FROM u GROUP BY ALL)
SELECT 'survey-' || CAST(scene_ord % 3 + 2023 AS VARCHAR) || m AS dataset, scene_ord, raw_tiles, valid_tiles, rejected_shape, rejected_valid_ratio FROM r WHERE m = '' OR scene_ord % 3 > 0""", "v_pixels"),
    ),
    "q_mean_validity": (
        lambda s, sf: jobs.mean_validity(v_pixels(s, sf), 16),
        sql('SELECT scene_ord, "row" // 16 AS trow, col // 16 AS tcol, avg(valid::INT::DOUBLE) AS valid_fraction FROM v_pixels GROUP BY 1, 2, 3', "v_pixels"),
    ),
    "q_batches": (
        lambda s, sf: table(s, sf, "customer").select(c("c_custkey").alias("scene"), jobs.batch_of(c("c_custkey") + 1, 16).alias("batch")),
        "SELECT c_custkey AS scene, c_custkey // 16 AS batch FROM customer",
    ),
    "q_coarse_and_tiles": (
        merged_pairs,
        sql("WITH m AS (SELECT scene, max(ord) + 1 AS f FROM v_matches WHERE ord % 3 = 0 GROUP BY 1) SELECT scene, ord, conf FROM v_matches WHERE ord % 3 = 0 UNION ALL SELECT v.scene, ord + coalesce(f, 0), conf FROM v_matches v LEFT JOIN m ON v.scene = m.scene WHERE ord % 3 = 1", "v_matches"),
    ),
    "q_tile_filter": (
        lambda s, sf: jobs.tile_filter(v_matches(s, sf).where("scene <> 3 and (scene <> 4 or conf < 0.1)"), s.range(8).select(c("id").alias("scene")), 0.2, 60.0, 512, 2, IMAGE),
        sql(f"""WITH m AS (SELECT * FROM v_matches WHERE scene <> 3 AND (scene <> 4 OR conf < 0.1)), k AS (SELECT m.* FROM m JOIN (SELECT scene, greatest(0.2::DOUBLE, quantile_cont(conf, 0.4))::FLOAT AS cut FROM m GROUP BY 1) q USING (scene) WHERE conf::FLOAT >= cut),
t AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY scene, floor(x1 / 512), floor(y1 / 512) ORDER BY conf DESC, ord) AS rn FROM k WHERE x1 >= 0 AND x1 < {IMAGE} AND y1 >= 0 AND y1 < {IMAGE}) WHERE rn <= 2),
n AS (SELECT i AS scene, (SELECT count(*) FROM m WHERE m.scene = i) AS n_raw, (SELECT count(*) FROM k WHERE k.scene = i) AS n_after_conf, (SELECT count(*) FROM t WHERE t.scene = i) AS n_after_spatial FROM range(8) r(i))
SELECT *, CASE WHEN n_raw = 0 THEN 'no_raw_matches' WHEN n_after_conf = 0 THEN 'no_matches_after_conf' WHEN n_after_spatial = 0 THEN 'no_matches_after_spatial' ELSE 'ok' END AS reason FROM n""", "v_matches"),
    ),
    "q_prior_gated": (
        priors,
        sql(f"WITH g AS (SELECT scene, x0 + 10.0::DOUBLE * scene AS gx0, y0 + 5.0::DOUBLE * scene AS gy0, x1 + 10.0::DOUBLE * scene + 1 AS gx1, y1 + 5.0::DOUBLE * scene - 1 AS gy1 FROM v_matches), r AS (SELECT scene, sqrt((px - gx1) * (px - gx1) + (py - gy1) * (py - gy1)) AS residual FROM (SELECT *, {_H['x']} / {_H['w']} AS px, {_H['y']} / {_H['w']} AS py FROM g)) SELECT scene AS tile_id, count(*) AS n, round(max(residual), 6) AS worst FROM r WHERE residual <= 2.5 GROUP BY 1", "v_matches"),
    ),
    "q_match_ladder": (lambda s, sf: jobs.match_ladder(v_matches(s, sf).where("scene <> 2 or ord % 97 = 0"), "affine_ransac", IMAGE, keep=60.0), None),
}
