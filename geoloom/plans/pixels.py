"""Queries over pixels: from files and back, warps by blocks, previews, reference systems, finalising."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from geoloom.adapters import sql, table, v_config, v_matches, v_pixels
from geoloom.functions import columns as fc
from geoloom.functions.columns import c, d
from geoloom.functions.geodesy import geodesic_sql
from geoloom.operators import catalog, finalise, grid, points, preview, warp
from geoloom.plans.space import NEAREST, SIDE, SOURCE, TARGET, boxes
from geoloom.sources import files, pixels, rasters, shared

SMALL = 16
VALUES_SQL = 'SELECT "row" AS r, col AS c, max(value) AS v FROM v_pixels GROUP BY 1, 2'


def images(spark, sf):
    """One image a scene: name, row, col, r, g, b."""
    p = v_pixels(spark, sf).groupBy((c("scene_ord")).alias("scene"), "row", "col").agg(F.max("value").alias("r"), F.min("value").alias("g"), F.count("*").cast("double").alias("b"))
    return p.select(F.format_string("s%d/image.tif", "scene").alias("name"), "row", "col", "r", "g", "b")


def from_files(spark, sf):
    """Images are written as tiled files and a window of them is read back: what a user with files sees."""
    df = images(spark, sf)
    grids = df.select("name").distinct().select("name", F.lit(SIDE).alias("width"), F.lit(SIDE).alias("height"), *[d(v).alias(k) for k, v in SOURCE.items()], F.lit(32638).alias("epsg"), d(0).alias("nodata"))
    folder = shared.scratch(spark)
    rasters.written(rasters.tiles(df, grids, ("r", "g", "b"), "float64", SMALL), folder, 16)
    back = pixels.rgb(files.listing(spark, folder), (3, 60, 7, 51), 16).where("valid")
    return back.select(F.regexp_extract("path", r"(s\d+/image\.tif)$", 1).alias("name"), "row", "col", "r", "g", "b")


def headers(spark, sf):
    """Headers of the files written from the table."""
    df = images(spark, sf)
    grids = df.select("name").distinct().select("name", F.lit(SIDE).alias("width"), (F.lit(40) + F.substring("name", 2, 1).cast("int")).alias("height"), *[d(v).alias(k) for k, v in SOURCE.items()], F.lit(32638).alias("epsg"), d(-9).alias("nodata"))
    folder = shared.scratch(spark)
    rasters.written(rasters.tiles(df, grids, ("r", "g"), "float32", SMALL), folder, 16)
    h = files.headers(files.listing(spark, folder))
    return h.select(F.regexp_extract("path", r"(s\d+/image\.tif)$", 1).alias("name"), "width", "height", "bands", "a", "c", "e", "f", "nodata", "crs")


def warped(spark, sf, kernel):
    """The table's image on the target grid, by blocks of 16 pixels."""
    p = v_pixels(spark, sf).groupBy("row", "col").agg(F.max("value").alias("value")).select(F.lit("image").alias("name"), "row", "col", "value")
    one = spark.range(1)
    at = lambda t: one.select(F.lit("image").alias("name"), F.lit(SIDE).alias("width"), F.lit(SIDE).alias("height"), *[d(v).alias(k) for k, v in t.items()], F.lit(32638).alias("epsg"))
    return warp.to_grid(p, at(SOURCE), at(TARGET), ("value",), kernel, SMALL).select("row", "col", F.round("value", 6).alias("value"))


def spline_pixels(spark, sf):
    """Each scene's image through the spline of up to 1,200 of its pairs, whole."""
    m = points.balanced(v_matches(spark, sf), 4000, 4000, 16, 1200)
    name = F.format_string("s%d", "scene")
    control = m.select(name.alias("name"), "ord", (c("x1") / d(64)).alias("mx"), (c("y1") / d(64)).alias("my"), (c("x0") / d(64)).alias("sx"), (c("y0") / d(64)).alias("sy"))
    p = v_pixels(spark, sf).groupBy(c("scene_ord").alias("scene"), "row", "col").agg(F.max("value").alias("value")).select(name.alias("name"), "row", "col", "value")
    sizes = control.select("name").distinct().select("name", F.lit(SIDE).alias("width"), F.lit(SIDE).alias("height"))
    same = {"a": 1.0, "b": 0.0, "c": 0.0, "d": 0.0, "e": 1.0, "f": 0.0}
    grids = sizes.select("*", *[d(v).alias(k) for k, v in same.items()], F.lit(32638).alias("epsg"))
    return warp.by_control_points(p, sizes, control, grids, ("value",), side=SMALL, smoothing=1e-3)


def bytes_of(spark, sf):
    """Dense byte images, one for each scene: name, row, col, r."""
    p = v_pixels(spark, sf).groupBy(c("scene_ord").alias("s"), "row", "col").agg((F.sum("value") * 5).alias("v"))
    every = p.select("s").distinct().select("s", F.explode(F.sequence(F.lit(0), F.lit(SIDE - 1))).alias("row")).select("*", F.explode(F.sequence(F.lit(0), F.lit(SIDE - 1))).alias("col"))
    return every.join(p, ["s", "row", "col"], "left").select(F.format_string("s%d", "s").alias("name"), "row", "col", F.coalesce(c("v").cast("long") % 256, F.lit(0)).cast("int").alias("r"))


def smaller(spark, sf):
    df = bytes_of(spark, sf)
    number = F.substring("name", 2, 1).cast("int")
    sizes = df.select("name").distinct().select("name", F.lit(SIDE).alias("width"), F.lit(SIDE).alias("height"), (F.lit(10) + number * 3).alias("out_width"), (F.lit(30) - number).alias("out_height"))
    return preview.resized(df, sizes, ("r",))


def means(spark, sf):
    df = v_pixels(spark, sf).groupBy(F.format_string("s%d", "scene_ord").alias("name"), "row", "col").agg(F.max("value").alias("v"), F.bool_or("valid").alias("valid"))
    number = F.substring("name", 2, 1).cast("int")
    sizes = df.select("name").distinct().select("name", F.lit(SIDE).alias("width"), F.lit(SIDE).alias("height"), (F.lit(9) + number).alias("out_width"), F.lit(16).alias("out_height"))
    return preview.averaged(df, sizes, ("v",)).select("name", "row", "col", F.round("v", 6).alias("v"))


def lonlat(spark, sf):
    """Boxes of 0.05 degrees in three systems, to one UTM zone."""
    b = table(spark, sf, "customer").select(c("c_custkey").alias("k"), (d(44) + (c("c_custkey") % 90).cast("double") / d(50)).alias("lon"), (d(38) + (c("c_nationkey") % 25).cast("double") / d(10)).alias("lat"))
    x, y = fc.utm_from_wgs84(c("lon"), c("lat"), F.lit(37))
    near, far = c("k") % 3 == 0, c("k") % 3 == 1
    corner = [F.when(near, c("lon")).when(far, x).otherwise((c("k") % 100).cast("double")), F.when(near, c("lat")).when(far, y).otherwise((c("k") % 70).cast("double"))]
    side = F.when(near, d(0.05)).otherwise(d(5000))
    t = b.select("k", F.when(near, "EPSG:4326").when(far, "EPSG:32637").otherwise("EPSG:32638").alias("crs"), corner[0].alias("minx"), corner[1].alias("miny"), side.alias("side"))
    return t.select("k", "crs", "minx", "miny", (c("minx") + c("side")).alias("maxx"), (c("miny") + c("side")).alias("maxy"))


def reprojected(spark, sf):
    return grid.reprojected(lonlat(spark, sf), "k", "EPSG:32638").select("k", *[F.round(v, 3).alias(v) for v in ("minx", "miny", "maxx", "maxy")])


def finalising(spark, sf):
    cfg = v_config(spark, sf).select("scene", "overlap", "directions", "west", "south")
    name = F.format_string("scene%d", "scene")
    scenes = cfg.select(name.alias("scene"), (c("scene") % 11 != 0).alias("has_dir"), F.when(c("scene") % 7 != 0, F.concat(F.lit("/out/"), name, F.lit("/template.tif"))).alias("template"), F.concat(F.lit("/out/"), name).alias("folder"), c("west").alias("left"), c("south").alias("bottom"), (c("west") + 2).alias("right"), (c("south") + 1).alias("top"))
    kinds = F.array(*map(F.lit, (".tif", ".tiff", "-0001.tif", "-0002.tif", ".tif.part")))
    listed = table(spark, sf, "orders").select(F.format_string("scene%d", "o_custkey").alias("scene"), "o_orderkey")
    found = finalise.exports(listed.select(F.concat(F.lit("/exports"), (c("o_orderkey") % 2).cast("string"), F.lit("/"), "scene", F.lit(finalise.EXPORT), F.element_at(kinds, (c("o_orderkey") % 5 + 1).cast("int"))).alias("path")))
    settings = cfg.where("scene % 3 = 0").select(name.alias("scene"), "overlap", "directions")
    r = finalise.finalised(scenes, found, settings, 32638)
    multi = c("summary.multi_reference")
    return r.select("scene", "status", "drive_export", "raw_path", "center_reference", "reference_candidates", "error", F.array_join(multi["directions"], ",").alias("directions"), F.element_at(multi["candidates"], -1)["crop_bounds"][0].alias("last_left"))


def checked(spark, sf):
    """Settings of every customer as JSON, some of them wrong."""
    cfg = v_config(spark, sf).select("scene", "overlap", "directions")
    names = F.concat(F.lit('["'), F.array_join("directions", '", "'), F.lit('"]'))
    overlap = F.when(c("scene") % 13 == 0, "1.5").when(c("scene") % 13 == 1, '"x"').otherwise(c("overlap").cast("string"))
    entry = F.concat(F.lit('{"overlap": '), overlap, F.when(c("scene") % 5 > 0, F.concat(F.lit(', "directions": '), F.when(c("scene") % 17 == 0, F.lit('["up", "n"]')).otherwise(names))).otherwise(""), F.when(c("scene") % 19 == 0, F.lit(', "range": 3')).otherwise(""), F.lit("}"))
    r = catalog.checked_settings(cfg.select("scene", entry.alias("entry")))
    return r.select("scene", "overlap", F.array_join("directions", ",").alias("directions"), "error")


def points_of_bands(spark, sf):
    """Control points of two bands in neighbouring zones, from a template in one."""
    m = v_matches(spark, sf)
    near = {"a": 10.0, "b": 0.0, "c": 700000.0, "d": 0.0, "e": -10.0, "f": 4500000.0}
    t = m.select("scene").distinct().select("scene", *[d(v).alias(k) for k, v in near.items()], F.lit(32637).alias("epsg"))
    b = t.select("scene", F.explode(F.array(F.lit("R"), F.lit("N"))).alias("band"), *[c(k) for k in "abde"], (c("c") - F.when(c("band") == "N", d(510000)).otherwise(d(100))).alias("c"), (c("f") + d(100)).alias("f"), F.when(c("band") == "N", 32638).otherwise(32637).alias("epsg"))
    g = grid.band_control_points(m, t, b)
    return g.select("scene", "band", "ord", *[F.round(k, 4).alias(k) for k in ("sx", "sy", "mx", "my")])


def slices(spark, sf):
    """An open-ended slice and one from the end, of all customers by name."""
    s = table(spark, sf, "customer").select(c("c_name").alias("scene")).distinct()
    return catalog.batch(s, 100, None).withColumn("slice", F.lit("100:")).unionByName(catalog.batch(s, -50, -20).withColumn("slice", F.lit("-50:-20")))


def _weights(side: int, out: str) -> str:
    """Whole kernel weights of an axis, as preview.axis_weights()."""
    x = "((i - mid + 0.5::DOUBLE) / wide)"
    return f"""SELECT name, o, i, CAST(CASE WHEN k < 0 THEN trunc(k - 0.5::DOUBLE) ELSE trunc(k + 0.5::DOUBLE) END AS BIGINT) AS k FROM (SELECT name, o, i, w / sum(w) OVER (PARTITION BY name, o) * {1 << preview.BITS}::DOUBLE AS k FROM (
 SELECT name, o, i, CASE WHEN {x} = 0 THEN 1.0::DOUBLE WHEN abs({x}) < 3 THEN sin({math.pi!r}::DOUBLE * {x}) * sin({math.pi!r}::DOUBLE * {x} / 3) * 3 / ({math.pi!r}::DOUBLE * {x} * ({math.pi!r}::DOUBLE * {x})) ELSE 0 END AS w
 FROM (SELECT name, o.i AS o, i.i AS i, (o.i + 0.5::DOUBLE) * ({side}.0::DOUBLE / {out}) AS mid, greatest({side}.0::DOUBLE / {out}, 1) AS wide FROM sizes JOIN range({side}) o(i) ON o.i < {out} CROSS JOIN range({side}) i(i))
 WHERE i >= greatest(trunc(mid - 3 * wide + 0.5::DOUBLE), 0) AND i < least(trunc(mid + 3 * wide + 0.5::DOUBLE), {side})))"""


_BYTE = "CAST(least(greatest((sum({v} * k)::BIGINT + {half}) >> {bits}, 0), 255) AS INT)".replace("{half}", str(1 << (preview.BITS - 1))).replace("{bits}", str(preview.BITS))
RESIZED_SQL = f"""WITH names AS (SELECT DISTINCT scene_ord AS s FROM v_pixels), sizes AS (SELECT 's' || s AS name, 10 + s * 3 AS out_width, 30 - s AS out_height FROM names),
img AS (SELECT 's' || s AS name, r.i AS "row", q.i AS col, CAST(coalesce(CAST(v AS BIGINT) % 256, 0) AS BIGINT) AS r FROM names CROSS JOIN range({SIDE}) r(i) CROSS JOIN range({SIDE}) q(i)
 LEFT JOIN (SELECT scene_ord, "row" AS pr, col AS pc, sum(value) * 5 AS v FROM v_pixels GROUP BY ALL) p ON p.scene_ord = s AND pr = r.i AND pc = q.i),
wx AS ({_weights(SIDE, "out_width")}), wy AS ({_weights(SIDE, "out_height")}),
across AS (SELECT img.name, "row", o AS col, {_BYTE.format(v="r")} AS r FROM img JOIN wx ON wx.name = img.name AND i = col GROUP BY img.name, "row", o)
SELECT a.name, CAST(o AS INT) AS "row", CAST(col AS INT) AS col, {_BYTE.format(v="r")} AS r FROM across a JOIN wy ON wy.name = a.name AND i = "row" GROUP BY a.name, o, col"""
MEANS_SQL = f"""WITH p AS (SELECT scene_ord, "row", col, max(value) AS v FROM v_pixels GROUP BY ALL HAVING bool_or(valid)),
e AS (SELECT scene_ord, v, oy.i AS oy, ox.i AS ox, least(("row" + 1) * (16 / {SIDE}.0::DOUBLE), oy.i + 1) - greatest("row" * (16 / {SIDE}.0::DOUBLE), oy.i) AS wy, least((col + 1) * ((9 + scene_ord) / {SIDE}.0::DOUBLE), ox.i + 1) - greatest(col * ((9 + scene_ord) / {SIDE}.0::DOUBLE), ox.i) AS wx
 FROM p, range(16) oy(i), range(17) ox(i) WHERE oy.i < ("row" + 1) * (16 / {SIDE}.0::DOUBLE) AND oy.i + 1 > "row" * (16 / {SIDE}.0::DOUBLE) AND ox.i < 9 + scene_ord AND ox.i < (col + 1) * ((9 + scene_ord) / {SIDE}.0::DOUBLE) AND ox.i + 1 > col * ((9 + scene_ord) / {SIDE}.0::DOUBLE))
SELECT 's' || scene_ord AS name, CAST(oy AS INT) AS "row", CAST(ox AS INT) AS col, round(sum(wy * wx * v) / sum(wy * wx), 6) AS v FROM e WHERE wy > 0 AND wx > 0 GROUP BY 1, 2, 3"""
BILINEAR_SQL = f'WITH t AS (SELECT *, sx - 0.5::DOUBLE AS u, sy - 0.5::DOUBLE AS v FROM {NEAREST}), n AS (SELECT tr, tc, floor(v) + i AS r, floor(u) + j AS c, (CASE WHEN i = 1 THEN v - floor(v) ELSE 1 - (v - floor(v)) END) * (CASE WHEN j = 1 THEN u - floor(u) ELSE 1 - (u - floor(u)) END) AS w FROM t, range(2) a(i), range(2) b(j)) SELECT CAST(tr AS INT) AS "row", CAST(tc AS INT) AS col, round(sum(w * p.v) / sum(w), 6) AS value FROM n JOIN ({VALUES_SQL}) p ON p.r = n.r AND p.c = n.c AND w > {warp.LEAST_WEIGHT} GROUP BY 1, 2'
_EDGES = "SELECT k, crs, unnest([minx + (maxx - minx) * f, minx + (maxx - minx) * f, minx, maxx]) AS x, unnest([miny, maxy, miny + (maxy - miny) * f, miny + (maxy - miny) * f]) AS y FROM b, (SELECT i / 20.0::DOUBLE AS f FROM range(21) r(i))"
REPROJECTED_SQL = f"""WITH s AS (SELECT c_custkey AS k, 44.0::DOUBLE + (c_custkey % 90)::DOUBLE / 50.0::DOUBLE AS lon, 38.0::DOUBLE + (c_nationkey % 25)::DOUBLE / 10.0::DOUBLE AS lat FROM customer),
b AS (SELECT k, CASE k % 3 WHEN 0 THEN 'EPSG:4326' WHEN 1 THEN 'EPSG:32637' ELSE 'EPSG:32638' END AS crs, minx, miny, minx + CASE WHEN k % 3 = 0 THEN 0.05::DOUBLE ELSE 5000.0::DOUBLE END AS maxx, miny + CASE WHEN k % 3 = 0 THEN 0.05::DOUBLE ELSE 5000.0::DOUBLE END AS maxy FROM (
 SELECT k, CASE k % 3 WHEN 0 THEN lon WHEN 1 THEN x ELSE (k % 100)::DOUBLE END AS minx, CASE k % 3 WHEN 0 THEN lat WHEN 1 THEN y ELSE (k % 70)::DOUBLE END AS miny FROM ({geodesic_sql("forward", "s", "lon", "lat", "37")}))),
e AS ({_EDGES}), back AS ({geodesic_sql("inverse", "e", "x", "y", "37")}),
geo AS (SELECT k, crs, x AS x0, y AS y0, CASE WHEN crs = 'EPSG:4326' THEN x ELSE u END AS lon, CASE WHEN crs = 'EPSG:4326' THEN y ELSE v END AS lat FROM back),
out AS ({geodesic_sql("forward", "geo", "lon", "lat", "38")})
SELECT k, round(min(px), 3) AS minx, round(min(py), 3) AS miny, round(max(px), 3) AS maxx, round(max(py), 3) AS maxy FROM (SELECT k, CASE WHEN crs = 'EPSG:32638' THEN x0 ELSE x END AS px, CASE WHEN crs = 'EPSG:32638' THEN y0 ELSE y END AS py FROM out) GROUP BY 1"""
BOUNDS_SQL = f"""WITH s AS (SELECT scene, west, abs(south) AS south FROM v_config), b AS (SELECT scene AS k, '' AS crs, west AS minx, south AS miny, west + 0.5::DOUBLE AS maxx, south + 0.25::DOUBLE AS maxy, floor(((west + (west + 0.5::DOUBLE)) / 2.0::DOUBLE + 180.0::DOUBLE) / 6.0::DOUBLE) + 1 AS zone FROM s),
e AS (SELECT k, zone, x AS lon, y AS lat FROM ({_EDGES.replace("SELECT k, crs", "SELECT k, zone")})), out AS ({geodesic_sql("forward", "e", "lon", "lat", "zone")})
SELECT k AS scene, CAST(zone AS INT) AS zone, round(min(x), 2) AS minx, round(min(y), 2) AS miny, round(max(x), 2) AS maxx, round(max(y), 2) AS maxy FROM out GROUP BY 1, 2"""
_OFFSETS = "[" + ", ".join(f"'{k}'" for k in fc.OFFSETS) + "]", "[" + ", ".join(f"{float(x)}::DOUBLE" for x, _ in fc.OFFSETS.values()) + "]"
FINAL_SQL = f"""WITH cfg AS (SELECT scene AS n, 'scene' || scene AS scene, overlap, west, CASE WHEN scene % 3 = 0 THEN list_prepend('C', list_filter([upper(x) for x in directions], lambda x, i: list_position([upper(x) for x in directions], x) = i)) END AS dirs FROM v_config),
files AS (SELECT DISTINCT 'scene' || o_custkey AS scene, '/exports' || (o_orderkey % 2) || '/scene' || o_custkey || '{finalise.EXPORT}' AS stem, ['.tif', '.tiff', '-0001.tif', '-0002.tif', '.tif.part'][CAST(o_orderkey % 5 + 1 AS INT)] AS ending FROM orders),
found AS (SELECT scene, count(*) FILTER (ending IN ('.tif', '.tiff')) AS n_exact, count(*) AS n_pattern, min(stem || ending) FILTER (ending IN ('.tif', '.tiff')) AS e, min(stem || ending) AS p FROM files WHERE ending <> '.tif.part' GROUP BY 1),
j AS (SELECT cfg.*, coalesce(n_exact, 0) AS n_exact, coalesce(n_pattern, 0) AS n_pattern, CASE WHEN n_exact = 1 THEN e WHEN n_exact = 0 AND n_pattern = 1 THEN p END AS path FROM cfg LEFT JOIN found USING (scene)),
s AS (SELECT *, CASE WHEN n % 11 = 0 THEN 'missing scene folder: ' || scene WHEN n_exact > 1 THEN 'several exact exports (' || n_exact || ')' WHEN path IS NULL THEN 'expected one export, found ' || n_pattern WHEN n % 7 = 0 THEN 'no template: ' || scene END AS error FROM j)
SELECT scene, CASE WHEN error IS NULL THEN 'OK' ELSE 'FAILED' END AS status, CASE WHEN error IS NULL THEN path END AS drive_export, CASE WHEN error IS NULL THEN '/out/' || scene || '/{finalise.RAW}' END AS raw_path, CASE WHEN error IS NULL THEN '/out/' || scene || '/{finalise.CENTRE}' END AS center_reference,
 CASE WHEN error IS NULL THEN CAST(coalesce(len(dirs), 1) AS INT) END AS reference_candidates, error, CASE WHEN error IS NULL THEN array_to_string(list_filter(dirs, lambda x: x <> 'C'), ',') END AS directions,
 CASE WHEN error IS NULL THEN west + {_OFFSETS[1]}[list_position({_OFFSETS[0]}, dirs[-1])] * (2.0::DOUBLE * (1.0::DOUBLE - overlap)) END AS last_left FROM s"""

_KNOWN = "[" + ", ".join(f"'{k}'" for k in fc.OFFSETS) + "]"
CHECKED_SQL = f"""WITH e AS (SELECT scene, CASE WHEN scene % 13 = 0 THEN 1.5 WHEN scene % 13 = 1 THEN NULL ELSE overlap END AS overlap, CASE WHEN scene % 5 > 0 THEN CASE WHEN scene % 17 = 0 THEN ['UP', 'N'] ELSE [upper(x) for x in directions] END END AS up FROM v_config),
s AS (SELECT scene, overlap, up, CASE WHEN scene % 19 = 0 THEN 'unknown fields: range' WHEN overlap IS NULL OR overlap >= 1 THEN 'overlap is no number in [0, 1)' WHEN list_contains(up, 'UP') THEN 'unknown directions: UP' END AS error FROM e)
SELECT scene, CASE WHEN error IS NULL THEN overlap::DOUBLE END AS overlap, CASE WHEN error IS NULL THEN array_to_string(list_prepend('C', CASE WHEN up IS NULL THEN {_KNOWN}[2:] ELSE list_filter(up, lambda x, i: list_position(up, x) = i AND x <> 'C') END), ',') END AS directions, error FROM s"""
BANDS_SQL = f"""WITH p AS (SELECT scene, ord, b AS band, 10.0::DOUBLE * x0 + 700000.0::DOUBLE AS x, -10.0::DOUBLE * y0 + 4500000.0::DOUBLE AS y, 10.0::DOUBLE * x1 + 700000.0::DOUBLE AS mx, -10.0::DOUBLE * y1 + 4500000.0::DOUBLE AS my FROM v_matches CROSS JOIN (VALUES ('R'), ('N')) v(b)),
back AS ({geodesic_sql("inverse", "p", "x", "y", "37")}), geo AS (SELECT scene, ord, band, x AS x0, y AS y0, mx, my, u AS lon, v AS lat FROM back), out AS ({geodesic_sql("forward", "geo", "lon", "lat", "38")})
SELECT scene, band, ord, round((CASE band WHEN 'N' THEN x - 190000.0::DOUBLE ELSE x0 - 699900.0::DOUBLE END) / 10.0::DOUBLE, 4) AS sx, round(((CASE band WHEN 'N' THEN y ELSE y0 END) - 4500100.0::DOUBLE) / -10.0::DOUBLE, 4) AS sy, round(mx, 4) AS mx, round(my, 4) AS my FROM out"""

QUERIES = {
    "q_checked_settings": (checked, sql(CHECKED_SQL, "v_config")),
    "q_band_control_points": (points_of_bands, sql(BANDS_SQL, "v_matches")),
    "q_scene_slices": (slices, "WITH n AS (SELECT scene, row_number() OVER (ORDER BY scene) - 1 AS p, count(*) OVER () AS n FROM (SELECT DISTINCT c_name AS scene FROM customer)) SELECT scene, '100:' AS slice FROM n WHERE p >= 100 UNION ALL SELECT scene, '-50:-20' FROM n WHERE p >= greatest(n - 50, 0) AND p < n - 20"),
    "q_pixels_from_files": (from_files, sql("SELECT 's' || scene_ord || '/image.tif' AS name, \"row\", col, max(value) AS r, min(value) AS g, count(*)::DOUBLE AS b FROM v_pixels WHERE \"row\" >= 3 AND \"row\" < 60 AND col >= 7 AND col < 51 GROUP BY 1, 2, 3", "v_pixels")),
    "q_file_headers": (headers, sql(f"SELECT DISTINCT 's' || scene_ord || '/image.tif' AS name, {SIDE} AS width, 40 + scene_ord AS height, 2 AS bands, {SOURCE['a']}::DOUBLE AS a, {SOURCE['c']}::DOUBLE AS c, {SOURCE['e']}::DOUBLE AS e, {SOURCE['f']}::DOUBLE AS f, -9.0::DOUBLE AS nodata, 'EPSG:32638' AS crs FROM v_pixels", "v_pixels")),
    "q_warp_bilinear": (lambda s, sf: warped(s, sf, "bilinear"), sql(BILINEAR_SQL, "v_pixels")),
    "q_warp_spline": (spline_pixels, None),
    "q_preview_kernel": (smaller, sql(RESIZED_SQL, "v_pixels")),
    "q_preview_means": (means, sql(MEANS_SQL, "v_pixels")),
    "q_reprojected": (reprojected, REPROJECTED_SQL),
    "q_utm_bounds": (lambda s, sf: grid.utm_bounds(boxes(s, sf), "scene").select("scene", "zone", *[F.round(k, 2).alias(k) for k in ("minx", "miny", "maxx", "maxy")]), sql(BOUNDS_SQL, "v_config")),
    "q_finalised": (finalising, sql(FINAL_SQL, "v_config")),
}
