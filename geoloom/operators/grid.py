"""Space: blocks and their scenes, tile windows, neighbour directions and boxes, control points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import geodesy
from geoloom.functions.columns import OFFSETS, align_down, align_up, apply_affine, c, d, invert_affine, raster_side, utm_zone
from geoloom.functions.geodesy import LONLAT, NORTH_ZONES, SOUTH_ZONES


def axis_starts(length: Column, tile: int, overlap: int) -> Column:
    """Starts of windows along an axis; the last one ends at the axis' end."""
    last = F.greatest(length - tile, F.lit(0)).cast("int")
    return F.array_distinct(F.concat(F.sequence(F.lit(0), last, F.lit(tile - overlap)), F.array(last)))


def tiles(images: DataFrame, tile: int, overlap: int) -> DataFrame:
    """Windows y0, y1, x0, x1 of images with h and w."""
    t = images.withColumn("y0", F.explode(axis_starts(c("h"), tile, overlap))).withColumn("x0", F.explode(axis_starts(c("w"), tile, overlap)))
    return t.withColumn("y1", F.least(c("y0") + tile, c("h"))).withColumn("x1", F.least(c("x0") + tile, c("w")))


def ragged_tiles(images: DataFrame, tile: int, overlap: int) -> DataFrame:
    """Windows at every step, cut at the border; `full` tells those of full shape."""
    step = tile - overlap
    t = images.withColumn("y0", F.explode(F.sequence(F.lit(0), c("h") - 1, F.lit(step)))).withColumn("x0", F.explode(F.sequence(F.lit(0), c("w") - 1, F.lit(step))))
    t = t.withColumn("th", F.least(F.lit(tile), c("h") - c("y0"))).withColumn("tw", F.least(F.lit(tile), c("w") - c("x0")))
    return t.withColumn("full", (c("th") == tile) & (c("tw") == tile))


def total_bounds(scenes: DataFrame, step: float) -> DataFrame:
    """The scenes' common box, aligned outward to the step."""
    b = scenes.agg(F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))
    return b.select(align_down(c("minx"), step).alias("minx"), align_down(c("miny"), step).alias("miny"), align_up(c("maxx"), step).alias("maxx"), align_up(c("maxy"), step).alias("maxy"))


def blocks(scenes: DataFrame, step: float, margin: float) -> DataFrame:
    """Blocks over the scenes, numbered from the lower left, row by row: number, id, core and expanded box."""
    b = total_bounds(scenes, step)
    nx, ny = ((c(hi) - c(lo)) / d(step) for lo, hi in (("minx", "maxx"), ("miny", "maxy")))
    b = b.where("minx is not null").select("*", nx.cast("int").alias("nx"), F.explode(F.sequence(F.lit(0), ny.cast("int") - 1)).alias("by"))
    b = b.select("*", F.explode(F.sequence(F.lit(0), c("nx") - 1)).alias("bx"))
    x, y = c("minx") + c("bx") * d(step), c("miny") + c("by") * d(step)
    b = b.select((c("by") * c("nx") + c("bx") + 1).alias("number"), "bx", "by", x.alias("core_minx"), y.alias("core_miny"), (x + d(step)).alias("core_maxx"), (y + d(step)).alias("core_maxy"), c("minx").alias("origin_x"), c("miny").alias("origin_y"))
    wide = [(c(f"core_{n}") + d(margin if n.startswith("max") else -margin)).alias(f"expanded_{n}") for n in ("minx", "miny", "maxx", "maxy")]
    return b.select(F.format_string("BLK_%06d", "number").alias("block_id"), "*", *wide)


def block_scenes(block_table: DataFrame, scenes: DataFrame, step: float, margin: float) -> DataFrame:
    """Pairs of block and scene whose boxes touch. Scenes go to the blocks that their box widened by the margin may reach, so the join is on block indexes; the boxes are compared after it."""
    origin = block_table.limit(1).select("origin_x", "origin_y")

    def span(lo: str, hi: str, o: str) -> Column:
        return F.sequence(F.floor((c(lo) - d(margin) - c(o)) / d(step)).cast("int") - 1, F.floor((c(hi) + d(margin) - c(o)) / d(step)).cast("int"))

    first = origin.first()
    if first is None:
        return block_table.select("block_id").join(scenes, F.lit(False))
    s = scenes.withColumn("ox", d(first.origin_x)).withColumn("oy", d(first.origin_y))
    s = s.withColumn("bx", F.explode(span("minx", "maxx", "ox"))).withColumn("by", F.explode(span("miny", "maxy", "oy")))
    touch = (c("minx") <= c("expanded_maxx")) & (c("maxx") >= c("expanded_minx")) & (c("miny") <= c("expanded_maxy")) & (c("maxy") >= c("expanded_miny"))
    return s.join(block_table, ["bx", "by"]).where(touch).select("block_id", "scene_id", "acq_day")


def block_gate(pairs: DataFrame, least_dates: int) -> DataFrame:
    """Scenes and days of each block that has enough days."""
    return pairs.groupBy("block_id").agg(F.count(F.lit(1)).alias("n_scenes"), F.count_distinct("acq_day").alias("n_dates")).where(c("n_dates") >= least_dates)


def candidate_bounds(west: Column, north: Column, row: Column, col: Column, tile: int, res: float) -> dict[str, Column]:
    """Map box of a window of pixels."""
    w, n = west + col * d(res), north - row * d(res)
    return {"west": w, "south": n - d(tile * res), "east": w + d(tile * res), "north": n}


def inside(a: dict[str, Column], minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Whether a box lies in another, edges included."""
    return (a["west"] >= minx) & (a["south"] >= miny) & (a["east"] <= maxx) & (a["north"] <= maxy)


def raster_shape(minx: Column, miny: Column, maxx: Column, maxy: Column, res: float) -> tuple[Column, Column]:
    return raster_side(maxy - miny, res), raster_side(maxx - minx, res)


def clamped(y0: Column, y1: Column, x0: Column, x1: Column, h: Column, w: Column) -> tuple[Column, ...]:
    """A window cut to an image."""
    def cut(v: Column, most: Column) -> Column:
        return F.greatest(F.lit(0), F.least(v, most))

    return cut(y0, h), cut(y1, h), cut(x0, w), cut(x1, w)


def context_window(y0: Column, y1: Column, x0: Column, x1: Column, h: Column, w: Column, margin: int) -> tuple[Column, ...]:
    """A window with a margin around, cut to an image."""
    return clamped(y0 - margin, y1 + margin, x0 - margin, x1 + margin, h, w)


def predicted_window(corners: list[tuple[Column, Column]], margin: float, h: Column, w: Column) -> tuple[Column, ...]:
    """Whole-pixel window around mapped corners with a margin, cut to an image."""
    xs, ys = [x for x, _ in corners], [y for _, y in corners]
    return clamped(F.floor(F.least(*ys) - d(margin)), F.ceil(F.greatest(*ys) + d(margin)) + 1, F.floor(F.least(*xs) - d(margin)), F.ceil(F.greatest(*xs) + d(margin)) + 1, h, w)


def directions(listed: Column) -> Column:
    """Directions in upper case without repeats, the centre first; unknown ones fail."""
    up = F.array_distinct(F.transform(listed, F.upper))
    known = F.array(*map(F.lit, OFFSETS))
    ok = F.size(F.array_except(up, known)) == 0
    return F.when(ok, F.concat(F.array(F.lit("C")), F.array_remove(up, "C"))).otherwise(F.raise_error(F.concat(F.lit("unknown directions: "), F.array_join(F.array_except(up, known), ","))).cast("array<string>"))


def shifts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in OFFSETS.items()], "direction string, dx double, dy double")


def shifted_crops(config: DataFrame, side: float) -> DataFrame:
    """Crop box of every direction of every scene: the scene's box moved by all of its side but the overlap."""
    names, dx, dy = (F.array(*[F.lit(v) for v in x]) for x in (list(OFFSETS), [float(x) for x, _ in OFFSETS.values()], [float(y) for _, y in OFFSETS.values()]))
    e = config.select("scene", "overlap", "west", "south", F.posexplode(directions(c("directions"))).alias("pos", "direction"))
    at = F.array_position(names, c("direction")).cast("int")
    move = d(side) * (d(1) - c("overlap"))
    west, south = c("west") + F.element_at(dx, at) * move, c("south") + F.element_at(dy, at) * move
    return e.select("scene", "pos", "direction", west.alias("west"), south.alias("south"), (west + d(side)).alias("east"), (south + d(side)).alias("north"))


def download_box(config: DataFrame, side: float, buffer: float) -> DataFrame:
    """By scene: the box around all its crops, with a buffer."""
    s = shifted_crops(config, side).groupBy("scene").agg(F.min("west").alias("west"), F.min("south").alias("south"), F.max("east").alias("east"), F.max("north").alias("north"))
    return s.select("scene", *[(c(k) - d(buffer)).alias(k) for k in ("west", "south")], *[(c(k) + d(buffer)).alias(k) for k in ("east", "north")])


def moved_boxes(boxes: DataFrame, keys: list[str], corners: tuple[str, ...], move: geodesy.Move, a: Column, b: Column, points: int) -> DataFrame:
    """keys, minx, miny, maxx, maxy: the box around the moved edge points of all boxes of a key. Boxes are dealt by key before their points are worked out, as files of them may be few; points never leave the batch of their box."""
    names = ("minx", "miny", "maxx", "maxy")
    p = boxes.select(*keys, *[c(k).cast("double").alias(n) for k, n in zip(corners, names, strict=True)], a.alias("_a"), b.alias("_b")).repartition(keys[0])
    p = p.select(*keys, geodesy.edge_bounds(move, points)(*names, "_a", "_b").alias("_box")).select(*keys, "_box.*")
    return p.groupBy(*keys).agg(F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))


def utm_bounds(boxes: DataFrame, key: str, points: int = 21) -> DataFrame:
    """UTM box of each longitude-latitude box (west, south, east, north), from points along its edges; the zone is that of the middle."""
    b = boxes.withColumn("zone", utm_zone((c("west") + c("east")) / d(2)))
    return moved_boxes(b, [key, "zone"], ("west", "south", "east", "north"), geodesy.forward, c("zone"), F.lit(False), points)


def control_points(matches: DataFrame, template: dict[str, float], band: dict[str, float]) -> DataFrame:
    """Source pixel of a band and map place of each pair, by the template's and the band's affine coefficients (one common reference system)."""
    t, b = ({k: d(v) for k, v in x.items()} for x in (template, band))
    sx, sy = invert_affine(b, *apply_affine(t, c("x0"), c("y0")))
    mx, my = apply_affine(t, c("x1"), c("y1"))
    return matches.select("scene", "ord", sx.alias("sx"), sy.alias("sy"), mx.alias("mx"), my.alias("my"), "conf")


def utm_zones(code: Column) -> Column:
    return code.between(NORTH_ZONES + 1, NORTH_ZONES + 60) | code.between(SOUTH_ZONES + 1, SOUTH_ZONES + 60)


def between_systems(x: Column, y: Column, source: Column, target: Column) -> Column:
    """A place (x, y in a struct) of one system in another, both EPSG numbers by row; equal systems leave it as it is, unknown ones are an error."""
    known = lambda code: (code == LONLAT) | utm_zones(code)
    failed = F.raise_error(F.concat(F.lit("unknown reference system: "), source.cast("string"), F.lit(" or "), target.cast("string"))).cast("int")
    checked = F.when((source == target) | (known(source) & known(target)), source).otherwise(failed)
    return geodesy.places(geodesy.between_rows)(x, y, checked, target)


def band_control_points(matches: DataFrame, templates: DataFrame, bands: DataFrame) -> DataFrame:
    """scene, band, ord, sx, sy, mx, my, conf: each pair for every band of its scene, on the band's own grid and in its own system. templates: scene, a to f, epsg; bands: scene, band, a to f, epsg."""
    t = templates.select("scene", F.struct(*"abcdef", "epsg").alias("t"))
    b = bands.select("scene", "band", F.struct(*"abcdef", "epsg").alias("b"))
    j = matches.join(t, "scene").join(b, "scene")
    of = lambda k: {n: c(f"{k}.{n}") for n in "abcdef"}
    at = between_systems(*apply_affine(of("t"), c("x0"), c("y0")), c("t.epsg"), c("b.epsg"))
    j = j.withColumn("p", at)
    sx, sy = invert_affine(of("b"), c("p.x"), c("p.y"))
    mx, my = apply_affine(of("t"), c("x1"), c("y1"))
    return j.select("scene", "band", "ord", sx.alias("sx"), sy.alias("sy"), mx.alias("mx"), my.alias("my"), "conf")


def expand_box(west: Column, south: Column, east: Column, north: Column, by: float) -> tuple[Column, ...]:
    return west - d(by), south - d(by), east + d(by), north + d(by)


def wgs84_bounds(boxes: DataFrame, key: str, zone: Column, south: Column, points: int = 21) -> DataFrame:
    """Longitude-latitude box of each UTM box (minx, miny, maxx, maxy), from points along its edges; two boxes of one key count as one."""
    b = moved_boxes(boxes, [key], ("minx", "miny", "maxx", "maxy"), geodesy.inverse, zone, F.coalesce(south, F.lit(False)), points)
    return b.select(key, c("minx").alias("west"), c("miny").alias("south"), c("maxx").alias("east"), c("maxy").alias("north"))


def reprojected(boxes: DataFrame, key: str, target: str, points: int = 21) -> DataFrame:
    """key, minx, miny, maxx, maxy in the target reference system of each box of its own (crs, as EPSG:number), from points along its edges. Longitude-latitude (4326) and UTM zones are known, others are an error; boxes in the target's system stay as they are."""
    to = int(target.removeprefix("EPSG:"))
    if to != LONLAT and not NORTH_ZONES < to <= NORTH_ZONES + 60 and not SOUTH_ZONES < to <= SOUTH_ZONES + 60:
        raise ValueError(f"unknown reference system: {target}")
    code = F.regexp_extract("crs", r"^EPSG:(\d{1,9})$", 1).try_cast("int")
    known = F.when((c("crs") == target) | (code == LONLAT) | utm_zones(code), code).otherwise(F.raise_error(F.concat(F.lit("unknown reference system: "), c("crs"))).cast("int"))
    return moved_boxes(boxes, [key], ("minx", "miny", "maxx", "maxy"), geodesy.between_rows, known, F.lit(to), points)
