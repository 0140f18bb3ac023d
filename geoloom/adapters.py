"""The driver's star-schema tables as the domain's tables. Integer arithmetic throughout, so that any SQL engine gets the same values.

Each adapter is a Spark function and, under the same name in SQL, the text of a common table expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Side of the square image that match points lie in.
IMAGE = 4000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def v_matches(spark: SparkSession, d: str) -> DataFrame:
    """Point pairs with confidence: scene, ord, x0, y0 (moving), x1, y1 (reference), conf."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    forty, ten = F.lit(40).cast("double"), F.lit(10).cast("double")
    x0 = (F.col("o_orderkey") * 7919 % 163840).cast("double") / forty
    y0 = (F.col("o_orderkey") * 104729 % 163840).cast("double") / forty
    return o.select(
        (F.col("o_custkey") % 8).alias("scene"), F.col("o_orderkey").alias("ord"), x0.alias("x0"), y0.alias("y0"),
        (x0 + (F.col("o_custkey") % 41 - 20).cast("double") / ten).alias("x1"), (y0 + (F.col("o_orderkey") % 31 - 15).cast("double") / ten).alias("y1"),
        ((F.col("o_orderkey") * 31 % 1000).cast("double") / F.lit(1000).cast("double")).alias("conf"),
    )


def v_scenes(spark: SparkSession, d: str) -> DataFrame:
    """Scene footprints: scene_id, ord, acq_day, minx, miny, maxx, maxy."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    day = F.date_format("o_orderdate", "yyyyMMdd")
    minx, miny = (F.col("o_custkey") * 137 % 400 * 250).cast("double"), (F.col("o_orderkey") * 17 % 400 * 250).cast("double")
    return o.select(F.concat(day, F.lit("T"), F.lpad((F.col("o_orderkey") % 86400).cast("string"), 6, "0"), F.lit("_"), F.col("o_orderkey").cast("string")).alias("scene_id"), F.col("o_orderkey").alias("ord"), day.alias("acq_day"), minx.alias("minx"), miny.alias("miny"), (minx + 5000).alias("maxx"), (miny + 5000).alias("maxy"))


def v_pixels(spark: SparkSession, d: str) -> DataFrame:
    """Observed pixels: row, col (0 to 63), acq_day, scene_ord, value, valid."""
    t = table(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_shipdate", "l_quantity", "l_returnflag")
    return t.select((F.col("l_partkey") % 64).cast("int").alias("row"), (F.col("l_suppkey") % 64).cast("int").alias("col"), F.date_format("l_shipdate", "yyyyMMdd").alias("acq_day"), (F.col("l_orderkey") % 8).cast("int").alias("scene_ord"), F.col("l_quantity").alias("value"), (F.col("l_returnflag") != "N").alias("valid"))


def v_rgb(spark: SparkSession, d: str) -> DataFrame:
    """RGB pixels of many images: scene, row, r, g, b, valid."""
    t = table(spark, d, "lineitem").select("l_suppkey", "l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_returnflag")
    return t.select((F.col("l_suppkey") % 16).alias("scene"), F.col("l_orderkey").alias("row"), F.col("l_quantity").alias("r"), F.col("l_extendedprice").alias("g"), (F.col("l_discount") * 1000).alias("b"), (F.col("l_returnflag") != "R").alias("valid"))


def v_preds(spark: SparkSession, d: str) -> DataFrame:
    """Logits of four classes by tile: path, dataset, scene, tile_name, ord, logits."""
    e = table(spark, d, "embeddings").select("vec_id", "label", F.slice("embedding", 1, 4).cast("array<double>").alias("logits"))
    dataset, scene = F.concat(F.lit("ds"), (F.col("label") % 2).cast("string")), F.concat(F.lit("s"), F.col("label").cast("string"))
    name = F.concat(F.lit("t"), F.col("vec_id").cast("string"))
    return e.select(F.concat_ws("/", F.lit("/tiles"), dataset, scene, F.concat(name, F.lit(".tif"))).alias("path"), F.col("vec_id").alias("ord"), "logits")


def v_reports(spark: SparkSession, d: str) -> DataFrame:
    """Job report rows: file, pos, scene (empty for some), status."""
    c = table(spark, d, "conversations").select("conv_id", "turn", "role")
    return c.select(F.col("turn").alias("file"), F.col("conv_id").alias("pos"), F.when(F.col("conv_id") % 7 != 0, F.concat(F.lit("s"), (F.col("conv_id") % 50).cast("string"))).alias("scene"), F.col("role").alias("status"))


def v_files(spark: SparkSession, d: str) -> DataFrame:
    """Band files: path, named by start and end of the acquisition."""
    e = table(spark, d, "events").select("event_id", "ts", "user_id", "event_type")
    stem = F.concat(F.date_format("ts", "yyyyMMdd'T'HHmmss"), F.lit("_"), F.date_format(F.col("ts") + F.expr("interval 2 seconds"), "yyyyMMdd'T'HHmmss"), F.lit("_SAT_"), (F.col("user_id") % 5).cast("string"))
    band = F.element_at(F.array(*map(F.lit, "BGNR")), (F.col("event_id") % 4 + 1).cast("int"))
    suffix = F.when(F.col("event_id") % 11 == 0, ".tiff").otherwise(".tif")
    return e.select(F.concat(F.lit("/data/root"), (F.col("user_id") % 3).cast("string"), F.lit("/"), stem, F.when(F.col("event_type") == "error", "_1QK_").otherwise("_"), band, suffix).alias("path"))


def v_lines(spark: SparkSession, d: str) -> DataFrame:
    """Lines of scene lists: file, pos, line."""
    t = table(spark, d, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return t.select(F.col("doc_id").alias("file"), "pos", F.when(F.col("pos") % 3 == 0, F.concat(F.lit("# "), "line")).otherwise(F.concat(F.lit("  dir/"), F.col("line"), F.lit("/ "))).alias("line"))


def v_config(spark: SparkSession, d: str) -> DataFrame:
    """Neighbour settings by scene: scene, overlap, directions (lower case, repeated), and the scene's box in degrees."""
    c = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    names = F.array(*map(F.lit, ("n", "NE", "e", "SE", "s", "SW", "w", "NW")))
    picked = F.transform(F.sequence(F.lit(0), F.col("c_nationkey") % 5), lambda i: F.element_at(names, ((F.col("c_custkey") * 3 + i * 5) % 8 + 1).cast("int")))
    return c.select(F.col("c_custkey").alias("scene"), ((F.col("c_custkey") % 4).cast("double") * F.lit(0.25).cast("double")).alias("overlap"), picked.alias("directions"), (F.col("c_custkey") % 360 - 180).cast("double").alias("west"), (F.col("c_nationkey") % 120 - 60).cast("double").alias("south"))


SQL = {
    "v_matches": f"""v_matches AS (SELECT o_custkey % 8 AS scene, o_orderkey AS ord, x0, y0, x0 + CAST(o_custkey % 41 - 20 AS DOUBLE) / CAST(10 AS DOUBLE) AS x1,
  y0 + CAST(o_orderkey % 31 - 15 AS DOUBLE) / CAST(10 AS DOUBLE) AS y1, CAST(o_orderkey * 31 % 1000 AS DOUBLE) / CAST(1000 AS DOUBLE) AS conf
  FROM (SELECT *, CAST(o_orderkey * 7919 % 163840 AS DOUBLE) / CAST(40 AS DOUBLE) AS x0, CAST(o_orderkey * 104729 % 163840 AS DOUBLE) / CAST(40 AS DOUBLE) AS y0 FROM orders))""",
    "v_scenes": """v_scenes AS (SELECT strftime(o_orderdate, '%Y%m%d') || 'T' || lpad(CAST(o_orderkey % 86400 AS VARCHAR), 6, '0') || '_' || CAST(o_orderkey AS VARCHAR) AS scene_id, o_orderkey AS ord,
  strftime(o_orderdate, '%Y%m%d') AS acq_day, CAST(o_custkey * 137 % 400 * 250 AS DOUBLE) AS minx, CAST(o_orderkey * 17 % 400 * 250 AS DOUBLE) AS miny,
  CAST(o_custkey * 137 % 400 * 250 AS DOUBLE) + 5000 AS maxx, CAST(o_orderkey * 17 % 400 * 250 AS DOUBLE) + 5000 AS maxy FROM orders)""",
    "v_pixels": """v_pixels AS (SELECT CAST(l_partkey % 64 AS INT) AS "row", CAST(l_suppkey % 64 AS INT) AS col, strftime(l_shipdate, '%Y%m%d') AS acq_day,
  CAST(l_orderkey % 8 AS INT) AS scene_ord, l_quantity AS value, l_returnflag <> 'N' AS valid FROM lineitem)""",
    "v_rgb": """v_rgb AS (SELECT l_suppkey % 16 AS scene, l_orderkey AS "row", l_quantity AS r, l_extendedprice AS g, l_discount * 1000 AS b, l_returnflag <> 'R' AS valid FROM lineitem)""",
    "v_preds": """v_preds AS (SELECT '/tiles/ds' || CAST(label % 2 AS VARCHAR) || '/s' || CAST(label AS VARCHAR) || '/t' || CAST(vec_id AS VARCHAR) || '.tif' AS path, vec_id AS ord,
  'ds' || CAST(label % 2 AS VARCHAR) AS dataset, 's' || CAST(label AS VARCHAR) AS scene, 't' || CAST(vec_id AS VARCHAR) AS tile_name, CAST(embedding[1:4] AS DOUBLE[]) AS logits FROM embeddings)""",
    "v_reports": """v_reports AS (SELECT turn AS file, conv_id AS pos, CASE WHEN conv_id % 7 <> 0 THEN 's' || CAST(conv_id % 50 AS VARCHAR) END AS scene, role AS status FROM conversations)""",
    "v_files": """v_files AS (SELECT '/data/root' || CAST(user_id % 3 AS VARCHAR) || '/' || strftime(ts, '%Y%m%dT%H%M%S') || '_' || strftime(ts + INTERVAL 2 SECOND, '%Y%m%dT%H%M%S') || '_SAT_' || CAST(user_id % 5 AS VARCHAR)
  || CASE WHEN event_type = 'error' THEN '_1QK_' ELSE '_' END || ['B', 'G', 'N', 'R'][CAST(event_id % 4 + 1 AS INT)] || CASE WHEN event_id % 11 = 0 THEN '.tiff' ELSE '.tif' END AS path FROM events)""",
    "v_lines": """v_lines AS (SELECT doc_id AS file, pos, CASE WHEN pos % 3 = 0 THEN '# ' || raw ELSE '  dir/' || raw || '/ ' END AS line
  FROM (SELECT doc_id, CAST(unnest(range(len(string_split(text, chr(10))))) AS INT) AS pos, unnest(string_split(text, chr(10))) AS raw FROM documents))""",
    "v_config": """v_config AS (SELECT c_custkey AS scene, CAST(c_custkey % 4 AS DOUBLE) * CAST(0.25 AS DOUBLE) AS overlap,
  list_transform(range(0, c_nationkey % 5 + 1), lambda i: ['n', 'NE', 'e', 'SE', 's', 'SW', 'w', 'NW'][CAST((c_custkey * 3 + i * 5) % 8 + 1 AS INT)]) AS directions,
  CAST(c_custkey % 360 - 180 AS DOUBLE) AS west, CAST(c_nationkey % 120 - 60 AS DOUBLE) AS south FROM customer)""",
}


def sql(query: str, *names: str) -> str:
    """A DuckDB query over adapters."""
    body = query.strip()
    first = ", ".join(SQL[n] for n in names)
    return f"WITH {first}, {body[5:]}" if body[:5].upper() == "WITH " else f"WITH {first} {body}"
