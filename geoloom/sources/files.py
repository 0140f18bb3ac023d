"""Sources: file listings, text lists, match and configuration documents, and raster headers."""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from geoloom.functions.columns import c

MATCHES = "scene string, pts_mov_on_ref array<array<double>>, pts_ref array<array<double>>, confidence array<double>"
HEADER = "path string, width int, height int, bands int, a double, b double, c double, d double, e double, f double, nodata double, crs string, scales array<double>, offsets array<double>"
CONFIG = "map<string,struct<overlap:double,directions:array<string>>>"


def listing(spark: SparkSession, path: str, pattern: str = "*.{tif,tiff,TIF,TIFF}") -> DataFrame:
    """Paths and sizes of files below a folder; contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(path).select("path", "length")


def lines(spark: SparkSession, path: str) -> DataFrame:
    """file, pos, line of text files; a file is read whole, so that its lines keep their places."""
    t = spark.read.option("wholetext", "true").text(path).select(c("_metadata.file_path").alias("file"), "value")
    return t.select("file", F.posexplode(F.split("value", "\n", -1)).alias("pos", "line"))


def matches(spark: SparkSession, path: str) -> DataFrame:
    """scene, ord, x0, y0, x1, y1, conf from match documents; without confidences all are 1, lists of different lengths are an error."""
    m = spark.read.schema(MATCHES).option("multiLine", "true").json(path)
    n = F.size("pts_mov_on_ref")
    conf = F.when(F.coalesce(F.size("confidence"), F.lit(0)) <= 0, F.array_repeat(F.lit(1.0), n)).otherwise(c("confidence"))
    same = (n == F.size("pts_ref")) & (n == F.size(conf))
    pairs = F.when(same, F.arrays_zip(c("pts_mov_on_ref").alias("a"), c("pts_ref").alias("b"), conf.alias("c"))).otherwise(F.raise_error(F.lit("lists of different lengths")).cast("array<struct<a:array<double>,b:array<double>,c:double>>"))
    e = m.select("scene", F.posexplode(pairs).alias("ord", "p"))
    return e.select("scene", c("ord").cast("long").alias("ord"), *[F.get(c(f"p.{k}"), F.lit(i)).alias(n) for k, i, n in (("a", 0, "x0"), ("a", 1, "y0"), ("b", 0, "x1"), ("b", 1, "y1"))], c("p.c").alias("conf"))


def configuration(spark: SparkSession, path: str) -> DataFrame:
    """scene, overlap, directions from a JSON object keyed by scene."""
    t = spark.read.option("wholetext", "true").text(path).select(F.from_json("value", CONFIG).alias("m"))
    return t.select(F.explode("m").alias("scene", "s")).select("scene", "s.*")


def opened(path: str):
    """A file for random access, on this machine or any store that Arrow knows; paths are taken as Spark lists them, without escapes."""
    from pyarrow import fs

    m = re.match(r"(?!file:)([a-z0-9]+)://([^/]*)/(.*)", path, re.S)
    if not m:
        return fs.LocalFileSystem().open_input_file(re.sub(r"^file:(//)?", "", path))
    store, top = fs.FileSystem.from_uri(f"{re.sub('^s3[an]$', 's3', m[1])}://{m[2]}/")
    return store.open_input_file(f"{top.rstrip('/')}/{m[3]}")


def headers(files: DataFrame, errors: bool = False) -> DataFrame:
    """One row a file (path), as raster_header: headers are read where the rows are, so the list may be of any length. Only the first directory of each file is read. errors: a file that can't be read has a row, too, of nulls and a text in the column `error`; else it ends the job."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), *[pa.int32()] * 3, *[pa.float64()] * 7, pa.string(), *[pa.list_(pa.float64())] * 2]
        names = [x.split()[0] for x in HEADER.split(", ")]
        for b in batches:
            rows, texts = [], []
            for path in b.column(0).to_pylist():
                try:
                    with opened(path) as f:
                        rows.append((path, *header(f)))
                    texts.append(None)
                except (OSError, ValueError, KeyError, IndexError, struct.error) as e:
                    if not errors:
                        raise
                    rows.append((path, *[None] * (len(kinds) - 1)))
                    texts.append(f"{type(e).__name__}: {e}")
            more = ([pa.array(texts, pa.string())], ["error"]) if errors else ([], [])
            yield pa.RecordBatch.from_arrays([*[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], *more[0]], names=names + more[1])

    return files.select("path").where("path is not null").mapInArrow(run, HEADER + (", error string" if errors else ""))


class Header(InputPartition):
    def __init__(self, paths: list[str]) -> None:
        self.paths = paths


class HeaderReader(DataSourceReader):
    """Size, place, reference system, missing value and scales of TIFF files, from their first directory only."""

    def __init__(self, options: dict[str, str]) -> None:
        self.paths = [p for p in options.get("paths", "").split("\n") if p]
        self.parts = max(1, int(options.get("partitions", "8")))

    def partitions(self) -> list[Header]:
        return [Header(self.paths[i :: self.parts]) for i in range(self.parts) if self.paths[i :: self.parts]]

    def read(self, part: Header) -> Iterator[tuple]:
        for path in part.paths:
            with opened(path) as f:
                yield (path, *header(f))


class HeaderSource(DataSource):
    """spark.read.format("raster_header").option("paths", lines).load(): one row a file of a short list; headers() takes a table of paths."""

    @classmethod
    def name(cls) -> str:
        return "raster_header"

    def schema(self) -> str:
        return HEADER

    def reader(self, schema) -> HeaderReader:
        return HeaderReader(self.options)


def directory(f, wanted: tuple[int, ...] | None = None) -> dict[int, tuple | bytes]:
    """Values of the wanted tags (those of a header) of a TIFF file's first directory, of 32-bit or 64-bit offsets; 0 has the byte order."""
    order = {b"II": "<", b"MM": ">"}.get(f.read(2))
    magic = struct.unpack(order + "H", f.read(2))[0] if order else 0
    if magic not in (42, 43):
        raise ValueError("not a TIFF file")
    place, count = ("I", "H") if magic == 42 else ("Q", "Q")
    room = struct.calcsize("<" + place)
    if magic == 43:
        f.read(4)

    def number(kind: str) -> int:
        return struct.unpack(order + kind, f.read(struct.calcsize("<" + kind)))[0]

    f.seek(number(place))
    entry = f"{order}HH{place}{room}s"
    entries = [struct.unpack(entry, f.read(struct.calcsize(entry))) for _ in range(number(count))]
    kinds = {1: "B", 2: "c", 3: "H", 4: "I", 5: "II", 12: "d", 16: "Q"}
    got: dict[int, tuple | bytes] = {0: order.encode()}
    for tag, kind, n, raw in entries:
        if tag in (wanted or TAGS) and kind in kinds:
            size = struct.calcsize("<" + kinds[kind]) * n
            if size > room:
                f.seek(struct.unpack(order + place, raw)[0])
                raw = f.read(size)
            got[tag] = raw[:size] if kind == 2 else struct.unpack(order + kinds[kind] * n, raw[:size])
    return got


#: Fixed values of the format: size, samples, pixel scale, tie point, transformation, keys of the reference system and their text, metadata, missing value.
TAGS = (256, 257, 277, 33550, 33922, 34264, 34735, 34737, 42112, 42113)
RASTER_TYPE, GEOGRAPHIC, PROJECTED, OWN = 1025, 2048, 3072, 32767


def by_band(metadata: str, role: str, bands: int, default: float) -> list[float]:
    """The values of a role (scale or offset) by band."""
    out = [default] * bands
    for attributes, value in re.findall(r"<Item\s([^>]*)>([^<]*)</Item>", metadata):
        own = dict(re.findall(r'(\w+)="([^"]*)"', attributes))
        if own.get("role") == role and int(own.get("sample", 0)) < bands:
            out[int(own.get("sample", 0))] = float(value)
    return out


def header(f) -> tuple:
    """Width, height, bands, six affine coefficients, missing value, reference system (EPSG:number, the text of one without a number, or null), scales and offsets of an open TIFF file."""
    return placed(directory(f))


def placed(got: dict[int, tuple | bytes]) -> tuple:
    """What header() gives, from the tags."""
    listed = got.get(34735, ())
    keys = {listed[i]: listed[i + 3] for i in range(4, len(listed) - 3, 4) if listed[i + 1] == 0}
    code = keys.get(PROJECTED) or keys.get(GEOGRAPHIC) or 0
    text = lambda tag: bytes(b"".join(got[tag]) if isinstance(got.get(tag), tuple) else got.get(tag, b"")).split(b"\0")[0].decode("utf-8", "replace").strip()
    crs = f"EPSG:{code}" if 0 < code < OWN else (text(34737) or "user-defined") if listed else None
    if 34264 in got:
        m = got[34264]
        a, b, c0, d0, e, f0 = m[0], m[1], m[3], m[4], m[5], m[7]
    else:
        scale, tie = got.get(33550, (1.0, 1.0, 0.0)), got.get(33922, (0.0,) * 6)
        a, b, c0, d0, e, f0 = scale[0], 0.0, tie[3] - tie[0] * scale[0], 0.0, -scale[1], tie[4] + tie[1] * scale[1]
    if keys.get(RASTER_TYPE) == 2:  # the place is that of a pixel's middle
        c0, f0 = c0 - (a + b) / 2, f0 - (d0 + e) / 2
    bands = got.get(277, (1,))[0]
    nodata = float(text(42113) or "nan") if 42113 in got else None
    return got[256][0], got[257][0], bands, a, b, c0, d0, e, f0, nodata, crs, by_band(text(42112), "scale", bands, 1.0), by_band(text(42112), "offset", bands, 0.0)
