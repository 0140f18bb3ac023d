"""Raster sink: pixel rows to tiled TIFF files.

Tiles are encoded where Spark groups their pixels, then brought together by file. A file is written by one task under a name of its own;
the commit gives it its final name, and an aborted job, or a task that is tried again, leaves no file behind.
"""

from __future__ import annotations

import posixpath
import re
import tempfile
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from geoloom.functions.columns import c
from geoloom.sources import tiff

GRID = ("width", "height", "a", "b", "c", "d", "e", "f", "epsg", "nodata")
TILES = "name string, tile int, data binary, bands int, kind string, side int, width int, height int, a double, b double, c double, d double, e double, f double, epsg int, nodata double"


def tiles(pixels: DataFrame, grids: DataFrame, bands: tuple[str, ...], kind: str = "float32", side: int = 256) -> DataFrame:
    """A row a tile with pixels, encoded: pixels (name, row, col, bands; a missing pixel or null is the missing value, or 0), grids (name, width, height, affine a to f, epsg, nodata)."""
    if side % 16:
        raise ValueError("a tile's side is a multiple of 16")
    across = F.ceil(c("width") / side).cast("int")
    placed = pixels.select("name", "row", "col", *[c(x).cast("double").alias(f"v{i}") for i, x in enumerate(bands)]).join(grids.select("name", *GRID), "name")
    placed = placed.where((c("row") >= 0) & (c("row") < c("height")) & (c("col") >= 0) & (c("col") < c("width")))
    keyed = placed.withColumn("tile", F.call_function("div", c("row"), F.lit(side)).cast("int") * across + F.call_function("div", c("col"), F.lit(side)).cast("int"))
    n = len(bands)

    def encode(t: pa.Table) -> pa.Table:
        head = t.slice(0, 1).to_pylist()[0]
        absent = head["nodata"] if head["nodata"] is not None else 0.0
        x = np.full((side, side, n), absent)
        rows, cols = (t.column(k).to_numpy() % side for k in ("row", "col"))
        for i in range(n):
            x[rows, cols, i] = np.nan_to_num(t.column(f"v{i}").to_numpy(), nan=absent, posinf=np.inf, neginf=-np.inf) if t.column(f"v{i}").null_count else t.column(f"v{i}").to_numpy()
        out = x if np.dtype(kind).kind == "f" else np.rint(x)
        return pa.Table.from_pylist([{"name": head["name"], "tile": head["tile"], "data": tiff.encoded(out.astype(kind)), "bands": n, "kind": kind, "side": side} | {k: head[k] for k in GRID}], SCHEMA)

    return keyed.groupBy("name", "tile").applyInArrow(encode, TILES)


SCHEMA = pa.schema([("name", pa.string()), ("tile", pa.int32()), ("data", pa.binary()), ("bands", pa.int32()), ("kind", pa.string()), ("side", pa.int32()), ("width", pa.int32()), ("height", pa.int32()), *[(k, pa.float64()) for k in "abcdef"], ("epsg", pa.int32()), ("nodata", pa.float64())])


def written(tiles: DataFrame, folder: str, parts: int | None = None) -> None:
    """Writes encoded tiles as the files folder/name."""
    spark = tiles.sparkSession
    spark.dataSource.register(RasterSink)
    dealt = tiles.repartition(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), "name").sortWithinPartitions("name", "tile")
    dealt.write.format("raster_files").mode("append").option("folder", folder).save()


def store(folder: str):
    """The file system of a folder, and the folder's path in it."""
    from pyarrow import fs

    m = re.match(r"(?!file:)([a-z0-9]+)://([^/]*)/(.*)", folder, re.S)
    if not m:
        return fs.LocalFileSystem(), re.sub(r"^file:(//)?", "", folder)
    return fs.FileSystem.from_uri(f"{re.sub('^s3[an]$', 's3', m[1])}://{m[2]}/")[0], posixpath.join(m[2] if m[1].startswith("s3") else "/", m[3])


@dataclass
class Files(WriterCommitMessage):
    """What a task wrote: names under which files wait, and their own."""

    waiting: list[tuple[str, str]]


class RasterWriter(DataSourceArrowWriter):
    """Files wait in a hidden folder of the job, which the commit empties and the abort removes."""

    def __init__(self, folder: str) -> None:
        self.folder, self.waiting = folder, f".waiting-{uuid.uuid4().hex}"

    def write(self, batches: Iterator[pa.RecordBatch]) -> Files:
        at, top = store(self.folder)
        done: list[tuple[str, str]] = []
        name, head, sizes, spool = None, None, [], None

        def closed() -> None:
            wait = f"{self.waiting}/{uuid.uuid4().hex}"
            at.create_dir(posixpath.join(top, self.waiting), recursive=True)
            with at.open_output_stream(posixpath.join(top, wait)) as out:
                out.write(tiff.file_head(head["width"], head["height"], head["bands"], head["kind"], head["side"], sizes, tuple(head[k] for k in "abcdef"), head["epsg"], head["nodata"]))
                spool.seek(0)
                while part := spool.read(1 << 22):
                    out.write(part)
            spool.close()
            done.append((wait, name))

        for b in batches:
            for row in b.to_pylist():
                if row["name"] != name:
                    if spool:
                        closed()
                    name, head, spool = row["name"], row, tempfile.TemporaryFile()
                    sizes = [0] * (-(-row["width"] // row["side"]) * -(-row["height"] // row["side"]))
                sizes[row["tile"]] = spool.write(row["data"])
        if spool:
            closed()
        return Files(done)

    def commit(self, messages: list[Files | None]) -> None:
        at, top = store(self.folder)
        for m in messages:
            for wait, name in m.waiting if m else ():
                final = posixpath.join(top, name)
                at.create_dir(posixpath.dirname(final), recursive=True)
                at.move(posixpath.join(top, wait), final)
        self.emptied()

    def abort(self, messages: list[Files | None]) -> None:
        self.emptied()

    def emptied(self) -> None:
        from pyarrow import fs

        at, top = store(self.folder)
        path = posixpath.join(top, self.waiting)
        if at.get_file_info(path).type == fs.FileType.Directory:
            at.delete_dir(path)


class RasterSink(DataSource):
    """df.write.format("raster_files").option("folder", ...): rows as tiles() gives them, together and in order by name."""

    @classmethod
    def name(cls) -> str:
        return "raster_files"

    def schema(self) -> str:
        return TILES

    def writer(self, schema, overwrite: bool) -> RasterWriter:
        return RasterWriter(self.options["folder"])
