"""Pixels of TIFF files: a table of chunks (strips or tiles) for any number of files, their decoding, and a Data Source for short lists.

chunks() has one row a strip or tile, with its place and where its bytes lie; windows and joins are ordinary conditions on
that table, and pixels() then reads those byte ranges alone, in as many tasks as asked for.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

from geoloom.functions.columns import c
from geoloom.sources import files as listed
from geoloom.sources import tiff

CHUNKS = "path string, chunk int, row int, col int, height int, width int, offsets array<long>, sizes array<long>, kind string, compression int, predictor int, planar int, bands int, chunk_width int, chunk_height int, tiled boolean, nodata double, crs string"
#: Chunks in one batch of chunks(), and pixels in one of pixels().
BATCH, PIXELS = 4096, 1 << 18
#: Bands of a picture.
RGB = {"r": 1, "g": 2, "b": 3}


def chunk_rows(path: str, lay: tiff.Layout) -> Iterator[tuple]:
    for i in range(lay.across * lay.down):
        row, col = i // lay.across * lay.chunk_height, i % lay.across * lay.chunk_width
        planes = lay.planes(i)
        yield (
            path, i, row, col, min(lay.chunk_height, lay.height - row), min(lay.chunk_width, lay.width - col), [p for p, _ in planes], [n for _, n in planes],
            lay.kind, lay.compression, lay.predictor, lay.planar, lay.bands, lay.chunk_width, lay.chunk_height, lay.tiled, lay.header[9], lay.header[10],
        )


def chunks(files: DataFrame) -> DataFrame:
    """A row for each strip or tile of the files (path), bands that are kept apart in one row."""
    schema = pa.schema([("path", pa.string()), *[(n, pa.int32()) for n in ("chunk", "row", "col", "height", "width")], ("offsets", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("kind", pa.string()),
                        *[(n, pa.int32()) for n in ("compression", "predictor", "planar", "bands", "chunk_width", "chunk_height")], ("tiled", pa.bool_()), ("nodata", pa.float64()), ("crs", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for b in batches:
            for path in b.column(0).to_pylist():
                with listed.opened(path) as f:
                    lay = tiff.layout(f)
                for row in chunk_rows(path, lay):
                    held.append(row)
                    if len(held) == BATCH:
                        yield batch(held, schema)
                        held = []
        if held:
            yield batch(held, schema)

    return files.select("path").where("path is not null").mapInArrow(run, CHUNKS)


def batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def samples(f, chunk: dict, bands: list[int]) -> np.ndarray:
    """A chunk's pixels of the wanted bands (from 1), as doubles (height, width, bands); what a sparse file lacks is its missing value, or 0."""
    rows = chunk["chunk_height"] if chunk["tiled"] else chunk["height"]
    absent = chunk["nodata"] if chunk["nodata"] is not None else 0.0

    def plane(i: int, n: int) -> np.ndarray:
        if not chunk["sizes"][i]:
            return np.full((chunk["height"], chunk["width"], n), absent)
        f.seek(chunk["offsets"][i])
        x = tiff.decoded(f.read(chunk["sizes"][i]), chunk["kind"], chunk["compression"], chunk["predictor"], rows, chunk["chunk_width"], n)
        return x[: chunk["height"], : chunk["width"]].astype(np.float64)

    if max(bands) > chunk["bands"]:
        raise ValueError(f"{chunk['path']} has {chunk['bands']} bands")
    if chunk["planar"] == 2:
        return np.concatenate([plane(b - 1, 1) for b in bands], axis=2)
    return plane(0, chunk["bands"])[:, :, [b - 1 for b in bands]]


def pixels(chunks: DataFrame, bands: dict[str, int] | None = None, window: tuple[int, int, int, int] | None = None, parts: int | None = None) -> DataFrame:
    """path, row, col, a column for each of bands (name: number from 1), valid (all bands finite and not the missing value).

    window: first row, row after the last, first column, column after the last. Chunks outside are not read. A column `own`
    of chunks (an array of the same four numbers, as a join may give) does this for each row. The chunks are dealt to
    `parts` tasks; by default to as many as spark.sql.shuffle.partitions says.
    """
    bands = bands or {"value": 1}
    spark = chunks.sparkSession
    if "own" not in chunks.columns:
        own = window or (0, 2**31 - 1, 0, 2**31 - 1)
        chunks = chunks.withColumn("own", F.array(*[F.lit(x) for x in own]))
    first, last, left, right = (F.get("own", F.lit(i)) for i in range(4))
    meets = (c("row") < last) & (c("row") + c("height") > first) & (c("col") < right) & (c("col") + c("width") > left)
    dealt = chunks.where(meets).repartition(parts or int(spark.conf.get("spark.sql.shuffle.partitions")), "path", "chunk")
    names, numbers = list(bands), list(bands.values())
    schema = pa.schema([("path", pa.string()), ("row", pa.int32()), ("col", pa.int32()), *[(n, pa.float64()) for n in names], ("valid", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, f = None, None
        for b in batches:
            for chunk in b.to_pylist():
                if chunk["path"] != at:
                    if f:
                        f.close()
                    at, f = chunk["path"], listed.opened(chunk["path"])
                yield from cropped(chunk, samples(f, chunk, numbers), schema)
        if f:
            f.close()

    return dealt.sortWithinPartitions("path", "chunk").mapInArrow(run, "path string, row int, col int, " + "".join(f"`{n}` double, " for n in names) + "valid boolean")


def cropped(chunk: dict, x: np.ndarray, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The pixels of a chunk that lie in its window, in batches."""
    first, last, left, right = chunk["own"]
    r0, r1 = max(first - chunk["row"], 0), min(last - chunk["row"], chunk["height"])
    c0, c1 = max(left - chunk["col"], 0), min(right - chunk["col"], chunk["width"])
    x = x[r0:r1, c0:c1]
    valid = np.isfinite(x).all(axis=2)
    if chunk["nodata"] is not None:
        valid &= (x != chunk["nodata"]).all(axis=2)
    step = max(1, PIXELS // max(1, c1 - c0))
    for a in range(0, r1 - r0, step):
        part = x[a : a + step]
        h, w = part.shape[:2]
        rows, cols = np.divmod(np.arange(h * w, dtype=np.int64), w)
        arrays = [pa.array([chunk["path"]] * (h * w), pa.string()), pa.array((rows + chunk["row"] + r0 + a).astype(np.int32)), pa.array((cols + chunk["col"] + c0).astype(np.int32))]
        arrays += [pa.array(part[:, :, i].ravel()) for i in range(part.shape[2])] + [pa.array(valid[a : a + step].ravel())]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def rgb(files: DataFrame, window: tuple[int, int, int, int] | None = None, parts: int | None = None) -> DataFrame:
    """path, row, col, r, g, b, valid of three-band pictures; one without a reference system, or with fewer bands, is an error."""
    failed = F.raise_error(F.concat(F.lit("no reference system or fewer than three bands: "), "path")).cast("string")
    good = chunks(files).withColumn("path", F.when(c("crs").isNotNull() & (c("bands") >= 3), c("path")).otherwise(failed))
    return pixels(good, RGB, window, parts)


class Run(InputPartition):
    def __init__(self, chunks: list[dict]) -> None:
        self.chunks = chunks


class PixelReader(DataSourceReader):
    """Plans partitions from the chunks that conditions on row and col leave; at most `bytes` stored bytes each, or one chunk."""

    def __init__(self, options: dict[str, str]) -> None:
        self.paths = [p for p in options.get("paths", options.get("path", "")).split("\n") if p]
        self.most = int(options.get("bytes", 8 << 20))
        self.window = [int(x) for x in options.get("window", f"0,{2**31 - 1},0,{2**31 - 1}").split(",")]
        self.bands: set[int] | None = {int(x) for x in options["bands"].split(",")} if options.get("bands") else None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Narrows window and bands; Spark checks all but what the window says exactly."""
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else ""
            if name == "band" and isinstance(f, (EqualTo, In)):
                found = {f.value} if isinstance(f, EqualTo) else set(f.value)
                self.bands = found if self.bands is None else self.bands & found
            elif name in ("row", "col") and isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)):
                low = 0 if name == "row" else 2
                if isinstance(f, (EqualTo, GreaterThan, GreaterThanOrEqual)):
                    self.window[low] = max(self.window[low], f.value + isinstance(f, GreaterThan))
                if isinstance(f, (EqualTo, LessThan, LessThanOrEqual)):
                    self.window[low + 1] = min(self.window[low + 1], f.value + (not isinstance(f, LessThan)))
            else:
                yield f

    def partitions(self) -> list[Run]:
        first, last, left, right = self.window
        names = [x.split()[0] for x in CHUNKS.split(", ")]
        out, size = [], self.most
        for path in self.paths:
            with listed.opened(path) as f:
                lay = tiff.layout(f)
            for row in chunk_rows(path, lay):
                chunk = dict(zip(names, row, strict=True)) | {"own": self.window}
                if chunk["row"] < last and chunk["row"] + chunk["height"] > first and chunk["col"] < right and chunk["col"] + chunk["width"] > left:
                    if size >= self.most:
                        out.append([])
                        size = 0
                    out[-1].append(chunk)
                    size += sum(chunk["sizes"])
        return [Run(x) for x in out] or [Run([])]

    def read(self, part: Run) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("path", pa.string()), ("row", pa.int32()), ("col", pa.int32()), ("value", pa.float64()), ("valid", pa.bool_())])
        for chunk in part.chunks:
            bands = [b for b in range(1, chunk["bands"] + 1) if self.bands is None or b in self.bands]
            if bands:
                with listed.opened(chunk["path"]) as f:
                    x = samples(f, chunk, bands)
                for i, band in enumerate(bands):
                    for rows in cropped(chunk, x[:, :, i : i + 1], schema):
                        yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(np.full(len(rows), band, np.int32)), *rows.columns[1:]], names=["path", "band", "row", "col", "value", "valid"])


class PixelSource(DataSource):
    """spark.read.format("raster_pixels").option("paths", lines).load(): path, band, row, col, value, valid.

    The options window (first row, row after the last, first column, column after the last) and bands choose what is read. With
    spark.sql.python.filterPushdown.enabled, so do conditions on row, col and band; Spark 4.1 then keeps what was pushed with the
    loaded frame, so load anew for each query there.
    """

    @classmethod
    def name(cls) -> str:
        return "raster_pixels"

    def schema(self) -> str:
        return "path string, band int, row int, col int, value double, valid boolean"

    def reader(self, schema) -> PixelReader:
        return PixelReader(self.options)
