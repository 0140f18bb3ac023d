"""Helpers that several of these operators share: scratch tables, packed arrays and byte-level text access."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from geoloom.sources import shared

#: A-Z to a-z on UTF-8 bytes; other bytes stay.
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


#: Rows and bytes of a batch of rows on its way to a Python worker: texts are long, and a worker holds a batch several times over.
BATCH_ROWS, BATCH_BYTES = 1_000, 8 << 20


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers once a session, for drivers that found it by sys.path alone, and lets no batch of rows be larger than BATCH_ROWS and BATCH_BYTES."""
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        if not 0 < int(spark.conf.get(key).rstrip("b")) <= most:
            spark.conf.set(key, str(most))
    sc = spark.sparkContext
    if getattr(sc, "_geoloom_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    made = io.BytesIO()
    with zipfile.ZipFile(made, "w") as z:
        for p in sorted((root / "geoloom").rglob("*.py")):
            z.write(p, p.relative_to(root))
    at = Path(tempfile.mkdtemp()) / "geoloom_package.zip"
    at.write_bytes(made.getvalue())
    sc.addPyFile(str(at))
    sc._geoloom_shipped = True


def scratch(spark: SparkSession) -> str:
    """A new path in the shared folder, for release() to remove."""
    path = shared.scratch(spark)
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


#: Scratch paths and tables by application, for release().
_made: dict[str, list[str]] = {}
_tables: dict[str, list[str]] = {}


def removed(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def release(spark: SparkSession) -> None:
    """Removes all scratch tables of the application; results that were not written before can't be read afterwards."""
    for name in _tables.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    for path in _made.pop(spark.sparkContext.applicationId, []):
        removed(spark, path)


def drop(df: DataFrame) -> None:
    """Removes a written() table that nothing reads any more."""
    if path := getattr(df, "_geoloom_path", None):
        removed(df.sparkSession, path)


def written(df: DataFrame) -> DataFrame:
    """df as a Parquet table in the shared scratch folder: cuts lineage, and survives lost executors."""
    spark = df.sparkSession
    path = scratch(spark)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._geoloom_path = path
    return out


def bucketed(df: DataFrame, key: str, n: int) -> DataFrame:
    """df as a scratch table bucketed by key, so that grouping by key needs no further shuffle."""
    spark = df.sparkSession
    name = f"geoloom_{uuid.uuid4().hex}"
    _tables.setdefault(spark.sparkContext.applicationId, []).append(name)
    df.write.bucketBy(n, key).option("path", scratch(spark)).format("parquet").saveAsTable(name)
    return spark.table(name)


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each string of an Arrow column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one blob. Byte planes stand together and sorted unsigned keys are stored as differences, so that zstd finds little to store."""
    import zstandard

    out = [np.array([len(arrays)], "<u4").tobytes()]
    for a in arrays:
        a = np.ascontiguousarray(a)
        kind = a.dtype.str.encode().ljust(4)
        delta = a.dtype == np.uint64 and len(a) > 1 and bool((a[1:] >= a[:-1]).all())
        x = np.diff(a, prepend=np.uint64(0)) if delta else a
        raw = x.view(np.uint8).reshape(len(a), a.itemsize).T.tobytes() if len(a) and a.itemsize > 1 else a.tobytes()
        data = zstandard.ZstdCompressor(level=1).compress(raw)
        out += [kind, bytes([delta]), np.array([len(a), len(data)], "<u8").tobytes(), data]
    return b"".join(out)


def unpack(blob: bytes) -> list[np.ndarray]:
    """The arrays that pack() was given."""
    import zstandard

    n, at, out = int(np.frombuffer(blob, "<u4", 1)[0]), 4, []
    for _ in range(n):
        kind, delta = np.dtype(blob[at : at + 4].decode().strip()), blob[at + 4]
        rows, size = (int(x) for x in np.frombuffer(blob, "<u8", 2, at + 5))
        raw = zstandard.ZstdDecompressor().decompress(blob[at + 21 : at + 21 + size])
        at += 21 + size
        x = np.frombuffer(raw, np.uint8)
        x = np.ascontiguousarray(x.reshape(kind.itemsize, rows).T).view(kind).ravel() if rows and kind.itemsize > 1 else x.view(kind)
        out.append(np.cumsum(x, dtype=np.uint64) if delta else x)
    return out


def part_id() -> int:
    """The number of the running task's partition."""
    from pyspark import TaskContext

    t = TaskContext.get()
    return t.partitionId() if t else 0


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies; GEOLOOM_TOKENIZERS names another folder."""
    return os.path.join(os.environ.get("GEOLOOM_TOKENIZERS", "/opt/tokenizers"), name)
