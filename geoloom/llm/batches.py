"""Documents as batches of a few megabytes, and exchanges between batches and hash ranges of 64-bit keys.

A batch is one row of a scratch table bucketed by batch number, so that later passes regroup no text: they only shuffle
what batches ask of hash ranges (requests) and what they get back (responses), each as packed arrays. A key that many
batches hold is sent once by each of them, so a hot key costs one entry a batch, not one a row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm import common

#: Bytes of text in a batch, about; a longer text is a batch of its own.
SIZE = 6 << 20
#: Bytes of text for each hash range, about.
RANGE = 6 << 20
NO_ID = np.iinfo(np.int64).max
MESSAGE = "batch long, part int, kind string, blob binary"


def split(texts: DataFrame, size: int = SIZE) -> DataFrame:
    """batch, turn, n_bytes, blob (doc ids, whether an id is null, flag, lengths, bytes) from a table of doc_id, text, flag (boolean) and, where texts of different turns go into different batches, turn (int)."""
    common.ship(texts.sparkSession)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[int | None, bytes, bool]]] = {}
        sizes: dict[int, int] = {}
        number = 0

        def made(turn: int) -> pa.RecordBatch:
            nonlocal number
            got, total = held.pop(turn), sizes.pop(turn)
            ids = np.array([NO_ID if i is None else i for i, _, _ in got], np.int64)
            blob = common.pack(ids, np.array([i is None for i, _, _ in got]), np.array([f for _, _, f in got], bool), np.array([len(t) for _, t, _ in got], np.int64), np.frombuffer(b"".join(t for _, t, _ in got), np.uint8))
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([(common.part_id() << 32) + number], pa.int64()), pa.array([turn], pa.int32()), pa.array([total], pa.int64()), pa.array([blob], pa.binary())], names=["batch", "turn", "n_bytes", "blob"])

        for b in rows:
            for i, t, f, turn in zip(b.column(0).to_pylist(), common.text_bytes(b.column(1)), b.column(2).to_pylist(), b.column(3).to_pylist(), strict=True):
                if turn in held and sizes[turn] + len(t) > size:
                    yield made(turn)
                held.setdefault(turn, []).append((i, t, bool(f)))
                sizes[turn] = sizes.get(turn, 0) + len(t)
        for turn in sorted(held):
            yield made(turn)

    turn = F.col("turn").cast("int") if "turn" in texts.columns else F.lit(0)
    buckets = min(4096, max(8, 2 * texts.rdd.getNumPartitions()))
    return common.bucketed(texts.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "flag", turn.alias("turn")).mapInArrow(run, "batch long, turn int, n_bytes long, blob binary"), "batch", buckets)


def opened(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """Ids, whether they are null, flags and texts of a batch."""
    ids, nulls, flag, lengths, raw = common.unpack(blob)
    data, ends = raw.tobytes(), np.cumsum(lengths)
    return ids, nulls, flag, [data[e - n : e] for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]


def ranges(table: DataFrame, size: int = RANGE) -> int:
    """Hash ranges for a table of batches: a power of two."""
    total = table.agg(F.sum("n_bytes")).first()[0] or 0
    return 1 << max(3, int(total // size).bit_length())


def parts_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The hash range of each key: its leading bits."""
    return (keys >> np.uint64(64 - (parts.bit_length() - 1))).astype(np.int64)


def slices_of(sorted_keys: np.ndarray, parts: int) -> Iterator[tuple[int, int, int]]:
    """(hash range, first, last + 1) of the runs of sorted keys that are not empty."""
    edge = np.searchsorted(parts_of(sorted_keys, parts), np.arange(parts + 1))
    for k in np.flatnonzero(edge[1:] > edge[:-1]).tolist():
        yield k, int(edge[k]), int(edge[k + 1])


def messages(rows: list[tuple[int, int, str, bytes]]) -> pa.Table:
    """Rows of MESSAGE."""
    columns = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
    kinds = (pa.int64(), pa.int32(), pa.string(), pa.binary())
    return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["batch", "part", "kind", "blob"])


def asked(table: DataFrame, ask: Callable[[int, bytes], list[tuple[int, int, str, bytes]]]) -> DataFrame:
    """Requests of every batch by itself; ask(batch, blob) gives rows of MESSAGE."""

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            for number, blob in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                yield from messages(ask(number, blob)).to_batches()

    return table.select("batch", "blob").mapInArrow(run, MESSAGE)


def answered(requests: DataFrame, answer: Callable[[int, list[tuple[int, str, bytes]]], list[tuple[int, int, str, bytes]]]) -> DataFrame:
    """Responses of every hash range: answer(range, [(batch, kind, blob)]) gives rows of MESSAGE. A written table."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        got = sorted(zip(t.column("batch").to_pylist(), t.column("kind").to_pylist(), t.column("blob").to_pylist(), strict=True), key=lambda x: x[:2])
        return messages(answer(key[0].as_py(), got))

    return common.written(requests.groupBy("part").applyInArrow(run, MESSAGE))


def continued(requests: DataFrame, before: DataFrame | None, answer: Callable[[int, list[tuple[int, str, bytes]], list[tuple[int, str, bytes]]], list[tuple[int, int, str, bytes]]]) -> DataFrame:
    """answered() with what the ranges wrote before (rows of MESSAGE in a table bucketed by range, which stay where they are): answer(range, requests, before) gives rows of MESSAGE, a table bucketed by range again."""
    spark = requests.sparkSession

    def run(key: tuple, new: pa.Table, old: pa.Table) -> pa.Table:
        got = [sorted(zip(t.column("batch").to_pylist(), t.column("kind").to_pylist(), t.column("blob").to_pylist(), strict=True), key=lambda x: x[:2]) for t in (new, old)]
        return messages(answer(key[0].as_py(), *got))

    old = before if before is not None else spark.createDataFrame([], MESSAGE)
    return common.bucketed(requests.groupBy("part").cogroup(old.groupBy("part")).applyInArrow(run, MESSAGE), "part", int(spark.conf.get("spark.sql.shuffle.partitions")))


def together(table: DataFrame, responses: DataFrame, use: Callable[[int, bytes, dict[str, dict[int, bytes]]], pa.Table], schema: str) -> DataFrame:
    """use(batch, blob, {kind: {range: blob}}) for every batch with its responses. Batches stay where they are; only responses are shuffled."""

    def run(key: tuple, own: pa.Table, got: pa.Table) -> pa.Table:
        by: dict[str, dict[int, bytes]] = {}
        for part, kind, blob in zip(got.column("part").to_pylist(), got.column("kind").to_pylist(), got.column("blob").to_pylist(), strict=True):
            by.setdefault(kind, {})[part] = blob
        return use(key[0].as_py(), own.column("blob")[0].as_py(), by) if own.num_rows else pa.table([[] for _ in empty.names], schema=empty)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    empty = to_arrow_schema(StructType.fromDDL(schema))
    return table.select("batch", "blob").groupBy("batch").cogroup(responses.groupBy("batch")).applyInArrow(run, schema)
