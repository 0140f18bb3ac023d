"""The stream of exports: files in time, late, early, missing and repeated."""

import json
import os
from datetime import datetime, timedelta

import pytest

from geoloom.streaming import exports

T0 = datetime(2024, 1, 1)


@pytest.fixture
def store(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_every_order_of_events(spark, tmp_path, store):
    at = lambda h: T0 + timedelta(hours=h)
    batches = [
        [("intime", at(0), "started", None), ("missing", at(0), "started", None), ("late", at(1), "started", None), ("early", at(0), "file", "/e"), ("twice", at(0), "started", None), ("twice", at(0), "started", None)],
        [("intime", at(10), "file", "/i"), ("early", at(3), "started", None), ("twice", at(9), "file", "/t"), ("twice", at(9), "file", "/t2")],
        [("clock", at(80), "started", None)],
        [("tick", at(81), "started", None)],
        [("late", at(90), "file", "/l"), ("clock", at(91), "file", "/c")],
        [("clock2", at(200), "started", None)],
        [("clock3", at(201), "started", None)],
    ]
    src = tmp_path / "in"
    src.mkdir()
    for i, rows in enumerate(batches):
        f = src / f"{i}.json"
        f.write_text("\n".join(json.dumps({"scene": s, "at": t.isoformat(), "kind": k, "path": p}) for s, t, k, p in rows))
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    stream = spark.readStream.schema(exports.EVENTS).option("maxFilesPerTrigger", 1).json(str(src))
    q = exports.states(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(240)
    assert q.exception() is None
    got = sorted((r.scene, r.status, r.path, (r.at - T0) / timedelta(hours=1)) for r in spark.read.schema(exports.STATES).parquet(str(tmp_path / "out")).collect())
    done, failed, started = exports.DONE, exports.FAILED, exports.STARTED
    assert [x for x in got if x[0] in ("intime", "early", "twice")] == [("early", done, "/e", 3.0), ("early", started, None, 3.0), ("intime", done, "/i", 10.0), ("intime", started, None, 0.0), ("twice", done, "/t", 9.0), ("twice", started, None, 0.0)]
    assert [x for x in got if x[0] in ("missing", "late")] == [("late", failed, None, 49.0), ("late", done, "/l", 90.0), ("late", started, None, 1.0), ("missing", failed, None, 48.0), ("missing", started, None, 0.0)]
    last = {r.scene: r.status for r in exports.latest(spark.read.schema(exports.STATES).parquet(str(tmp_path / "out"))).collect()}
    assert (last["late"], last["missing"], last["twice"], last["clock"]) == (done, failed, done, done)
