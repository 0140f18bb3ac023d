"""Benchmark items without an id."""

import corpus_pipeline as cp
import pytest

from geoloom.llm import decontaminate


@pytest.mark.parametrize("block", [8 << 20, 1])
def test_items_without_an_id_hit(spark, tmp_path, block):
    bench = spark.createDataFrame([(None, "one two three"), (5, "four five six"), (None, "four five six"), (6, None)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "x one two three y"), (2, "x four five six"), (3, "seven")], "doc_id long, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r.contaminated) for r in decontaminate.report(docs, bench, block_bytes=block).collect()}
    assert got == {1: (3, 0, True), 2: (3, 1, True), 3: (0, 0, False)}
    bench.write.parquet(str(tmp_path / "benchmark.parquet"))
    assert [r.doc_id for r in cp.decontaminated(spark, docs, str(tmp_path)).collect()] == [3]
