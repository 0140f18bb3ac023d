"""Documents and tables that jobs leave: what is written is read back."""

import json

from geoloom.sources import files, sinks

PAIRS = "scene long, ord long, x0 double, y0 double, x1 double, y1 double, conf double"


def test_match_documents_read_back(spark, tmp_path):
    pairs = [(1, i, 0.5 * i, 1.0, 2.0 + i, 3.0, 0.9 - i / 10) for i in range(5)] + [(2, 0, 1.0, 1.0, 2.0, 2.0, 0.5)]
    about = spark.createDataFrame([(1, "homography", 5, 1.25), (2, "tps", 1, None), (3, "tps", 0, None)], "scene long, method string, n_matches int, residual_median_px double")
    sinks.match_documents(spark.createDataFrame(list(reversed(pairs)), PAIRS).repartition(3), about, str(tmp_path / "m"))
    docs = [json.loads(x) for f in (tmp_path / "m").glob("part-*.json") for x in f.read_text().splitlines()]
    assert {d["scene"]: (d["method"], d["n_matches"], d.get("residual_median_px")) for d in docs} == {"1": ("homography", 5, 1.25), "2": ("tps", 1, None), "3": ("tps", 0, None)}
    one = next(d for d in docs if d["scene"] == "1")
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "1.json").write_text(json.dumps(one))
    got = sorted(tuple(r)[1:] for r in files.matches(spark, str(tmp_path / "one")).collect())
    assert got == [p[1:] for p in pairs if p[0] == 1]


def test_rows_of_a_scene_in_one_document(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, "zero_raw", None), (1, 0, "worker_error", "boom"), (2, 0, "used_refined", None)], "scene long, tile_id int, status string, error string")
    sinks.row_documents(rows, "tiles", str(tmp_path / "t"))
    docs = {d["scene"]: d["tiles"] for f in (tmp_path / "t").glob("part-*.json") for d in map(json.loads, f.read_text().splitlines())}
    assert docs == {"1": [{"tile_id": 0, "status": "worker_error", "error": "boom"}, {"tile_id": 1, "status": "zero_raw"}], "2": [{"tile_id": 0, "status": "used_refined"}]}


def test_block_tables(spark, tmp_path):
    index = spark.createDataFrame([("s", 0.0, 1.0, 2.0, 3.0)], "scene_id string, minx double, miny double, maxx double, maxy double")
    blocks = spark.createDataFrame([("B1", 0.0, 0.0, 5.0, 5.0, -1.0, -1.0, 6.0, 6.0)], "block_id string, core_minx double, core_miny double, core_maxx double, core_maxy double, expanded_minx double, expanded_miny double, expanded_maxx double, expanded_maxy double")
    pairs = spark.createDataFrame([("B1", "s", "20240101"), ("B1", "t", "20240101"), ("B2", "s", "20240102")], "block_id string, scene_id string, acq_day string")
    tiles = spark.createDataFrame([("B1", "B1_TS_000001")], "block_id string, tile_id string")
    sinks.block_tables(index, blocks, pairs, tiles, tiles, {"tile": 512, "step": 128}, str(tmp_path))
    s = {r.block_id: r for r in spark.read.option("header", True).option("inferSchema", True).csv(str(tmp_path / "block_summary")).collect()}
    assert (s["B1"].n_scenes, s["B1"].n_dates, s["B1"].selected_tiles, s["B1"].observations) == (2, 1, 1, 1) and s["B2"].selected_tiles == 0
    assert json.loads(spark.read.text(str(tmp_path / "config")).first().value) == {"step": 128, "tile": 512}
    assert spark.read.parquet(str(tmp_path / "blocks")).first().geometry == "POLYGON((0.0 0.0,5.0 0.0,5.0 5.0,0.0 5.0,0.0 0.0))"
    assert spark.read.option("header", True).csv(str(tmp_path / "scene_index_csv")).count() == 1
