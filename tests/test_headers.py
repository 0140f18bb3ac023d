"""Raster headers, and the catalogue that is joined with them."""

import struct

import pytest
from pyspark.sql import functions as F

from geoloom.operators import catalog, grid
from geoloom.sources import files


def raster(path, width=10, keys=(), big=False, order="<", metadata=""):
    """A TIFF file of one directory, with its values behind it."""
    place, count, room = ("Q", "Q", 8) if big else ("I", "H", 4)
    text = metadata.encode() + b"\0"
    values = [(256, 4, 1, struct.pack(order + "I", width)), (257, 4, 1, struct.pack(order + "I", 20)), (277, 3, 1, struct.pack(order + "H", 2))]
    values += [(33550, 12, 3, struct.pack(order + "3d", 2, 2, 0)), (33922, 12, 6, struct.pack(order + "6d", 0, 0, 0, 500000, 4600000, 0))]
    if keys:
        listed = [1, 1, 0, len(keys)] + [x for k, v in keys for x in (k, 0, 1, v)]
        values.append((34735, 3, len(listed), struct.pack(f"{order}{len(listed)}H", *listed)))
    values += [(42112, 2, len(text), text), (42113, 2, 3, b"-9\0")]
    start = 16 if big else 8
    at = start + struct.calcsize("<" + count) + len(values) * (4 + 2 * room) + room
    entries, behind = b"", b""
    for tag, kind, n, raw in values:
        own = raw.ljust(room, b"\0") if len(raw) <= room else struct.pack(order + place, at + len(behind))
        behind += raw if len(raw) > room else b""
        entries += struct.pack(f"{order}HH{place}", tag, kind, n) + own
    top = (b"II" if order == "<" else b"MM") + (struct.pack(order + "HHHQ", 43, 8, 0, start) if big else struct.pack(order + "HI", 42, start))
    path.write_bytes(top + struct.pack(order + count, len(values)) + entries + b"\0" * room + behind)


@pytest.mark.parametrize("big", [False, True])
@pytest.mark.parametrize("order", ["<", ">"])
def test_header_of_both_widths_and_byte_orders(spark, tmp_path, big, order):
    folder = tmp_path / "a folder, 50% full"
    folder.mkdir()
    note = '<GDALMetadata><Item name="SCALE" sample="1" role="scale">0.5</Item><Item name="OFFSET" sample="0" role="offset">-3</Item><Item name="x">y</Item></GDALMetadata>'
    raster(folder / "u.tif", keys=[(1025, 1), (3072, 32638)], big=big, order=order, metadata=note)
    raster(folder / "g.tif", keys=[(1025, 2), (2048, 4326)], big=big, order=order)
    raster(folder / "n.tif", big=big, order=order)
    raster(folder / "o.tif", keys=[(3072, 32767)], big=big, order=order)
    got = {r.path[-5:]: r for r in files.headers(files.listing(spark, str(tmp_path))).collect()}
    assert {k: r.crs for k, r in got.items()} == {"u.tif": "EPSG:32638", "g.tif": "EPSG:4326", "n.tif": None, "o.tif": "user-defined"}
    u, g = got["u.tif"], got["g.tif"]
    assert (u.width, u.height, u.bands, u.nodata, u.scales, u.offsets) == (10, 20, 2, -9.0, [1.0, 0.5], [-3.0, 0.0])
    assert (u.a, u.c, u.e, u.f) == (2.0, 500000.0, -2.0, 4600000.0) and (g.c, g.f, g.scales) == (499999.0, 4600001.0, [1.0, 1.0])


def test_no_files_and_files_of_another_kind(spark, tmp_path):
    none = spark.createDataFrame([], "path string")
    assert files.headers(none).count() == 0
    with pytest.raises(ValueError, match="no bands"):
        catalog.required(none, "no bands")
    (tmp_path / "x.tif").write_bytes(b"PK")
    with pytest.raises(Exception, match="not a TIFF file"):
        files.headers(spark.createDataFrame([(str(tmp_path / "x.tif"),)], "path string")).collect()
    raster(tmp_path / "good.tif")
    (tmp_path / "short.tif").write_bytes((tmp_path / "good.tif").read_bytes()[:40])
    listed = spark.createDataFrame([(str(tmp_path / n),) for n in ("x.tif", "short.tif", "good.tif", "none.tif")], "path string")
    got = {r.path.rsplit("/", 1)[1]: r for r in files.headers(listed, errors=True).collect()}
    assert got["good.tif"].error is None and got["good.tif"].width == 10
    assert all(got[n].error and got[n].width is None for n in ("x.tif", "short.tif", "none.tif"))


def test_index_leaves_out_places_without_a_reference_system_before_the_first_is_taken(spark):
    bands = spark.createDataFrame([("s", b, f"/{r}/s_{b}.tif") for r in ("r0", "r1") for b in "RGBN"] + [("t", b, f"/r0/t_{b}.tif") for b in "RGB"], "scene string, band string, path string")
    meta = spark.createDataFrame([(f"/{r}/s_R.tif", 10, 20, "EPSG:32638" if r == "r1" else None, 2.0, 0.0, 100.0, 0.0, -3.0, 500.0, None) for r in ("r0", "r1")], "path string, width int, height int, crs string, a double, b double, c double, d double, e double, f double, nodata double")
    (one,) = catalog.scene_index(bands, {"/r0": 0, "/r1": 1}, meta).collect()
    assert (one.scene_id, one.path_N, one.crs, one.minx, one.miny, one.maxx, one.maxy, one.res_x, one.res_y, one.nodata) == ("s", "/r1/s_N.tif", "EPSG:32638", 100.0, 440.0, 120.0, 500.0, 2.0, 3.0, None)
    moved = catalog.scene_index(bands, {"/r0": 0, "/r1": 1}, meta, "EPSG:32638").first()
    assert moved == one and catalog.scene_index(bands, {"/r0": 0, "/r1": 1}, meta, "EPSG:4326").first().maxx < 41


def test_colour_bands_are_three_files_of_one_grid(spark):
    cases = {"ok": ("RGBN", None), "two": ("RRGB", "expected exactly 1 R band, found 2"), "none": ("N", "expected exactly 1 R band, found 0"), "bare": ("RGB", "no header"), "apart": ("RGB", "grid mismatch")}
    rows = [(s, b, f"/{s}_{i}_{b}.tif") for s, (bs, _) in cases.items() for i, b in enumerate(bs)]
    bands = spark.createDataFrame(rows, "scene string, band string, path string")
    meta = spark.createDataFrame([(p, 11 if s == "ok" and b == "N" or s == "apart" and b == "G" else 10, None) for s, b, p in rows if (s, b) != ("bare", "B")], "path string, width int, crs string").selectExpr("*", "10 height", *[f"1.0D {k}" for k in "abcdef"])
    got = {r.scene: r.error for r in catalog.rgb_checked(bands, meta).collect()}
    assert got == {s: e for s, (_, e) in cases.items()}
    assert catalog.rgb_files(bands.where("scene = 'ok'"), meta).first().path_G == "/ok_1_G.tif"
    with pytest.raises(Exception, match="apart: grid mismatch"):
        catalog.rgb_files(bands.where("scene = 'apart'"), meta).collect()


def test_boxes_go_to_another_reference_system_by_their_edges(spark):
    schema = "k string, crs string, minx double, miny double, maxx double, maxy double"
    df = spark.createDataFrame([("same", "EPSG:32638", 4e5, 4.4e6, 4.1e5, 4.42e6), ("next", "EPSG:32637", 8e5, 4.4e6, 8.1e5, 4.42e6), ("deg", "EPSG:4326", 42.0, 39.0, 42.5, 40.0)], schema)
    got = {r.k: r for r in grid.reprojected(df, "k", "EPSG:32638").collect()}
    assert got["same"][1:] == (4e5, 4.4e6, 4.1e5, 4.42e6)
    # by a second program in plain Python, which searches on the forward formula for the inverse
    want = {"next": (285539.0997129637, 4396468.173085152, 296849.7798482358, 4417080.703215189), "deg": (240199.8078775529, 4319750.015383783, 286588.8521329659, 4432069.0568985175)}
    for k, box in want.items():
        assert all(abs(a - b) < 1e-6 for a, b in zip(got[k][1:], box, strict=True))
    back = grid.reprojected(df.where("k = 'deg'"), "k", "EPSG:4326").first()
    assert back[1:] == (42.0, 39.0, 42.5, 40.0)
    with pytest.raises(Exception, match="unknown reference system: EPSG:3857"):
        grid.reprojected(df.withColumn("crs", F.lit("EPSG:3857")), "k", "EPSG:32638").collect()
