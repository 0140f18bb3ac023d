"""Pixels from files of every layout, windows that read their tiles only, and files written and read again."""

import os
import struct
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.sources import files, pixels, rasters, tiff


def lzw(data):
    """A plain encoder, for tests."""
    out, have, bits, table, word = 0, 0, 9, {bytes([i]): i for i in range(256)}, b""

    def put(code):
        nonlocal out, have
        out, have = (out << bits) | code, have + bits

    put(256)
    for byte in data:
        nxt = word + bytes([byte])
        if nxt in table:
            word = nxt
            continue
        put(table[word])
        table[nxt] = len(table) + 2
        if len(table) + 2 > 4094:
            put(256)
            table, bits, nxt = {bytes([i]): i for i in range(256)}, 9, b""
        elif len(table) + 2 > (1 << bits) - 1:
            bits += 1
        word = bytes([byte])
    if word:
        put(table[word])
    if len(table) + 3 > (1 << bits) - 1 and bits < 12:
        bits += 1
    put(257)
    pad = -have % 8
    return (out << pad).to_bytes((have + pad) // 8, "big")


def packbits(data):
    out = b""
    for i in range(0, len(data), 100):
        part = data[i : i + 100]
        out += bytes([257 - len(part)]) + part[:1] if len(part) > 1 and len(set(part)) == 1 else bytes([len(part) - 1]) + part
    return out


def raster(path, x, order="<", compression=1, predictor=1, planar=1, tile=None, rows=5, nodata=None, sparse=()):
    """Writes x (height, width, bands) by hand: the layout's own words, independent of the sink."""
    h, w, bands = x.shape
    size, kind = x.dtype.itemsize, x.dtype.kind

    def bytes_of(part):
        if predictor == 3:
            r, n, s = part.shape
            raw = part.astype(f">f{size}").tobytes()
            out = bytearray()
            for i in range(r):
                line = raw[i * n * s * size : (i + 1) * n * s * size]
                planes = bytes(line[k * size + b] for b in range(size) for k in range(n * s))
                out += bytes((planes[k] - (planes[k - s] if k >= s else 0)) % 256 for k in range(len(planes)))
            return bytes(out)
        if predictor == 2:
            y = part.astype(np.int64)
            y[:, 1:] -= part.astype(np.int64)[:, :-1]
            return (y % (1 << 8 * size)).astype(f"{order}u{size}").tobytes()
        return part.astype(f"{order}{kind}{size}").tobytes()

    th, tw = tile or (rows, w)
    parts = []
    for plane in [x] if planar == 1 else [x[:, :, i : i + 1] for i in range(bands)]:
        for r in range(0, h, th):
            for q in range(0, w, tw):
                part = plane[r : r + th, q : q + tw]
                if tile:
                    part = np.pad(part, ((0, th - part.shape[0]), (0, tw - part.shape[1]), (0, 0)), mode="edge")
                parts.append({1: bytes, 8: zlib.compress, 5: lzw, 32773: packbits}[compression](bytes_of(part)))
    parts = [b"" if i in sparse else p for i, p in enumerate(parts)]
    head = [(256, 4, [w]), (257, 4, [h]), (258, 3, [size * 8] * bands), (259, 3, [compression]), (277, 3, [bands]), (284, 3, [planar]), (317, 3, [predictor]), (339, 3, [{"u": 1, "i": 2, "f": 3}[kind]] * bands)]
    head += [(322, 4, [tw]), (323, 4, [th])] if tile else [(278, 3, [rows])]
    at, starts = 8, []
    for p in parts:
        starts.append(at if p else 0)
        at += len(p)
    head += [(324 if tile else 273, 4, starts), (325 if tile else 279, 4, [len(p) for p in parts]), (34735, 3, [1, 1, 0, 1, 3072, 0, 1, 32638])]
    if nodata is not None:
        head.append((42113, 2, list(str(nodata).encode() + b"\0")))
    behind_at, behind, entries = at + 2 + 12 * len(head) + 4, b"", b""
    for tag, k, values in sorted(head):
        raw = struct.pack(f"{order}{len(values)}{ {2: 'B', 3: 'H', 4: 'I'}[k] }", *values)
        entries += struct.pack(order + "HHI", tag, k, len(values)) + (raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack(order + "I", behind_at + len(behind)))
        behind += raw if len(raw) > 4 else b""
    path.write_bytes((b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, at) + b"".join(parts) + struct.pack(order + "H", len(head)) + entries + b"\0" * 4 + behind)


def picture(kind, h=37, w=53, bands=3, seed=0):
    r = np.random.default_rng(seed)
    x = np.add.outer(np.arange(h) * 3, np.arange(w) * 2)[:, :, None] + r.integers(0, 9, (h, w, bands))
    return (x * 1.25 - 40 if kind[0] == "f" else x % 200).astype(kind)


def read(df, bands=("r", "g", "b")):
    got = {(r.row, r.col): tuple(r[b] for b in bands) for r in df.collect()}
    return got


def wanted(x, r0=0, r1=10**9, c0=0, c1=10**9):
    return {(r, q): tuple(map(float, x[r, q])) for r in range(x.shape[0]) for q in range(x.shape[1]) if r0 <= r < r1 and c0 <= q < c1}


CASES = [("u1", "<", 1, 1, 1, None), ("u2", ">", 8, 2, 1, (16, 32)), ("i2", "<", 5, 2, 2, (16, 16)), ("f4", "<", 8, 3, 1, (32, 16)), ("f8", ">", 5, 1, 2, None), ("f4", ">", 8, 3, 2, None), ("u1", "<", 32773, 1, 1, (16, 16)), ("u4", "<", 5, 1, 1, None)]


@pytest.mark.parametrize("kind,order,compression,predictor,planar,tile", CASES)
def test_every_layout_gives_its_pixels(spark, tmp_path, kind, order, compression, predictor, planar, tile):
    x = picture(kind)
    raster(tmp_path / "a.tif", x, order, compression, predictor, planar, tile)
    assert read(pixels.rgb(files.listing(spark, str(tmp_path)), parts=3)) == wanted(x)


def test_long_lzw_runs_through_all_code_widths():
    r = np.random.default_rng(3)
    for data in (r.integers(0, 256, 60_000).astype(np.uint8).tobytes(), b"ab" * 40_000, b"", b"x"):
        assert tiff.unlzw(lzw(data)) == data


def test_a_window_reads_its_tiles_only(spark, tmp_path):
    """All other tiles are damaged: whoever reads them fails."""
    x = picture("u2", 64, 64)
    raster(tmp_path / "a.tif", x, compression=8, tile=(16, 16))
    raw = bytearray((tmp_path / "a.tif").read_bytes())
    with open(tmp_path / "a.tif", "rb") as f:
        lay = tiff.layout(f)
    for i, (at, n) in enumerate(zip(lay.offsets, lay.sizes, strict=True)):
        if i not in (5, 6):
            raw[at : at + n] = b"\xff" * n
    (tmp_path / "a.tif").write_bytes(raw)
    listing = files.listing(spark, str(tmp_path))
    assert read(pixels.rgb(listing, (18, 31, 20, 45))) == wanted(x, 18, 31, 20, 45)
    with pytest.raises(Exception, match="incorrect header check"):
        pixels.rgb(listing, (0, 64, 0, 64)).collect()
    windows = pixels.chunks(listing).withColumn("own", F.array(*map(F.lit, (20, 21, 16, 48))))
    assert read(pixels.pixels(windows, {"q": 2}), ("q",)) == {k: v[1:2] for k, v in wanted(x, 20, 21, 16, 48).items()}


def test_source_plans_by_chunk_and_takes_conditions(spark, tmp_path):
    x = picture("u2", 64, 64)
    raster(tmp_path / "a.tif", x, compression=8, tile=(16, 16), planar=2)
    spark.dataSource.register(pixels.PixelSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        loaded = lambda **o: spark.read.format("raster_pixels").options(paths=str(tmp_path / "a.tif"), bytes="1", **o).load()
        df = loaded()
        assert df.rdd.getNumPartitions() == 16
        some = df.where("row >= 16 and row < 30 and col > 40 and col <= 47 and band in (1, 3) and value > 5")
        assert some.rdd.getNumPartitions() == 1
        got = {(r.band, r.row, r.col): r.value for r in some.collect()}
        assert got == {(b, r, q): v[b - 1] for (r, q), v in wanted(x, 16, 30, 41, 48).items() for b in (1, 3) if v[b - 1] > 5}
        assert loaded().count() == 64 * 64 * 3
        asked = loaded(window="16,30,41,48", bands="1,3")
        assert asked.rdd.getNumPartitions() == 1 and asked.where("value > 5").count() == len(got)
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_missing_values_sparse_chunks_and_odd_files(spark, tmp_path):
    x = picture("f4", 20, 20, 1)
    x[3, 4], x[5, 6], x[7, 8] = np.nan, np.inf, -9
    raster(tmp_path / "a.tif", x, rows=5, nodata=-9, sparse=(2,))
    got = {(r.row, r.col): (r.value, r.valid) for r in pixels.pixels(pixels.chunks(files.listing(spark, str(tmp_path)))).collect()}
    assert [k for k, (_, v) in sorted(got.items()) if not v and not 10 <= k[0] < 15] == [(3, 4), (5, 6), (7, 8)]
    assert all(got[r, q] == (-9.0, False) for r in range(10, 15) for q in range(20))
    with pytest.raises(Exception, match="fewer than three bands"):
        pixels.rgb(files.listing(spark, str(tmp_path))).collect()
    assert pixels.chunks(files.listing(spark, str(tmp_path)).limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["uint8", "int16", "uint16", "float32", "float64"])
def test_written_files_read_back(spark, tmp_path, kind):
    shapes = {"s1/one.tif": (70, 50), "two.tif": (33, 16)}
    made = {n: picture({"uint8": "u1", "int16": "i2", "uint16": "u2"}.get(kind, "f4"), *s, seed=i) for i, (n, s) in enumerate(shapes.items())}
    rows = [(n, r, q, *map(float, x[r, q])) for n, x in made.items() for r in range(x.shape[0]) for q in range(x.shape[1]) if not (n == "two.tif" and 16 <= r < 32)]
    df = spark.createDataFrame(rows, "name string, row int, col int, r double, g double, b double")
    grids = spark.createDataFrame([(n, x.shape[1], x.shape[0], 2.0, 0.0, 500000.0 + i, 0.0, -2.0, 4600000.0, 32638, 0.0 if i else None) for i, (n, x) in enumerate(made.items())], "name string, width int, height int, a double, b double, c double, d double, e double, f double, epsg int, nodata double")
    out = tmp_path / "out"
    rasters.written(rasters.tiles(df, grids, ("r", "g", "b"), kind, 16), str(out))
    assert sorted(os.path.relpath(os.path.join(d, f), out) for d, _, fs in os.walk(out) for f in fs) == ["s1/one.tif", "two.tif"]
    heads = {r.path.split("/out/")[1]: r for r in files.headers(files.listing(spark, str(out))).collect()}
    assert (heads["two.tif"].crs, heads["two.tif"].c, heads["two.tif"].e, heads["two.tif"].nodata, heads["s1/one.tif"].nodata) == ("EPSG:32638", 500001.0, -2.0, 0.0, None)
    for n, x in made.items():
        got = read(pixels.rgb(files.listing(spark, str(out)).where(F.col("path").endswith(n))))
        want = wanted(x) if n != "two.tif" else {k: v if not 16 <= k[0] < 32 else (0.0, 0.0, 0.0) for k, v in wanted(x).items()}
        assert got == want


def test_large_offsets_and_turned_grids():
    import io

    sizes = [0, 7, 2**33]
    head = tiff.file_head(700, 200, 1, "uint8", 256, sizes, (1.0, 0.5, 10.0, 0.25, -1.0, 20.0), 4326, -1.5)
    lay = tiff.layout(io.BytesIO(head))
    assert head[:4] == b"II\x2b\0" and lay.offsets == (0, len(head), len(head) + 7) and lay.sizes == tuple(sizes)
    assert lay.header[3:11] == (1.0, 0.5, 10.0, 0.25, -1.0, 20.0, -1.5, "EPSG:4326")


def test_an_aborted_job_leaves_no_file(spark, tmp_path):
    df = spark.createDataFrame([("a.tif", 0, 0, 1.0), ("b.tif", 0, 0, 2.0)], "name string, row int, col int, v double")
    grids = spark.createDataFrame([(n, 16, 16, 1.0, 0.0, 0.0, 0.0, -1.0, 0.0, None, None) for n in ("a.tif", "b.tif")], "name string, width int, height int, a double, b double, c double, d double, e double, f double, epsg int, nodata double")
    good = rasters.tiles(df, grids, ("v",), "uint8", 16)
    bad = good.withColumn("kind", F.when(F.col("name") == "b.tif", "no such type").otherwise(F.col("kind")))
    with pytest.raises(Exception, match="no such type|not understood"):
        rasters.written(bad, str(tmp_path / "out"), 4)
    assert not (tmp_path / "out").exists() or os.listdir(tmp_path / "out") == []
    rasters.written(good, str(tmp_path / "out"), 4)
    assert sorted(os.listdir(tmp_path / "out")) == ["a.tif", "b.tif"]
