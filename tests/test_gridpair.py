"""Grid pairs from files on different grids and in different zones to what a matcher takes."""

import numpy as np
import pytest

from geoloom.operators import gridpair, warp
from geoloom.sources import files, pixels
from tests.test_pixels import raster


def test_pair_on_the_reference_grid(spark, tmp_path):
    r = np.random.default_rng(2)
    ref = r.integers(1, 4000, (48, 48, 3)).astype("u2")
    mov = np.repeat(np.repeat(ref[:, :, :], 2, axis=0), 2, axis=1)
    mov[10:20, 30:44] = 0
    for name, x in (("mov", mov), ("ref", ref)):
        (tmp_path / name).mkdir()
        raster(tmp_path / name / "s.tif", x, compression=8, tile=(16, 16), nodata=0)
    read = {n: pixels.rgb(files.listing(spark, str(tmp_path / n))).selectExpr("'s' AS name", "row", "col", "r", "g", "b", "valid") for n in ("mov", "ref")}
    grids = {n: spark.createDataFrame([("s", side, side, res, 0.0, 500000.0, 0.0, -res, 4400000.0, 32638)], warp.GRID) for n, side, res in (("mov", 96, 5.0), ("ref", 48, 10.0))}
    df = gridpair.loaded(read["mov"], grids["mov"], read["ref"], grids["ref"], least=100, side=32)
    got = {(x.row, x.col): x for x in df.collect()}
    assert len(got) == 48 * 48
    low, high = np.percentile(ref[:, :, 0].astype(float), (2, 98))
    want = np.clip((ref[:, :, 0] - low) / (high - low + 1e-8), 0, 1)
    assert all(abs(got[k].ref_r01 - want[k]) < 1e-9 and got[k].ref_r8 == int(np.rint(want[k] * 255)) and got[k].ref_valid for k in got)
    hole = {(a, b) for a in range(48) for b in range(48) if 5 <= a < 10 and 15 <= b < 22}
    assert {k for k, x in got.items() if not x.mov_valid} == hole
    assert all(got[k].mov_r01 == 0 and got[k].mov_r8 == 0 for k in hole)
    assert all(got[k].mov_r == pytest.approx(ref[k][0]) for k in got if not any((k[0] + i, k[1] + j) in hole for i in (-1, 0, 1) for j in (-1, 0, 1)))
    single = gridpair.loaded(read["mov"], grids["mov"], read["ref"], grids["ref"], least=100, side=32, as_grey=True)
    one = {(x.row, x.col): x for x in single.collect()}
    assert one[40, 40].ref_grey == pytest.approx(float(np.dot(ref[40, 40], (0.2989, 0.5870, 0.1140))), rel=1e-6)
    with pytest.raises(Exception, match="too few valid pixels"):
        gridpair.loaded(read["mov"], grids["mov"], read["ref"], grids["ref"], least=10_000, side=32).collect()
