"""Inputs of scenes: folders, legacy fallback, original and georeferenced bands, flags."""

import pytest

from geoloom.operators import catalog


def paths(spark, rows, names="scene string, path string"):
    return spark.createDataFrame(rows, names)


def test_scene_inputs_with_legacy_fallback(spark):
    now = paths(spark, [("a", "/n/a/template_rgb_native.tif"), ("a", "/n/a/template_rgb_utm.tif"), ("a", "/n/a/sentinel2_rgb_utm_ref_W.tif"), ("a", "/n/a/sentinel2_rgb_utm.tif"), ("b", "/n/b/template_rgb_native.tif"), ("c", "/n/c/x.tif")])
    old = paths(spark, [("a", "/o/a/template_rgb_utm.tif"), ("b", "/o/b/template_rgb_utm_1.tif"), ("b", "/o/b/sentinel2_rgb_utm.tif"), ("d", "/o/d/sentinel2_rgb_utm.tif")])
    got = {r.scene: (r.template, r.reference, r.legacy) for r in catalog.scene_inputs(now, old).collect()}
    assert got == {"a": ("/n/a/template_rgb_utm.tif", "/n/a/sentinel2_rgb_utm.tif", False), "b": ("/o/b/template_rgb_utm_1.tif", "/o/b/sentinel2_rgb_utm.tif", True), "c": (None, None, False), "d": (None, None, False)}


def test_bands(spark):
    files = paths(spark, [("a", "/x/a_R.tif"), ("a", "/x/a_N.tiff"), ("a", "/x/a_1QK_B.tif"), ("a", "/x/a_B.tif"), ("a", "/x/a_readme.txt")])
    assert [(r.band, r.n) for r in catalog.original_bands(files).orderBy("n").collect()] == [("B", 1), ("N", 2), ("R", 3)]
    done = paths(spark, [("a", "/y/a_R_georef_tps.tif"), ("a", "/y/a_v2_R_georef_tps.tif"), ("a", "/y/a_v1_G_georef_tps.tif"), ("a", "/y/a_v1_B_georef_tps.tif"), ("a", "/y/a_v2_B_georef_tps.tif")])
    assert {(r.scene, r.band, r.path, r.error) for r in catalog.georeferenced_band(done).collect()} == {("a", "R", "/y/a_R_georef_tps.tif", None), ("a", "G", "/y/a_v1_G_georef_tps.tif", None), ("a", "B", None, "expected one band, found 2")}


def test_aligned_root(spark):
    files = paths(spark, [("/r", "/r/aligned/s/1.json"), ("/r", "/r/s/2.json"), ("/q", "/q/s/3.json")], "root string, path string")
    assert {(r.path, r.base) for r in catalog.aligned_root(files).collect()} == {("/r/aligned/s/1.json", "/r/aligned"), ("/q/s/3.json", "/q")}


def test_flags_for_all_scenes():
    assert catalog.everywhere(False, None, None) is None and catalog.everywhere(True, 0.5, ["w", "W", "c"]) == (0.5, ["C", "W"]) and len(catalog.everywhere(True, 0.0, None)[1]) == 9
    for bad in ((False, 0.5, None), (False, None, ["N"]), (True, None, None), (True, 1.0, None), (True, 0.5, ["up"])):
        with pytest.raises(ValueError):
            catalog.everywhere(*bad)


def test_entries_that_are_no_objects(spark):
    rows = [("a", "[1]"), ("b", '{"overlap": 0.5, "directions": "N"}'), ("c", '{"directions": ["N"]}'), ("d", '{"overlap": 0.25, "directions": []}')]
    got = {r.scene: (r.directions, r.error) for r in catalog.checked_settings(paths(spark, rows, "scene string, entry string")).collect()}
    assert got["a"][1] == "no object" and got["b"][1] == "directions are no list" and got["c"][1] == "overlap is no number in [0, 1)" and got["d"] == (["C"], None)


def test_slices_equal_python(spark):
    names = [f"s{i:03}" for i in range(90)]
    df = spark.createDataFrame([(n,) for n in reversed(names)], "scene string").repartition(7)
    for a, b in ((None, None), (5, None), (-10, None), (3, 8), (None, -80), (-200, 4), (80, 200), (50, 40), (100, None)):
        assert [r.scene for r in catalog.batch(df, a, b).collect()] == names[a:b]
