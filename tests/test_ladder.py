"""Robust models and the warp get as many pairs as the reference's ladder leaves them."""

import random

import numpy as np

from geoloom.adapters import IMAGE, v_matches
from geoloom.operators import points
from geoloom.plans import points as plans
from geoloom.plans import space

SF = "/root/testdata/sf0.01"


def laddered(rows):
    """By scene: how many of (scene, ord, x1, y1, conf) pass the gate and eight a cell."""
    out = {}
    for scene in {r.scene for r in rows}:
        own = [r for r in rows if r.scene == scene]
        cut = np.float32(max(0.2, np.percentile([r.conf for r in own], 40)))
        cells = {}
        for r in own:
            if np.float32(r.conf) >= cut and 0 <= r.x1 < IMAGE and 0 <= r.y1 < IMAGE:
                k = (r.x1 // 128, r.y1 // 128)
                cells[k] = cells.get(k, 0) + 1
        out[scene] = sum(min(8, n) for n in cells.values())
    return out


def test_models_see_the_whole_ladder(spark):
    want = laddered(v_matches(spark, SF).collect())
    assert min(want.values()) > 256
    for name in ("q_ransac_homography", "q_ransac_affine", "q_tps_filter"):
        assert {r.scene: r.n_before for r in plans.QUERIES[name][0](spark, SF).collect()} == want


def test_the_warp_takes_the_reference_s_control_points(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(space.models, "spline_warp", lambda own, at, *a: seen.append(own) or at)
    space.tps_warp(spark, SF)
    assert {r["count"] for r in seen[0].groupBy("scene").count().collect()} == {1200}


def test_balanced_drops_late_rounds_before_a_scene_is_sorted(spark):
    r = random.Random(1)
    rows = [(1, i, r.uniform(0, 10), r.uniform(0, 10), r.random()) for i in range(500)] + [(1, 900, 90.0, 90.0, 0.1)]
    got = points.balanced(spark.createDataFrame(rows, "scene int, ord long, x1 double, y1 double, conf double"), 100, 100, 4, 20).orderBy("place")
    best = [x[1] for x in sorted(rows[:500], key=lambda x: -x[4])]
    assert [x.ord for x in got.collect()] == [best[0], 900, *best[1:19]]
    assert "round" in (plan := got._jdf.queryExecution().optimizedPlan().toString()) and "<= 20" in plan
