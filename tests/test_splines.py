"""Left-out errors from one factorisation against splines fitted anew, and the filter against its direct form."""

import tracemalloc

import numpy as np
import pandas as pd
import pytest

from geoloom.operators import models


def scene(n, seed, far=0):
    r = np.random.default_rng(seed)
    p0 = r.uniform(0, 4000, (n, 2))
    p1 = p0 + np.column_stack((20 * np.sin(p0[:, 1] / 600), 15 * np.cos(p0[:, 0] / 500))) + r.normal(0, 1, (n, 2))
    p1[:far] += r.uniform(30, 90, (far, 2))
    return p0, np.clip(p1, 0, 3999)


def test_inverse():
    for n in (1, 255, 256, 600):
        r = np.random.default_rng(n)
        a = r.normal(size=(n, n))
        a = a @ a.T + n * np.eye(n)
        assert np.abs(models.inverse(a.copy()) @ a - np.eye(n)).max() < 1e-9


@pytest.mark.parametrize("smoothing", [1e-3, 1e-6])
def test_left_out_errors_equal_fits_without_the_points(smoothing):
    p0, p1 = scene(700, 1)
    side, keep = models.LeftOut(p0, p1, 4000.0, smoothing), np.arange(700) % 9 > 0
    side.drop(~keep)
    a, b = p0[keep], p1[keep]
    out = np.arange(len(a)) % 5 == 2
    want = b[out] - models.Spline(a[~out], b[~out], 4000.0, smoothing)(a[out])
    assert np.abs(side.errors(out) - want).max() < 1e-6


def direct(p0, p1, rounds=5):
    """The filter with splines fitted anew in each fold and round."""
    on = np.arange(len(p0))
    for i in range(rounds):
        r, why = models.crossfit_residuals(p0[on], p1[on], 4000, 4000, 512, 5, 6, 1e-3)
        assert why is None
        bad = np.flatnonzero(r > models.threshold(r, 6.0, 3.0))
        if not len(bad):
            break
        on = np.delete(on, bad[np.argsort(-r[bad], kind="stable")][: max(1, int(len(on) * 0.2))])
    return models.distinct_moving(p0[on]), i + 1, np.median(r)


def test_filter_equals_its_direct_form(spark):
    scenes = {1: scene(300, 2, 40), 2: scene(500, 3), 3: scene(260, 4, 90), 4: scene(5, 5), 5: (np.full((40, 2), 7.0), np.full((40, 2), 7.0))}
    rows = pd.concat([pd.DataFrame({"scene": k, "ord": np.arange(len(a)), "x0": a[:, 0], "y0": a[:, 1], "x1": b[:, 0], "y1": b[:, 1]}) for k, (a, b) in scenes.items()])
    got = {r.scene: r for r in models.spline_filter(spark.createDataFrame(rows), 4000, 4000).collect()}
    for k in (1, 2, 3):
        n, iters, median = direct(*scenes[k])
        assert (got[k].n_inliers, got[k].n_iters, got[k].reason) == (n, iters, None) and got[k].median_px == pytest.approx(median, abs=1e-6)
    assert got[1].n_inliers < 300 and got[4].reason == "too_few_matches_before_iteration(5)" and got[5].reason == "tps_crossfit_failed:not_enough_spatial_blocks(1)"


def test_panels_equal_the_whole_matrix():
    r = np.random.default_rng(6)
    a = r.normal(size=(40, 40))
    a = a @ a.T + 40 * np.eye(40)
    cuts = [0, 3, 20, 36, 40]
    m = models.Symmetric([a[j:k, :k].copy() for j, k in zip(cuts, cuts[1:])])
    at, v, t = np.array([0, 2, 3, 19, 20, 39]), r.normal(size=(40, 3)), r.normal(size=(3, 3))
    assert np.allclose(m @ v, a @ v) and (m.columns(at) == a[:, at]).all() and (m.part(at) == a[np.ix_(at, at)]).all()
    on = np.ones(40, bool)
    on[3:20] = on[37] = False  # a whole panel goes
    m.keep(on)
    assert (m.part(np.arange(on.sum())) == a[np.ix_(on, on)]).all()
    m.turn(v[on], t)
    q = np.eye(on.sum()) - v[on] @ t @ v[on].T
    assert np.allclose(m.part(np.arange(on.sum())), q.T @ a[np.ix_(on, on)] @ q)


def test_sides_take_half_a_matrix_and_one_at_a_time():
    n = 1800
    p0, p1 = scene(n, 7)
    tracemalloc.start()
    try:
        sides = [models.LeftOut(a, b, 4000.0, 1e-3).park() for a, b in ((p0, p1), (p1, p0))]
        gone, out = np.arange(n) % 6 == 1, np.arange(n - n // 6) % 5 == 2
        for side in sides:
            with side.at_hand():
                side.drop(gone)
                got = side.errors(out)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 12 * n**2  # 32 n^2 when matrices were whole and both in memory
    a, b = p1[~gone], p0[~gone]
    assert np.abs(got - (b[out] - models.Spline(a[~out], b[~out], 4000.0, 1e-3)(a[out]))).max() < 1e-6
