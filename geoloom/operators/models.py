"""Geometric models of point pairs, one scene a group: thin-plate splines with cross-fitted filtering, homography and affine RANSAC.

A scene's pairs are few (they are thinned before), so a scene is one Arrow batch for numpy.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

RESULT = "scene long, ok boolean, exportable boolean, reason string, n_before int, n_inliers int, inlier_ratio double, n_iters int, median_px double, p90_px double"


class Spline:
    """Thin-plate spline r^2 log r with a plane, smoothed on the diagonal; coordinates are divided by `scale`."""

    def __init__(self, src: np.ndarray, dst: np.ndarray, scale: float, smoothing: float = 0.0) -> None:
        self.scale, self.src = scale, src / scale
        n, p = len(src), np.column_stack((np.ones(len(src)), src / scale))
        a = np.zeros((n + 3, n + 3))
        a[:n, :n] = self.kernel(self.src) + smoothing * np.eye(n)
        a[:n, n:], a[n:, :n] = p, p.T
        self.w = np.linalg.solve(a, np.vstack((dst / scale, np.zeros((3, 2)))))

    def kernel(self, at: np.ndarray) -> np.ndarray:
        r2 = (at[:, None, 0] - self.src[None, :, 0]) ** 2
        r2 += (at[:, None, 1] - self.src[None, :, 1]) ** 2
        out = np.log(np.where(r2 > 0, r2, 1.0))
        out *= r2
        out *= 0.5
        return out

    def __call__(self, pts: np.ndarray) -> np.ndarray:
        at = pts / self.scale
        return (self.kernel(at) @ self.w[:-3] + np.column_stack((np.ones(len(at)), at)) @ self.w[-3:]) * self.scale


def fold_of(pts: np.ndarray, block: int, width: int, height: int, most: int) -> tuple[np.ndarray | None, int]:
    """Fold of each point: whole blocks, the largest first, each to the smallest fold."""
    key = np.clip(pts // block, 0, [max(0, (width - 1) // block), max(0, (height - 1) // block)]).astype(np.int64)
    blocks, back, n = np.unique(key, axis=0, return_inverse=True, return_counts=True)
    if len(blocks) < 2:
        return None, len(blocks)
    load = np.zeros(min(max(2, most), len(blocks)), np.int64)
    to = np.zeros(len(blocks), np.int64)
    for b in np.argsort(-n, kind="stable"):
        to[b] = load.argmin()
        load[to[b]] += n[b]
    return to[back.ravel()], len(load)


def crossfit_residuals(p0: np.ndarray, p1: np.ndarray, width: int, height: int, block: int, folds: int, least_train: int, smoothing: float) -> tuple[np.ndarray | None, str | None]:
    """Mean forward and backward error of each pair under splines fitted to the other folds; or why there is none."""
    fold, n = fold_of(p1, block, width, height, folds)
    if fold is None:
        return None, f"not_enough_spatial_blocks({n})"
    out, scale = np.full(len(p0), np.nan), float(max(width, height))
    for f in range(n):
        test = fold == f
        if (k := int((~test).sum())) < least_train:
            return None, f"too_few_train_matches_in_fold({k})"
        there = Spline(p0[~test], p1[~test], scale, smoothing)(p0[test])
        back = Spline(p1[~test], p0[~test], scale, smoothing)(p1[test])
        out[test] = (np.linalg.norm(there - p1[test], axis=1) + np.linalg.norm(back - p0[test], axis=1)) / 2
    return (out, None) if np.isfinite(out).all() else (None, "non_finite_crossfit_residuals")


#: Rows of a panel in the factorisation below; the sides' product is what numpy does fast.
BLOCK = 256


class Symmetric:
    """A symmetric matrix as panels of rows, each up to its own last column: half the whole's bytes, and no step makes the whole."""

    def __init__(self, panels: list[np.ndarray]) -> None:
        self.panels = panels

    def __iter__(self) -> Iterator[tuple[int, int, np.ndarray]]:
        """First row, end and entries of each panel."""
        for p in self.panels:
            yield p.shape[1] - len(p), p.shape[1], p

    def __matmul__(self, v: np.ndarray) -> np.ndarray:
        out = np.zeros_like(v)
        for j, k, p in self:
            out[j:k] += p @ v[:k]
            out[:j] += p[:, :j].T @ v[j:k]
        return out

    def columns(self, at: np.ndarray) -> np.ndarray:
        """Whole columns at rising places."""
        out = np.empty((self.panels[-1].shape[1], len(at)))
        for j, k, p in self:
            a, b = np.searchsorted(at, (j, k))
            out[j:k, :b] = p[:, at[:b]]
            out[:j, a:b] = p[at[a:b] - j, :j].T
        return out

    def part(self, at: np.ndarray) -> np.ndarray:
        """Rows and columns at rising places."""
        out = np.empty((len(at), len(at)))
        for j, k, p in self:
            a, b = np.searchsorted(at, (j, k))
            out[a:b, :b] = p[np.ix_(at[a:b] - j, at[:b])]
            out[:a, a:b] = out[a:b, :a].T
        return out

    def keep(self, on: np.ndarray) -> None:
        """Leaves the rows and columns of a mask."""
        for i, (j, k, p) in enumerate(self):
            self.panels[i] = p[np.ix_(on[j:k], on[:k])]
        self.panels = [p for p in self.panels if len(p)]

    def turn(self, v: np.ndarray, t: np.ndarray) -> None:
        """With q = 1 - v t v', makes it q' a q."""
        p = self @ v
        w = p @ t - v @ (t.T @ (v.T @ p) @ t) / 2
        left, right = np.hstack((v, w)), np.hstack((w, v)).T
        for j, k, p in self:
            p -= left[j:k] @ right[:, :k]

    def invert(self, first: int = 0) -> None:
        """Inverse of a positive definite matrix, panels before `first` left aside (zeros there): Cholesky by block columns, the factor's inverse by block rows, and their product."""
        own = list(self)[first:]
        for i, (j, k, p) in enumerate(own):
            for _, _, q in own[i:]:
                q[:, j:k] -= q[:, :j] @ p[:, :j].T
            p[:, j:k] = inv = np.tril(np.linalg.inv(np.linalg.cholesky(p[:, j:k])))
            for _, _, q in own[i + 1 :]:
                q[:, j:k] = q[:, j:k] @ inv.T
        for i, (j, k, p) in enumerate(own):  # diagonal blocks are inverted already
            sums = np.zeros((k - j, j))
            for g, h, q in own[:i]:
                sums[:, :h] += p[:, g:h] @ q
            p[:, :j] = -p[:, j:k] @ sums
        for i, (j, k, p) in enumerate(own):
            p[:] = sum(q[:, j:k].T @ q[:, :k] for _, _, q in own[i:])


def inverse(a: np.ndarray) -> np.ndarray:
    """Inverse of a symmetric positive definite matrix."""
    m = Symmetric([a[j : j + BLOCK, : min(j + BLOCK, len(a))].copy() for j in range(0, len(a), BLOCK)])
    m.invert()
    return m.part(np.arange(len(a)))


class LeftOut:
    """Errors of a spline at points that it is not fitted to, for any such set, from one factorisation.

    With B the block of the inverse of the spline's system that belongs to the points, and w = B y its weights, the error at a left-out set S is
    the solution of B_SS e = w_S. Points are taken out of the whole by the same rule, so all rounds of a filter share one inverse.
    """

    def __init__(self, src: np.ndarray, dst: np.ndarray, scale: float, smoothing: float) -> None:
        at = src / scale
        self.scale, n = scale, len(at)
        # reflections that turn the plane's three columns to the first three places leave a positive definite rest
        (h, tau), v = np.linalg.qr(np.column_stack((np.ones(n), at)), mode="raw"), np.zeros((n, 3))
        for i in range(3):
            v[i + 1 :, i], v[i, i] = h[i, i + 1 :], 1.0
        if min(abs(h[i, i]) for i in range(3)) < 1e-12:
            raise np.linalg.LinAlgError("points on one line")
        t = np.zeros((3, 3))
        for i in range(3):
            t[:i, i], t[i, i] = -tau[i] * (t[:i, :i] @ (v[:, :i].T @ v[:, i])), tau[i]
        cuts = [0, *range(3, n, BLOCK), n]  # the first three places are a panel of their own
        b = Symmetric([self.kernel(at, j, k, smoothing) for j, k in pairwise(cuts)])
        b.turn(v, t)
        for i, (_, _, p) in enumerate(b):
            p[:, : 3 if i else None] = 0
        b.invert(1)
        b.turn(v, t.T)
        self.b, self.w, self.file = b, b @ (dst / scale), tempfile.TemporaryFile()

    @staticmethod
    def kernel(at: np.ndarray, j: int, k: int, smoothing: float) -> np.ndarray:
        """A panel of the kernel, a few rows at once."""
        out = np.empty((k - j, k))
        for i in range(j, k, 16):
            m = min(i + 16, k)
            r2 = (at[i:m, None, 0] - at[None, :k, 0]) ** 2
            r2 += (at[i:m, None, 1] - at[None, :k, 1]) ** 2
            rows = out[i - j : m - j]
            np.log(np.where(r2 > 0, r2, 1.0), out=rows)
            rows *= r2
            rows *= 0.5
        out[np.arange(k - j), np.arange(j, k)] += smoothing
        return out

    def park(self) -> LeftOut:
        """Puts the matrix into a file of the task's own, which goes with this object."""
        self.file.seek(0)
        for p in self.b.panels:
            np.save(self.file, p)
        self.parked, self.b = len(self.b.panels), None
        return self

    @contextmanager
    def at_hand(self) -> Iterator[None]:
        """The parked matrix in memory, and parked again afterwards: of several sides only one takes memory."""
        self.file.seek(0)
        self.b = Symmetric([np.load(self.file) for _ in range(self.parked)])
        yield
        self.park()

    def errors(self, out: np.ndarray) -> np.ndarray:
        """Error vectors at the left-out points (a mask)."""
        return np.linalg.solve(self.b.part(np.flatnonzero(out)), self.w[out]) * self.scale

    def drop(self, out: np.ndarray) -> None:
        """Takes points (a mask) out for good, so many at once as a panel has rows."""
        at = np.flatnonzero(out)
        for i in range(0, len(at), BLOCK):
            own = at[i : i + BLOCK]
            cut = self.b.columns(own)
            gone = np.linalg.solve(cut[own], np.column_stack((cut.T, self.w[own])))
            self.w -= cut @ gone[:, -2:]
            for j, k, p in self.b:
                p -= cut[j:k] @ gone[:, :k]
        self.b.keep(~out)
        self.w = self.w[~out]


def fold_problem(fold: np.ndarray | None, n: int, least_train: int) -> str | None:
    """Why folds can't be cross-fitted."""
    if fold is None:
        return f"not_enough_spatial_blocks({n})"
    few = [k for k in (len(fold) - np.bincount(fold, minlength=n)).tolist() if k < least_train]
    return f"too_few_train_matches_in_fold({few[0]})" if few else None


def threshold(r: np.ndarray, least: float, k: float) -> float:
    med = np.median(r)
    return float(max(least, med + k * 1.4826 * np.median(np.abs(r - med))))


def _rows(pdf: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    pdf = pdf.sort_values("ord")
    return pdf[["x0", "y0"]].to_numpy(float), pdf[["x1", "y1"]].to_numpy(float)


def _result(scene: int, n: int, inliers: int, need: int, strong: int, name: str, reason: str | None, iters: int, r: np.ndarray | None) -> pd.DataFrame:
    export = reason is None and inliers >= need
    reason = reason or (None if export else f"too_few_{name}_inliers({inliers})")
    q = (None, None) if r is None or not len(r) else (float(np.median(r)), float(np.percentile(r, 90)))
    return pd.DataFrame([(scene, export and inliers >= strong, export, reason, n, inliers, inliers / n if n else None, iters, *q)], columns=[x.split()[0] for x in RESULT.split(", ")])


def distinct_moving(p0: np.ndarray, step: float = 0.25) -> int:
    return len(np.unique(np.rint(p0 / step), axis=0)) if len(p0) else 0


def spline_filter(m: DataFrame, width: int, height: int, block: int = 512, folds: int = 5, least_train: int = 6, least_total: int = 8, smoothing: float = 1e-3, rounds: int = 5, fraction: float = 0.2, least_px: float = 6.0, k: float = 3.0, need: int = 12, strong: int = 80, scenes_at_once: int = 200) -> DataFrame:
    """By scene: drops the worst pairs by cross-fitted residual, round by round, until none is above the robust threshold. A scene of n pairs takes 4 n^2 bytes in its task, and 8 n^2 of its disk."""

    def residuals(p1: np.ndarray, sides: list[LeftOut], gone: np.ndarray | None) -> tuple[np.ndarray | None, str | None]:
        fold, n = fold_of(p1, block, width, height, folds)
        if why := fold_problem(fold, n, least_train):
            return None, why
        out = np.zeros(len(p1))
        for side in sides:
            with side.at_hand():
                if gone is not None:
                    side.drop(gone)
                for f in range(n):
                    test = fold == f
                    out[test] += np.linalg.norm(side.errors(test), axis=1) / 2
        return (out, None) if np.isfinite(out).all() else (None, "non_finite_crossfit_residuals")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        p0, p1 = _rows(pdf)
        on, last, reason, iters, sides, gone = np.arange(len(p0)), None, None, 0, [], None
        for _ in range(rounds):
            if len(on) < least_total:
                reason = f"too_few_matches_before_iteration({len(on)})"
                break
            try:
                r, why = None, fold_problem(*fold_of(p1[on], block, width, height, folds), least_train)
                if not why:
                    if not sides:
                        scale = float(max(width, height))
                        sides = [LeftOut(a, b, scale, smoothing).park() for a, b in ((p0, p1), (p1, p0))]
                    r, why = residuals(p1[on], sides, gone)
            except (np.linalg.LinAlgError, ValueError, FloatingPointError) as e:  # a scene that fails has its reason, and the others go on
                reason = f"tps_filter_failed:{e}"
                break
            if r is None:
                reason = f"tps_crossfit_failed:{why}"
                break
            last, iters = r, iters + 1
            bad = np.flatnonzero(r > threshold(r, least_px, k))
            if not len(bad):
                break
            gone = np.zeros(len(on), bool)
            gone[bad[np.argsort(-r[bad], kind="stable")][: max(1, int(len(on) * fraction))]] = True
            on = on[~gone]
            if len(on) < least_total:
                reason = f"too_few_matches_after_tps_clean({len(on)})"
                break
        return _result(int(key[0]), len(p0), 0 if reason else distinct_moving(p0[on]), need, strong, "tps", reason, iters, last)

    # rows say nothing of the work: without a number of its own, small scenes would be put together in one task
    return m.repartition(scenes_at_once, "scene").groupBy("scene").applyInPandas(run, RESULT)


def homography(p0: np.ndarray, p1: np.ndarray) -> np.ndarray | None:
    """Least-squares homography by the direct linear transform on normalised points."""

    def norm(p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mid = p.mean(axis=0)
        s = np.sqrt(2) / max(np.linalg.norm(p - mid, axis=1).mean(), 1e-12)
        return (p - mid) * s, np.array([[s, 0, -s * mid[0]], [0, s, -s * mid[1]], [0, 0, 1]])

    (a, ta), (b, tb) = norm(p0), norm(p1)
    one, zero = np.ones(len(a)), np.zeros((len(a), 3))
    ah = np.column_stack((a, one))
    rows = np.vstack((np.hstack((ah, zero, -b[:, :1] * ah)), np.hstack((zero, ah, -b[:, 1:] * ah))))
    h = np.linalg.inv(tb) @ np.linalg.svd(rows, full_matrices=len(rows) < 9)[2][-1].reshape(3, 3) @ ta
    return h / h[2, 2] if abs(h[2, 2]) > 1e-12 and np.isfinite(h).all() else None


def affine(p0: np.ndarray, p1: np.ndarray) -> np.ndarray | None:
    """Least-squares affine map as a homography."""
    x, _, rank, _ = np.linalg.lstsq(np.column_stack((p0, np.ones(len(p0)))), p1, rcond=None)
    return np.vstack((x.T, [0, 0, 1])) if rank == 3 else None


def residuals(h: np.ndarray, p0: np.ndarray, p1: np.ndarray) -> np.ndarray:
    q = np.column_stack((p0, np.ones(len(p0)))) @ h.T
    with np.errstate(divide="ignore", invalid="ignore"):
        r = np.linalg.norm(q[:, :2] / q[:, 2:] - p1, axis=1)
    return np.where(np.isfinite(r), r, np.inf)


def ransac(p0: np.ndarray, p1: np.ndarray, kind: str, px: float, iters: int, sure: float, seed: int) -> np.ndarray | None:
    """Model with the most inliers among seeded random minimal sets, fitted again to them; the number of sets falls as inliers rise."""
    fit, need = (homography, 4) if kind == "homography" else (affine, 3)
    if len(p0) < need:
        return None
    rng, best, most, tried = np.random.default_rng(seed), None, 0, 0
    while tried < iters:
        tried += 1
        pick = rng.choice(len(p0), need, replace=False)
        h = fit(p0[pick], p1[pick])
        if h is None:
            continue
        ok = residuals(h, p0, p1) <= px
        if (n := int(ok.sum())) > most:
            best, most = ok, n
            share = (n / len(p0)) ** need
            iters = min(iters, int(np.ceil(np.log(1 - sure) / np.log(max(1 - share, 1e-300)))) if share < 1 else tried)
    if best is None or most < need:
        return None
    for _ in range(10):
        h = fit(p0[best], p1[best])
        ok = residuals(h, p0, p1) <= px if h is not None else best
        if h is None or (ok == best).all():
            break
        best = ok
    return h


def ransac_filter(m: DataFrame, kind: str = "homography", px: float = 8.0, iters: int = 5000, sure: float = 0.999, need: int = 12, strong: int = 80, seed: int = 7) -> DataFrame:
    """By scene: inliers of a robust model. Residuals are those of the inliers before moving points that round alike are dropped."""

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        p0, p1 = _rows(pdf)
        h = ransac(p0, p1, kind, px, iters, sure, seed + int(key[0]))
        if h is None:
            return _result(int(key[0]), len(p0), 0, need, strong, kind, f"{kind}_ransac_failed", 1, None)
        r = residuals(h, p0, p1)
        ok = r <= px
        return _result(int(key[0]), len(p0), distinct_moving(p0[ok]), need, strong, kind, None, 1, r[ok])

    return m.groupBy("scene").applyInPandas(run, RESULT)


def spline_warp(points: DataFrame, targets: DataFrame, scale: float, smoothing: float = 0.0) -> DataFrame:
    """Source place of each target place by the spline through a scene's control points (sx, sy from mx, my)."""

    def run(key: tuple, own: pd.DataFrame, at: pd.DataFrame) -> pd.DataFrame:
        if len(own) < 3 or not len(at):
            return pd.DataFrame({"scene": [], "id": [], "sx": [], "sy": []}).astype({"scene": "int64", "id": "int64"})
        own = own.sort_values("ord")
        q = Spline(own[["mx", "my"]].to_numpy(float), own[["sx", "sy"]].to_numpy(float), scale, smoothing)
        out = np.vstack([q(x) for x in np.array_split(at[["mx", "my"]].to_numpy(float), max(1, len(at) // 2000))])
        return pd.DataFrame({"scene": int(key[0]), "id": at["id"].to_numpy(), "sx": out[:, 0], "sy": out[:, 1]})

    return points.groupBy("scene").cogroup(targets.groupBy("scene")).applyInPandas(run, "scene long, id long, sx double, sy double")
