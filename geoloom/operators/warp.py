"""Pixels warped to another grid: between reference systems, or by a spline through control points.

Images are tables of blocks. Where a target block's pixels lie in the source is worked out exactly at the nodes of a coarse lattice,
which is refined until straight lines between nodes are within BOUND pixels of the exact mapping at all middles; so a spline of
a thousand points is summed at some hundred nodes a block, not at every pixel. Each target block is joined with the source blocks that
its lattice covers, each such pair gives weights and weighted values, and these are added up by target block: a pixel whose
neighbours lie in two blocks gets its share from both. No join is by pixel, and a task holds one source and one target block at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions import geodesy
from geoloom.functions.columns import c
from geoloom.operators.models import Spline

#: Pixels that the lattice may be off, and cells a side to begin and to end with (at the end a block's every pixel is a node).
BOUND, CELLS = 0.125, 4
SIDE = 256
#: Less weight than rounding of places may give counts as none.
LEAST_WEIGHT = 1e-9
GRID = "name string, width int, height int, a double, b double, c double, d double, e double, f double, epsg int"
AFFINE = tuple("abcdef")


def blocks(pixels: DataFrame, bands: tuple[str, ...], side: int = SIDE) -> DataFrame:
    """name, brow, bcol, data (doubles, bands x side x side, NaN where a pixel is missing or not valid) of pixel rows (name, row, col, bands, and valid if there is one)."""
    ok = c("valid") if "valid" in pixels.columns else F.lit(True)
    at = [F.call_function("div", c(k), F.lit(side)).cast("int").alias(b) for k, b in (("row", "brow"), ("col", "bcol"))]
    rows = pixels.select("name", *at, (c("row") % side).alias("row"), (c("col") % side).alias("col"), *[F.when(ok, c(b).cast("double")).alias(f"v{i}") for i, b in enumerate(bands)])

    def run(key: tuple, t: pa.Table) -> pa.Table:
        x = np.full((len(bands), side, side), np.nan)
        r, q = t.column("row").to_numpy(), t.column("col").to_numpy()
        for i in range(len(bands)):
            x[i, r, q] = t.column(f"v{i}").to_numpy()
        name, brow, bcol = (k.as_py() for k in key)
        return pa.Table.from_pylist([{"name": name, "brow": brow, "bcol": bcol, "data": x.tobytes()}], pa.schema([("name", pa.string()), ("brow", pa.int32()), ("bcol", pa.int32()), ("data", pa.binary())]))

    return rows.groupBy("name", "brow", "bcol").applyInArrow(run, "name string, brow int, bcol int, data binary")


def targets(grids: DataFrame, side: int = SIDE) -> DataFrame:
    """The columns of grids (GRID), and trow, tcol of each block of each."""
    n = lambda k: F.sequence(F.lit(0), F.call_function("div", c(k) - 1, F.lit(side)).cast("int"))
    return grids.withColumn("trow", F.explode(n("height"))).withColumn("tcol", F.explode(n("width")))


def lattice(exact: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]], row: int, col: int, height: int, width: int, bound: float = BOUND) -> np.ndarray:
    """Source place (x, y) of each pixel's centre of a target block, (2, height, width), within `bound` pixels of exact(x, y)."""
    cells = CELLS
    while True:
        nodes = [np.linspace(0, n, min(cells, n) + 1) for n in (height, width)]
        yy, xx = np.meshgrid(nodes[0] + row, nodes[1] + col, indexing="ij")
        at = np.stack(exact(xx.ravel(), yy.ravel())).reshape(2, *xx.shape)
        if cells >= max(height, width):
            break
        my, mx = (np.repeat((n[:-1] + n[1:]) / 2, 3) for n in nodes)
        for m, n in ((my, nodes[0]), (mx, nodes[1])):  # the middles of cells and of their edges
            m[0::3], m[2::3] = n[:-1], n[1:]
        gy, gx = np.meshgrid(my, mx, indexing="ij")
        want = np.stack(exact(gx.ravel() + col, gy.ravel() + row)).reshape(2, *gx.shape)
        off = np.hypot(*(between_nodes(at, nodes, my, mx) - want))
        if np.isfinite(off).all() and off.max() <= bound / 2:  # the most lies near a middle: half of the bound is left for what is not looked at
            break
        cells *= 2
    return between_nodes(at, nodes, np.arange(height) + 0.5, np.arange(width) + 0.5)


def between_nodes(at: np.ndarray, nodes: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Straight lines between the lattice's nodes, first along columns, then along rows."""

    def weights(n: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        i = np.clip(np.searchsorted(n, x, side="right") - 1, 0, len(n) - 2)
        return i, (x - n[i]) / (n[i + 1] - n[i])

    (i, u), (j, v) = weights(nodes[0], rows), weights(nodes[1], cols)
    along = at[:, :, j] * (1 - v) + at[:, :, j + 1] * v
    return along[:, i] * (1 - u)[:, None] + along[:, i + 1] * u[:, None]


def apply(t: tuple[float, ...], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return t[0] * x + t[1] * y + t[2], t[3] * x + t[4] * y + t[5]


def invert(t: tuple[float, ...], x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    det, dx, dy = t[0] * t[4] - t[1] * t[3], x - t[2], y - t[5]
    return (t[4] * dx - t[1] * dy) / det, (t[0] * dy - t[3] * dx) / det


def by_system(row: dict) -> Callable:
    """From target pixel through both reference systems to source pixel (row: the target's grid, and the source's with s_ before)."""
    own, source = tuple(row[k] for k in AFFINE), tuple(row[f"s_{k}"] for k in AFFINE)
    return lambda x, y: invert(source, *geodesy.between(*apply(own, x, y), row["epsg"], row["s_epsg"]))


def by_spline(row: dict) -> Callable:
    """From target pixel to map, and by the spline of the row's points and weights to source pixel."""
    own = tuple(row[k] for k in AFFINE)
    q = Spline.__new__(Spline)
    q.scale, q.src, q.w = row["scale"], np.asarray(row["points"], float).reshape(-1, 2), np.asarray(row["weights"], float).reshape(-1, 2)

    def run(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.column_stack(apply(own, x, y)) - np.array([row["mid_x"], row["mid_y"]])
        return tuple(np.concatenate([q(p) for p in np.array_split(at, max(1, len(at) // 2000))]).T)

    return run


def covered(blocks: DataFrame, mapping: Callable[[dict], Callable], side: int, source_side: int, kernel: str, bound: float) -> DataFrame:
    """name, trow, tcol, height, width, brow, bcol, places: each target block with each source block that it draws on, and where its pixels lie in the source (float32 from the source block's corner)."""
    reach = 1 if kernel == "bilinear" else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                top, left = row["trow"] * side, row["tcol"] * side
                h, w = min(side, row["height"] - top), min(side, row["width"] - left)
                at = lattice(mapping(row), top, left, h, w, bound)
                u, v = at[0] - reach / 2, at[1] - reach / 2
                low, high = (np.floor(k) for k in (u, v)), (np.floor(k) + reach for k in (u, v))
                (x0, y0), (x1, y1) = low, high
                seen = np.isfinite(u) & np.isfinite(v) & (x1 >= 0) & (y1 >= 0) & (x0 < row["s_width"]) & (y0 < row["s_height"])
                if not seen.any():
                    continue
                corners = {(int(r), int(q)) for ys in (y0, y1) for xs in (x0, x1) for r, q in np.unique(np.stack((np.clip(ys[seen], 0, row["s_height"] - 1) // source_side, np.clip(xs[seen], 0, row["s_width"] - 1) // source_side), axis=1), axis=0)}
                places = np.stack((np.where(seen, u, np.nan), np.where(seen, v, np.nan))).tobytes()
                rows = [{"name": row["name"], "trow": row["trow"], "tcol": row["tcol"], "height": h, "width": w, "brow": r, "bcol": q, "places": places} for r, q in sorted(corners)]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([("name", pa.string()), *[(k, pa.int32()) for k in ("trow", "tcol", "height", "width", "brow", "bcol")], ("places", pa.binary())]))

    return blocks.mapInArrow(run, "name string, trow int, tcol int, height int, width int, brow int, bcol int, places binary")


def shares(row: dict, bands: int, side: int, kernel: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pixels of the target block that the source block has a share in (numbers), and for each band weights and weighted values."""
    u, v = np.frombuffer(row["places"]).reshape(2, -1)
    x = np.frombuffer(row["data"]).reshape(bands, side, side)
    c0, r0 = np.floor(u), np.floor(v)
    near = [(0, 0, np.ones(len(u)))] if kernel == "nearest" else [(i, j, (v - r0 if i else 1 - (v - r0)) * (u - c0 if j else 1 - (u - c0))) for i in (0, 1) for j in (0, 1)]
    weight, value = np.zeros((bands, len(u))), np.zeros((bands, len(u)))
    for i, j, w in near:
        r, q = r0 + i - row["brow"] * side, c0 + j - row["bcol"] * side
        with np.errstate(invalid="ignore"):
            at = np.flatnonzero((w > LEAST_WEIGHT) & (r >= 0) & (r < side) & (q >= 0) & (q < side))
        got = x[:, r[at].astype(np.int64), q[at].astype(np.int64)]
        there = ~np.isnan(got)
        weight[:, at] += np.where(there, w[at], 0.0)
        value[:, at] += np.where(there, w[at] * np.where(there, got, 0.0), 0.0)
    at = np.flatnonzero(weight.any(axis=0))
    return at, weight[:, at], value[:, at]


def warped(source: DataFrame, found: DataFrame, bands: tuple[str, ...], kernel: str = "bilinear", side: int = SIDE, source_side: int = SIDE) -> DataFrame:
    """name, row, col, bands of target pixels that the source has a value for, from blocks() of the source and covered() target blocks."""
    n, pairs = len(bands), found.join(source, ["name", "brow", "bcol"])
    parts = pa.schema([("name", pa.string()), *[(k, pa.int32()) for k in ("trow", "tcol", "height", "width")], ("at", pa.binary()), ("weight", pa.binary()), ("value", pa.binary())])

    def share(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(len(b)):
                row = b.slice(i, 1).to_pylist()[0]
                at, w, v = shares(row, n, source_side, kernel)
                if len(at):
                    yield pa.RecordBatch.from_pylist([{k: row[k] for k in ("name", "trow", "tcol", "height", "width")} | {"at": at.astype(np.int32).tobytes(), "weight": w.tobytes(), "value": v.tobytes()}], parts)

    def together(t: pa.Table) -> pa.Table:
        head = t.slice(0, 1).drop_columns(["at", "weight", "value"]).to_pylist()[0]
        weight, value = np.zeros((n, head["height"] * head["width"])), np.zeros((n, head["height"] * head["width"]))
        for a, w, v in zip(t.column("at"), t.column("weight"), t.column("value"), strict=True):
            at = np.frombuffer(a.as_py(), np.int32)
            weight[:, at] += np.frombuffer(w.as_py()).reshape(n, -1)
            value[:, at] += np.frombuffer(v.as_py()).reshape(n, -1)
        at = np.flatnonzero(weight.any(axis=0))
        rows, cols = np.divmod(at, head["width"])
        with np.errstate(invalid="ignore", divide="ignore"):
            mean = value[:, at] / weight[:, at]
        out = [pa.array([head["name"]] * len(at), pa.string()), pa.array((rows + head["trow"] * side).astype(np.int32)), pa.array((cols + head["tcol"] * side).astype(np.int32))]
        return pa.Table.from_arrays(out + [pa.array(m, mask=np.isnan(m)) for m in mean], names=["name", "row", "col", *bands])

    shared = pairs.mapInArrow(share, "name string, trow int, tcol int, height int, width int, at binary, weight binary, value binary")
    return shared.groupBy("name", "trow", "tcol").applyInArrow(together, "name string, row int, col int, " + ", ".join(f"`{b}` double" for b in bands))


def source_side(grids: DataFrame) -> list[Column]:
    return [c("width").alias("s_width"), c("height").alias("s_height"), *[c(k).alias(f"s_{k}") for k in (*AFFINE, "epsg")]]


def to_grid(pixels: DataFrame, sources: DataFrame, grids: DataFrame, bands: tuple[str, ...], kernel: str = "bilinear", side: int = SIDE, bound: float = BOUND) -> DataFrame:
    """name, row, col, bands: pixels (name, row, col, bands, valid) of images on the grids `sources`, on those of `grids` (GRID), of the same names. Target pixels without a valid source pixel have no row."""
    at = targets(grids, side).join(sources.select("name", *source_side(sources)), "name")
    found = covered(at, by_system, side, side, kernel, bound)
    return warped(blocks(pixels, bands, side), found, bands, kernel, side, side)


COEFFICIENTS = "name string, scale double, mid_x double, mid_y double, points array<double>, weights array<double>"


def splines(points: DataFrame, smoothing: float = 0.0) -> DataFrame:
    """COEFFICIENTS of the spline from map to source pixel through each image's control points (name, ord, mx, my, sx, sy); fewer than three have none. Points are as few as W6 leaves (1,200 by default), so one image is one task."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        p = pdf.sort_values("ord").drop_duplicates(["mx", "my"])
        at, to = p[["mx", "my"]].to_numpy(float), p[["sx", "sy"]].to_numpy(float)
        mid = (at.min(axis=0) + at.max(axis=0)) / 2 if len(at) else np.zeros(2)
        scale = float((at.max(axis=0) - at.min(axis=0)).max()) if len(at) else 0.0
        if len(at) < 3 or not scale or np.linalg.matrix_rank((at - mid) / scale) < 2:
            return pd.DataFrame(columns=[x.split()[0] for x in COEFFICIENTS.split(", ")])
        q = Spline(at - mid, to, scale, smoothing)
        return pd.DataFrame([(pdf["name"].iloc[0], scale, mid[0], mid[1], q.src.ravel().tolist(), q.w.ravel().tolist())], columns=[x.split()[0] for x in COEFFICIENTS.split(", ")])

    return points.select("name", "ord", "mx", "my", "sx", "sy").groupBy("name").applyInPandas(run, COEFFICIENTS)


def by_control_points(pixels: DataFrame, sources: DataFrame, points: DataFrame, grids: DataFrame, bands: tuple[str, ...], kernel: str = "bilinear", side: int = SIDE, bound: float = BOUND, smoothing: float = 0.0) -> DataFrame:
    """As to_grid(), with the place in the source from the spline through each image's control points, in place of reference systems. sources: name, width, height."""
    size = sources.select("name", c("width").alias("s_width"), c("height").alias("s_height"))
    at = targets(grids, side).join(size, "name").join(splines(points, smoothing), "name")
    return warped(blocks(pixels, bands, side), covered(at, by_spline, side, side, kernel, bound), bands, kernel, side, side)
