"""Reference systems for arrays: longitude-latitude and UTM zones. Column functions hand whole batches to them."""

from __future__ import annotations

import sys
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from geoloom.functions.columns import EAST, FLAT, SCALE, SOUTH, series

# Python workers get these functions with the column function that uses them, also where a driver found this package by sys.path alone.
for _name in (__name__, series.__module__):
    cloudpickle.register_pickle_by_value(sys.modules[_name])

#: The number of the longitude-latitude system, and what UTM zones of the northern and southern half are added to.
LONLAT, NORTH_ZONES, SOUTH_ZONES = 4326, 32600, 32700

#: Moved x and y from x, y and two parameters, all arrays of doubles.
Move = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


def zone_of(epsg: int) -> tuple[int, bool]:
    """Zone and half of a UTM system; another one is an error."""
    for base, south in ((NORTH_ZONES, False), (SOUTH_ZONES, True)):
        if base < epsg <= base + 60:
            return epsg - base, south
    raise ValueError(f"unknown reference system: EPSG:{epsg}")


def forward(lon: np.ndarray, lat: np.ndarray, zone: np.ndarray | int, south: np.ndarray | bool) -> tuple[np.ndarray, np.ndarray]:
    """Easting and northing of longitude and latitude, in one zone or one by place; with the southern half's false northing where `south` holds."""
    big, e, alpha, _ = series()
    phi, lam = np.radians(lat), np.radians(lon - (zone * 6 - 183))
    t = np.sinh(np.arctanh(np.sin(phi)) - e * np.arctanh(e * np.sin(phi)))
    xi, eta = np.arctan2(t, np.cos(lam)), np.arctanh(np.sin(lam) / np.sqrt(1 + t * t))
    x, y = eta.copy(), xi.copy()
    for j, a in enumerate(alpha, 1):
        x += a * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
        y += a * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
    return EAST + SCALE * big * x, SCALE * big * y + np.where(south, SOUTH, 0.0)


def inverse(x: np.ndarray, y: np.ndarray, zone: np.ndarray | int, south: np.ndarray | bool) -> tuple[np.ndarray, np.ndarray]:
    """Longitude and latitude of easting and northing. The conformal latitude is turned into the geodetic one by five steps of Newton's method, more than doubles need.

    Arrays may be of shapes that broadcast: what hangs on one of x and y alone is worked out in its own shape.
    """
    big, e, _, beta = series()
    xi, eta = (y - np.where(south, SOUTH, 0.0)) / (SCALE * big), (x - EAST) / (SCALE * big)
    a, b = xi, eta
    for j, k in enumerate(beta, 1):
        a = a - k * np.sin(2 * j * xi) * np.cosh(2 * j * eta)
        b = b - k * np.cos(2 * j * xi) * np.sinh(2 * j * eta)
    tau = np.sin(a) / np.sqrt(np.sinh(b) ** 2 + np.cos(a) ** 2)
    t = tau.copy()
    for _ in range(5):
        root = np.sqrt(1 + t * t)
        sigma = np.sinh(e * np.arctanh(e * t / root))
        near = t * np.sqrt(1 + sigma * sigma) - sigma * root
        t += (tau - near) / np.sqrt(1 + near * near) * (1 + (1 - e * e) * t * t) / ((1 - e * e) * root)
    return zone * 6 - 183 + np.degrees(np.arctan2(np.sinh(b), np.cos(a))), np.degrees(np.arctan(t))


def to_utm(lon: np.ndarray, lat: np.ndarray, epsg: int) -> tuple[np.ndarray, np.ndarray]:
    return forward(lon, lat, *zone_of(epsg))


def from_utm(x: np.ndarray, y: np.ndarray, epsg: int) -> tuple[np.ndarray, np.ndarray]:
    return inverse(x, y, *zone_of(epsg))


def between(x: np.ndarray, y: np.ndarray, source: int, target: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of one system in another."""
    if source == target:
        return x, y
    lon, lat = (x, y) if source == LONLAT else from_utm(x, y, source)
    return (lon, lat) if target == LONLAT else to_utm(lon, lat, target)


def between_rows(x: np.ndarray, y: np.ndarray, source: np.ndarray, target: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (one a row, or a row of several) of each row's own system in its target; equal systems leave them as they are. Codes are known ones."""
    u, v = (np.array(k) for k in np.broadcast_arrays(x, y))
    source, target = source.ravel(), target.ravel()
    for code, move, (p, q) in ((source, inverse, (x, y)), (target, forward, (u, v))):
        rows = (source != target) & (code != LONLAT)
        own = code[rows].reshape(-1, *[1] * (x.ndim - 1))
        u[rows], v[rows] = move(p[rows], q[rows], own % 100, own > SOUTH_ZONES)
    return u, v


def plain(column: pa.Array, empty: float = np.nan) -> np.ndarray:
    """A column's values as doubles, `empty` for nulls."""
    return np.asarray(column.cast(pa.float64()).fill_null(empty))


def filled(values: list[np.ndarray], nulls: list[np.ndarray], names: list[str]) -> pa.Array:
    """Structs of doubles, with nulls where the masks say so."""
    return pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(v), pa.float64(), mask=m) for v, m in zip(values, nulls, strict=True)], names)


def missing(columns: tuple[pa.Array, ...]) -> np.ndarray:
    """Rows in which any column is null."""
    return np.any([np.asarray(k.is_null()) for k in columns], axis=0)


def places(move: Move) -> Callable[..., Column]:
    """A column function of x, y and two parameters: the places (x, y in a struct) that move() gives for arrays of them. What a null makes unknown is null."""

    def run(x: pa.Array, y: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
        with np.errstate(all="ignore"):
            moved = move(*map(plain, (x, y, a, b)))
        return filled(list(moved), [np.isnan(v) & missing((x, y, a, b)) for v in moved], ["x", "y"])

    return F.arrow_udf(run, "x double, y double")


#: Boxes whose edge points are moved at once: arrays of them stay in a processor's cache.
BOXES = 128


def edge_points(w: np.ndarray, s: np.ndarray, e: np.ndarray, n: np.ndarray, points: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """x, y of points along the edges of boxes, in shapes that broadcast to a box a row: south and north, west and east."""
    f = np.arange(points) / (points - 1)
    w, s, e, n = (k[:, None, None] for k in (w, s, e, n))
    return [(w + (e - w) * f, np.hstack((s, n))), (np.hstack((w, e)), s + (n - s) * f)]


def edge_bounds(move: Move, points: int) -> Callable[..., Column]:
    """A column function of minx, miny, maxx, maxy and two parameters: the box (in a struct) around the moved points along a box's edges.

    As in Spark's min and max, nulls don't count, and NaN is greater than any number.
    """

    def run(w: pa.Array, s: pa.Array, e: pa.Array, n: pa.Array, a: pa.Array, b: pa.Array) -> pa.Array:
        gone, given = missing((w, s, e, n, a, b)), [plain(k) for k in (w, s, e, n, a, b)]
        out, null = np.empty((4, len(gone))), np.empty((4, len(gone)), bool)
        with np.errstate(all="ignore"):
            for i in range(0, len(gone), BOXES):
                at = slice(i, i + BOXES)
                own = [k[at, None, None] for k in given[4:]]
                moved = [move(x, y, *own) for x, y in edge_points(*[k[at] for k in given[:4]], points)]
                for j, sides in enumerate(zip(*moved, strict=True)):
                    v = np.hstack([k.reshape(len(k), -1) for k in sides])
                    unknown = np.isnan(v) & gone[at, None]
                    out[j, at], most = np.fmin.reduce(v, axis=1), np.fmax.reduce(v, axis=1)
                    out[j + 2, at] = np.where((np.isnan(v) & ~unknown).any(axis=1), np.nan, most)
                    null[j, at] = null[j + 2, at] = unknown.all(axis=1)
        return filled(list(out), list(null), ["minx", "miny", "maxx", "maxy"])

    return F.arrow_udf(run, "minx double, miny double, maxx double, maxy double")


def geodesic_sql(way: str, source: str = "s", x: str = "x", y: str = "y", zone: str = "zone") -> str:
    """DuckDB SQL of the series, for the north: `forward` adds x, y to the source's rows from longitude and latitude, `inverse` adds u, v (longitude, latitude) from x, y."""
    big, e, alpha, beta = series()
    n = lambda v: f"{v!r}::DOUBLE"
    if way == "forward":
        terms = lambda f, g: " + ".join(f"{n(a)} * {f}({2 * j}.0::DOUBLE * xi) * {g}({2 * j}.0::DOUBLE * eta)" for j, a in enumerate(alpha, 1))
        return f"""SELECT * EXCLUDE (_phi, _lam, _t, xi, eta), {n(EAST)} + {n(SCALE * big)} * (eta + {terms("cos", "sinh")}) AS x, {n(SCALE * big)} * (xi + {terms("sin", "cosh")}) AS y FROM (
 SELECT *, atan2(_t, cos(_lam)) AS xi, atanh(sin(_lam) / sqrt(1 + _t * _t)) AS eta FROM (SELECT *, sinh(atanh(sin(_phi)) - {n(e)} * atanh({n(e)} * sin(_phi))) AS _t FROM (SELECT * {"EXCLUDE (x, y)" if "x" in (x, y) else ""}, radians({y}) AS _phi, radians({x} - ({zone} * 6 - 183)::DOUBLE) AS _lam FROM {source})))"""
    terms = lambda f, g: " - ".join(f"{n(k)} * {f}({2 * j}.0::DOUBLE * _xi) * {g}({2 * j}.0::DOUBLE * _eta)" for j, k in enumerate(beta, 1))
    body = f"SELECT *, sin(_a) / sqrt(sinh(_b) * sinh(_b) + cos(_a) * cos(_a)) AS _tau FROM (SELECT *, _xi - {terms('sin', 'cosh')} AS _a, _eta - {terms('cos', 'sinh')} AS _b FROM (SELECT *, {y} / {n(SCALE * big)} AS _xi, ({x} - {n(EAST)}) / {n(SCALE * big)} AS _eta FROM {source}))"
    before = "_tau"
    for i in range(5):
        root = f"sqrt(1 + {before} * {before})"
        sigma = f"sinh({n(e)} * atanh({n(e)} * {before} / {root}))"
        body = f"SELECT *, {before} + (_tau - _near{i}) / sqrt(1 + _near{i} * _near{i}) * (1 + {n(1 - e * e)} * {before} * {before}) / ({n(1 - e * e)} * {root}) AS _t{i} FROM (SELECT *, {before} * sqrt(1 + _s{i} * _s{i}) - _s{i} * {root} AS _near{i} FROM (SELECT *, {sigma} AS _s{i} FROM ({body})))"
        before = f"_t{i}"
    return f"SELECT *, ({zone} * 6 - 183)::DOUBLE + degrees(atan2(sinh(_b), cos(_a))) AS u, degrees(atan({before})) AS v FROM ({body})"
