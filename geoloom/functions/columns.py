"""Scalar column functions of the domain: dates, boxes, affine maps, validity, scaling."""

from __future__ import annotations

import math
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Neighbour directions and their unit shifts east and north, in this order.
OFFSETS = {"C": (0, 0), "N": (0, 1), "NE": (1, 1), "E": (1, 0), "SE": (1, -1), "S": (0, -1), "SW": (-1, -1), "W": (-1, 0), "NW": (-1, 1)}
#: Weights of red, green and blue in a grey value.
GREY = (0.2989, 0.5870, 0.1140)
#: Values outside are missing, whatever the file's own missing value.
LEAST, MOST = -1e6, 1e20


def c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def d(x: float) -> Column:
    """A double literal."""
    return F.lit(float(x)).cast("double")


def finite(x: Column | str) -> Column:
    """Neither null, NaN nor infinite; Spark orders NaN above all numbers, so a comparison alone is not enough."""
    return F.coalesce(~F.isnan(c(x)) & (F.abs(c(x)) < d(math.inf)), F.lit(False))


def stem(path: Column | str) -> Column:
    """File name without folder and last suffix."""
    return F.regexp_replace(F.substring_index(c(path), "/", -1), r"\.[^.]*$", "")


def is_quicklook(path: Column | str) -> Column:
    return c(path).contains("_1QK_") | c(path).rlike(r"_1QK\.tiff?$")


def is_band_file(path: Column | str) -> Column:
    return ~is_quicklook(path) & stem(path).rlike("_[BGNR]$")


def scene_key(path: Column | str, sensor: str = "[A-Za-z0-9]+") -> Column:
    """Scene name of a band file: two times, the sensor and what follows, up to the band; empty where the name does not fit."""
    return F.regexp_extract(stem(path), rf"^(20\d{{6}}T\d{{6}}_20\d{{6}}T\d{{6}}_{sensor}_.*?)_[BGNR]$", 1)


def scene_times(scene_id: Column | str) -> dict[str, Column]:
    """acq_start, acq_end, processing_time and acq_day of a scene name; 'unknown' where it has no such time."""
    found = F.regexp_extract_all(c(scene_id), F.lit(r"\d{8}T\d{6}"), F.lit(0))
    unknown = F.lit("unknown")
    start = F.coalesce(F.get(found, F.lit(0)), unknown)
    return {"acq_start": start, "acq_end": F.coalesce(F.get(found, F.lit(1)), unknown), "processing_time": F.when(F.size(found) >= 3, F.element_at(found, -1)).otherwise(unknown), "acq_day": F.when(start == "unknown", unknown).otherwise(F.substring(start, 1, 8))}


def acquisition_date(scene: Column | str) -> Column:
    """Date at the start of a scene name; null where none is."""
    return F.to_date(F.try_to_timestamp(F.nullif(F.regexp_extract(c(scene), r"^(20\d{6})T", 1), F.lit("")), F.lit("yyyyMMdd")))


def time_window(date: Column | str, days: int) -> tuple[Column, Column]:
    """First and last day around a date, as yyyy-MM-dd."""
    return F.date_format(F.date_sub(c(date), days), "yyyy-MM-dd"), F.date_format(F.date_add(c(date), days), "yyyy-MM-dd")


def align_down(x: Column, step: float) -> Column:
    return F.floor(x / d(step)) * d(step)


def align_up(x: Column, step: float) -> Column:
    return F.ceil(x / d(step)) * d(step)


def raster_side(extent: Column, res: float) -> Column:
    """Pixels along an extent, rounded half to even."""
    return F.rint(extent / d(res)).cast("int")


def apply_affine(t: dict[str, Column], x: Column, y: Column) -> tuple[Column, Column]:
    """Pixel to map by the six coefficients a ... f."""
    return t["a"] * x + t["b"] * y + t["c"], t["d"] * x + t["e"] * y + t["f"]


def invert_affine(t: dict[str, Column], x: Column, y: Column) -> tuple[Column, Column]:
    """Map to pixel."""
    det = t["a"] * t["e"] - t["b"] * t["d"]
    dx, dy = x - t["c"], y - t["f"]
    return (t["e"] * dx - t["b"] * dy) / det, (t["a"] * dy - t["d"] * dx) / det


#: Semi-axis and flattening of the ellipsoid, scale on the central meridian, false easting, and false northing of the southern half.
AXIS, FLAT, SCALE, EAST, SOUTH = 6378137.0, 1 / 298.257223563, 0.9996, 500000.0, 10000000.0


def series() -> tuple[float, float, tuple[float, ...], tuple[float, ...]]:
    """Of the sixth-order Krueger series: rectifying radius, eccentricity, and the coefficients to and from the plane."""
    n = FLAT / (2 - FLAT)
    alpha = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16 + 41 * n**4 / 180 - 127 * n**5 / 288 + 7891 * n**6 / 37800,
        13 * n**2 / 48 - 3 * n**3 / 5 + 557 * n**4 / 1440 + 281 * n**5 / 630 - 1983433 * n**6 / 1935360,
        61 * n**3 / 240 - 103 * n**4 / 140 + 15061 * n**5 / 26880 + 167603 * n**6 / 181440,
        49561 * n**4 / 161280 - 179 * n**5 / 168 + 6601661 * n**6 / 7257600,
        34729 * n**5 / 80640 - 3418889 * n**6 / 1995840,
        212378941 * n**6 / 319334400,
    )
    beta = (
        n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360 - 81 * n**5 / 512 + 96199 * n**6 / 604800,
        n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440 + 46 * n**5 / 105 - 1118711 * n**6 / 3870720,
        17 * n**3 / 480 - 37 * n**4 / 840 - 209 * n**5 / 4480 + 5569 * n**6 / 90720,
        4397 * n**4 / 161280 - 11 * n**5 / 504 - 830251 * n**6 / 7257600,
        4583 * n**5 / 161280 - 108847 * n**6 / 3991680,
        20648693 * n**6 / 638668800,
    )
    return AXIS / (1 + n) * (1 + n**2 / 4 + n**4 / 64 + n**6 / 256), 2 * math.sqrt(n) / (1 + n), alpha, beta


def utm_place(lon: Column, lat: Column, zone: Column, south: Column | None = None) -> Column:
    """Easting and northing (x, y in a struct) of longitude and latitude; with the southern half's false northing where `south` holds."""
    from geoloom.functions import geodesy

    return geodesy.places(geodesy.forward)(lon, lat, zone, F.lit(False) if south is None else F.coalesce(south, F.lit(False)))


def utm_from_wgs84(lon: Column, lat: Column, zone: Column, south: Column | None = None) -> tuple[Column, Column]:
    """Easting and northing of longitude and latitude, as utm_place()."""
    p = utm_place(lon, lat, zone, south)
    return p["x"], p["y"]


def wgs84_place(x: Column, y: Column, zone: Column, south: Column) -> Column:
    """Longitude and latitude (x, y in a struct) of easting and northing."""
    from geoloom.functions import geodesy

    return geodesy.places(geodesy.inverse)(x, y, zone, F.coalesce(south, F.lit(False)))


def wgs84_from_utm(x: Column, y: Column, zone: Column, south: Column) -> tuple[Column, Column]:
    """Longitude and latitude of easting and northing, as wgs84_place()."""
    p = wgs84_place(x, y, zone, south)
    return p["x"], p["y"]


def utm_zone(lon: Column) -> Column:
    return (F.floor((lon + d(180)) / d(6)) + 1).cast("int")


def valid_plain(v: Column | str, nodata: Column | float | None) -> Column:
    """Finite and not the missing value."""
    return finite(v) & (F.lit(True) if nodata is None else c(v) != (nodata if isinstance(nodata, Column) else d(nodata)))


def valid_above(v: Column | str, nodata: float | None) -> Column:
    """As valid_plain, and above the lowest value that can be data."""
    return valid_plain(v, nodata) & (c(v) > d(LEAST))


def valid_between(v: Column | str, nodata: float | None) -> Column:
    """As valid_above, and below the highest value that can be data."""
    return valid_above(v, nodata) & (c(v) < d(MOST))


def cleaned(v: Column | str, nodata: float, out: float) -> Column:
    """out in place of missing, non-finite and impossible values."""
    return F.when(finite(v) & (c(v) != d(nodata)) & (c(v) >= d(LEAST)) & (c(v) <= d(MOST)), c(v)).otherwise(d(out))


def grey(r: Column, g: Column, b: Column) -> Column:
    return (r * d(GREY[0]) + g * d(GREY[1]) + b * d(GREY[2])).cast("float")


def scaled(v: Column, scale: float, offset: float, valid: Column, nodata: float) -> Column:
    """Physical value of a valid raw value, in single precision."""
    return F.when(valid, (v.cast("float") * F.lit(scale).cast("float") + F.lit(offset).cast("float")).cast("float")).otherwise(F.lit(nodata).cast("float"))


def to_byte(x: Column, valid: Column) -> Column:
    """[0, 1] to 0 ... 255, rounded half to even; invalid is 0."""
    return F.when(valid, F.least(F.greatest(F.rint(x * d(255)), d(0)), d(255))).otherwise(d(0)).cast("int")


def preview_side(side: Column, width: Column, height: Column, most: int) -> Column:
    """Side of a preview whose longer side is at most `most`, rounded half to even, one at least."""
    return F.greatest(F.lit(1), F.rint(side * F.least(d(1), d(most) / F.greatest(width, height).cast("double")))).cast("int")


def close(a: Column, b: Column, tolerance: Column) -> Column:
    """Equal within a relative 1e-9 or an absolute tolerance."""
    return F.abs(a - b) <= F.greatest(d(1e-9) * F.greatest(F.abs(a), F.abs(b)), tolerance)


def softmax(logits: Column) -> Column:
    e = F.transform(logits, lambda x: F.exp(x - F.array_max(logits)))
    return F.transform(e, lambda x: x / F.aggregate(e, d(0), lambda a, y: a + y))


def argmax(values: Column) -> Column:
    """Index of the greatest value, the first of equals."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")
