"""Points as two double columns: decoding, range check, metric projection."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The metric grid (EPSG:5179) on the GRS80 ellipsoid.
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
ORIGIN_LAT = 38.0
ORIGIN_LON = 127.5
SCALE = 0.9996
FALSE_EASTING = 1_000_000.0
FALSE_NORTHING = 2_000_000.0

_N = FLATTENING / (2 - FLATTENING)
_RADIUS = SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
# Series of the transverse Mercator projection in the third flattening, to fourth order.
_FORWARD = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
_INVERSE = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
_LATITUDE = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)
_ECC = 2 * math.sqrt(_N) / (1 + _N)


def _origin_northing() -> float:
    phi = math.radians(ORIGIN_LAT)
    t = math.sinh(math.atanh(math.sin(phi)) - _ECC * math.atanh(_ECC * math.sin(phi)))
    xi = math.atan(t)
    return SCALE * _RADIUS * (xi + sum(a * math.sin(2 * (j + 1) * xi) for j, a in enumerate(_FORWARD)))


_NORTHING_SHIFT = FALSE_NORTHING - _origin_northing()


def _total(columns: list[Column]) -> Column:
    result = columns[0]
    for column in columns[1:]:
        result = result + column
    return result


def _named(values: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a struct that is computed once. Written out, the series would repeat it in every term,
    and a filter on the result would evaluate all of it.
    """
    return F.transform(F.array(values), use)[0]


def _series(v: Column, terms: tuple[float, ...]) -> tuple[Column, Column]:
    along, across = [], []
    for j, a in enumerate(terms, start=1):
        along.append(F.lit(a) * F.sin(v["xi"] * (2 * j)) * F.cosh(v["eta"] * (2 * j)))
        across.append(F.lit(a) * F.cos(v["xi"] * (2 * j)) * F.sinh(v["eta"] * (2 * j)))
    return _total(along), _total(across)


def metric_point(lon: Column, lat: Column) -> Column:
    """``struct<x,y>``: easting and northing in metres from degrees."""

    def conformal(v: Column) -> Column:
        xi = F.atan(v["t"] / F.cos(v["delta"]))
        eta = F.atanh(F.sin(v["delta"]) / F.sqrt(F.lit(1.0) + v["t"] * v["t"]))
        return F.struct(xi.alias("xi"), eta.alias("eta"))

    def metres(v: Column) -> Column:
        north, east = _series(v, _FORWARD)
        x = F.lit(FALSE_EASTING) + F.lit(SCALE * _RADIUS) * (v["eta"] + east)
        y = F.lit(_NORTHING_SHIFT) + F.lit(SCALE * _RADIUS) * (v["xi"] + north)
        return F.struct(x.alias("x"), y.alias("y"))

    sine = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(sine) - F.lit(_ECC) * F.atanh(F.lit(_ECC) * sine))
    start = F.struct(t.alias("t"), F.radians(lon - F.lit(ORIGIN_LON)).alias("delta"))
    return _named(_named(start, conformal), metres)


def to_metric(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Easting and northing in metres from degrees."""
    point = metric_point(lon, lat)
    return point["x"], point["y"]


def degrees_point(easting: Column, northing: Column) -> Column:
    """``struct<lon,lat>``: degrees from metres; the inverse of :func:`metric_point`."""

    def sphere(v: Column) -> Column:
        north, east = _series(v, _INVERSE)
        return F.struct((v["xi"] - north).alias("xi"), (v["eta"] - east).alias("eta"))

    def conformal(v: Column) -> Column:
        chi = F.asin(F.sin(v["xi"]) / F.cosh(v["eta"]))
        delta = F.atan(F.sinh(v["eta"]) / F.cos(v["xi"]))
        return F.struct(chi.alias("chi"), delta.alias("delta"))

    def degrees(v: Column) -> Column:
        terms = [F.lit(d) * F.sin(v["chi"] * (2 * j)) for j, d in enumerate(_LATITUDE, start=1)]
        lon = F.lit(ORIGIN_LON) + F.degrees(v["delta"])
        return F.struct(lon.alias("lon"), F.degrees(_total([v["chi"], *terms])).alias("lat"))

    unit = F.lit(SCALE * _RADIUS)
    start = F.struct(
        ((northing - F.lit(_NORTHING_SHIFT)) / unit).alias("xi"), ((easting - F.lit(FALSE_EASTING)) / unit).alias("eta")
    )
    return _named(_named(_named(start, sphere), conformal), degrees)


def to_degrees(easting: Column, northing: Column) -> tuple[Column, Column]:
    """Longitude and latitude from metres."""
    point = degrees_point(easting, northing)
    return point["lon"], point["lat"]


def valid_degrees(lon: Column, lat: Column) -> Column:
    return lon.between(-180.0, 180.0) & lat.between(-90.0, 90.0)


# Layout of a well-known-binary point, in hex characters: byte order 2, type 8, SRID 8 if flagged,
# then the ordinates, 16 each.
_SRID_BIT, _POINT_CODE = 0x20, 1


def _word(v: Column, start: Column | int, size: int) -> Column:
    """``size`` bytes of ``v.text`` from 1-based ``start``, most significant byte first."""
    start = F.lit(start) if isinstance(start, int) else start
    pairs = [F.substring(v["text"], start + 2 * i, F.lit(2)) for i in range(size)]
    return F.when(v["little"], F.concat(*reversed(pairs))).otherwise(F.concat(*pairs))


def _double_from_parts(v: Column) -> Column:
    """IEEE 754 value in plain arithmetic; NULL for infinities and NaN."""
    sign = F.when(v["head"] >= 2048, -1.0).otherwise(1.0)
    exponent = v["head"] % 2048
    normal = (F.lit(1.0) + v["fraction"]) * F.pow(F.lit(2.0), exponent - 1023)
    tiny = v["fraction"] * F.lit(2.0**-1022)
    return F.when(exponent == 2047, F.lit(None).cast("double")).otherwise(
        sign * F.when(exponent == 0, tiny).otherwise(normal)
    )


def _double_from_word(word: Column) -> Column:
    head = F.conv(F.substring(word, 1, 3), 16, 10).cast("int")
    fraction = F.conv(F.substring(word, 4, 13), 16, 10).cast("bigint").cast("double") / F.lit(2.0**52)
    return _named(F.struct(head.alias("head"), fraction.alias("fraction")), _double_from_parts)


def wkb_point(col: Column) -> Column:
    """``struct<lon,lat>`` of a well-known-binary point given as hex text; NULL if it is not one."""
    return wkb_point_from_bytes(F.unhex(col))


def wkb_point_from_bytes(col: Column) -> Column:
    """The same for a binary column."""

    def header(v: Column) -> Column:
        kind = _word(v, 3, 4)
        flags = F.conv(F.substring(kind, 1, 2), 16, 10).cast("int")
        code = F.conv(F.substring(kind, 3, 6), 16, 10).cast("int") % 1000
        start = F.when(flags.bitwiseAND(F.lit(_SRID_BIT)) != 0, 19).otherwise(11)
        return F.struct(v["text"].alias("text"), v["little"].alias("little"), code.alias("code"), start.alias("start"))

    def ordinates(v: Column) -> Column:
        usable = (v["code"] == _POINT_CODE) & (F.length(v["text"]) >= v["start"] + 31)
        lon, lat = (F.when(usable, _word(v, v["start"] + 16 * i, 8)) for i in (0, 1))
        return F.struct(lon.alias("lon"), lat.alias("lat"))

    def degrees(v: Column) -> Column:
        return F.struct(_double_from_word(v["lon"]).alias("lon"), _double_from_word(v["lat"]).alias("lat"))

    text = F.hex(col)
    begun = F.when(
        F.substring(text, 1, 2).isin("00", "01") & (F.length(text) >= 10),
        F.struct(text.alias("text"), (F.substring(text, 1, 2) == "01").alias("little")),
    )
    point = _named(_named(_named(begun, header), ordinates), degrees)
    return _named(point, lambda p: F.when(p["lon"].isNotNull() & p["lat"].isNotNull(), p))
