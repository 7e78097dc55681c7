"""Planar and spherical geometry on plain double columns.

Coordinates carry their reference system in the column name: ``lon``/``lat`` are
WGS84 degrees, ``x``/``y`` Swiss LV03 metres, ``mx``/``my`` Web-Mercator metres.
A point is ``struct<x, y>`` and a line ``array<struct<x, y>>``, both in degrees.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Earth radii in metres (great circle; Web-Mercator sphere).
EARTH_RADIUS_M = 6371009.0
MERCATOR_RADIUS_M = 6378137.0

# Degrees outside which the LV03 approximation is not valid.
SWISS_LON = (5.9, 10.6)
SWISS_LAT = (45.7, 47.9)

# WGS84 and Bessel ellipsoids (half axis, squared eccentricity), the shift between
# their centres in metres, and the origin of the Swiss grid in degrees.
WGS84_AXIS_M, WGS84_E2 = 6378137.0, 0.006694379990141317
BESSEL_AXIS_M, BESSEL_E2 = 6377397.155, 0.006674372230614
SHIFT_M = (674.374, 15.056, 405.346)
ORIGIN_LON, ORIGIN_LAT = 7.439583333333333, 46.95240555555556


def in_box(lon: Column, lat: Column, south: float | Column, north: float | Column,
           west: float | Column, east: float | Column) -> Column:
    """Strictly inside on all four sides."""
    return (lat > south) & (lat < north) & (lon > west) & (lon < east)


def _swiss(lon: Column, lat: Column) -> Column:
    return lon.between(*SWISS_LON) & lat.between(*SWISS_LAT)


def lv03(lon: Column, lat: Column) -> tuple[Column, Column]:
    """WGS84 degrees to LV03 metres by the published swisstopo polynomials."""
    p = (lat * 3600 - 169028.66) / 10000
    q = (lon * 3600 - 26782.5) / 10000
    x = 600072.37 + 211455.93 * q - 10938.51 * q * p - 0.36 * q * p * p - 44.54 * q * q * q
    y = (200147.07 + 308807.95 * p + 3745.25 * q * q + 76.63 * p * p
         - 194.56 * q * q * p + 119.79 * p * p * p)
    ok = _swiss(lon, lat)
    return F.when(ok, x), F.when(ok, y)


def grid_constants() -> tuple[float, float, float, float, float]:
    """Of the Swiss grid: stretch of longitudes, sine and cosine of the origin's latitude on the
    sphere, constant of the latitude formula, radius of the sphere."""
    lat, e = math.radians(ORIGIN_LAT), math.sqrt(BESSEL_E2)
    alpha = math.sqrt(1 + BESSEL_E2 / (1 - BESSEL_E2) * math.cos(lat) ** 4)
    origin = math.asin(math.sin(lat) / alpha)
    constant = (math.log(math.tan(math.pi / 4 + origin / 2)) - alpha * math.log(math.tan(math.pi / 4 + lat / 2))
                + alpha * e / 2 * math.log((1 + e * math.sin(lat)) / (1 - e * math.sin(lat))))
    radius = BESSEL_AXIS_M * math.sqrt(1 - BESSEL_E2) / (1 - BESSEL_E2 * math.sin(lat) ** 2)
    return alpha, math.sin(origin), math.cos(origin), constant, radius


def with_lv03_anywhere(df: DataFrame) -> DataFrame:
    """Add ``x, y``: LV03 metres of ``lon, lat`` by the polynomials where they are valid and by
    the closed formulas of the oblique projection elsewhere; they differ by less than 1 m.

    Steps are columns of their own, so that none is computed twice. A coordinate that is
    null or no number gives null or no number; a pole or the point opposite to the origin
    has no place on the grid.
    """
    alpha, sin0, cos0, constant, radius = grid_constants()
    e, short = math.sqrt(BESSEL_E2), BESSEL_AXIS_M * math.sqrt(1 - BESSEL_E2)
    second = BESSEL_E2 / (1 - BESSEL_E2)
    phi, lam = F.radians("lat"), F.radians("lon")
    c = F.col
    steps = [
        {"_n": WGS84_AXIS_M / F.sqrt(1 - WGS84_E2 * F.sin(phi) * F.sin(phi))},
        {"_x": c("_n") * F.cos(phi) * F.cos(lam) - SHIFT_M[0], "_y": c("_n") * F.cos(phi) * F.sin(lam) - SHIFT_M[1],
         "_z": c("_n") * (1 - WGS84_E2) * F.sin(phi) - SHIFT_M[2]},
        {"_p": F.sqrt(c("_x") * c("_x") + c("_y") * c("_y"))},
        {"_t": F.atan2(c("_z") * BESSEL_AXIS_M, c("_p") * short)},
        {"_s": F.sin("_t"), "_c": F.cos("_t")},
        {"_phi": F.atan2(c("_z") + second * short * c("_s") * c("_s") * c("_s"),
                         c("_p") - BESSEL_E2 * BESSEL_AXIS_M * c("_c") * c("_c") * c("_c")),
         "_l": alpha * (F.atan2("_y", "_x") - math.radians(ORIGIN_LON))},
        {"_q": alpha * F.ln(F.tan(math.pi / 4 + c("_phi") / 2))
         - alpha * e / 2 * F.ln((1 + e * F.sin("_phi")) / (1 - e * F.sin("_phi"))) + constant},
        {"_b": 2 * (F.atan(F.exp("_q")) - math.pi / 4)},
        {"_sin": cos0 * F.sin("_b") - sin0 * F.cos("_b") * F.cos("_l")},
        {"x": 600000 + radius * F.atan2(F.sin("_l"), sin0 * F.tan("_b") + cos0 * F.cos("_l")),
         "y": 200000 + radius / 2 * F.ln((1 + c("_sin")) / (1 - c("_sin")))}]
    placed = df
    for step in steps:
        placed = placed.withColumns(step)
    near_x, near_y = lv03(c("lon"), c("lat"))
    placed = placed.withColumns({"x": F.coalesce(near_x, "x"), "y": F.coalesce(near_y, "y")})
    return placed.drop("_n", "_x", "_y", "_z", "_p", "_t", "_s", "_c", "_phi", "_l", "_q", "_b", "_sin")


def wgs84(x: Column, y: Column) -> tuple[Column, Column]:
    """LV03 metres back to WGS84 degrees."""
    a = (x - 600000) / 1000000
    b = (y - 200000) / 1000000
    lon = (2.6779094 + 4.728982 * a + 0.791484 * a * b + 0.1306 * a * b * b - 0.0436 * a * a * a) * 100 / 36
    lat = (16.9023892 + 3.238272 * b - 0.270978 * a * a - 0.002528 * b * b
           - 0.0447 * a * a * b - 0.0140 * b * b * b) * 100 / 36
    return lon, lat


def mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    """WGS84 degrees to Web-Mercator metres."""
    return (F.radians(lon) * MERCATOR_RADIUS_M,
            F.ln(F.tan(F.radians(lat) / 2 + F.lit(0.7853981633974483))) * MERCATOR_RADIUS_M)


def planar_distance(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Euclidean distance; null when any coordinate is null."""
    dx, dy = x2 - x1, y2 - y1
    return F.sqrt(dx * dx + dy * dy)


def great_circle(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Haversine distance in metres."""
    s_lat = F.sin(F.radians(lat2 - lat1) / 2)
    s_lon = F.sin(F.radians(lon2 - lon1) / 2)
    h = s_lat * s_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * s_lon * s_lon
    return 2 * EARTH_RADIUS_M * F.asin(F.sqrt(h))


def point(lon: Column, lat: Column) -> Column:
    return F.struct(lon.alias("x"), lat.alias("y"))


def line_or_null(points: Column) -> Column:
    """A line needs two vertices; anything shorter is null."""
    return F.when(F.size(points) >= 2, points)


def line_length(points: Column) -> Column:
    """Length in LV03 metres of a line given in degrees; null for a null line."""
    planar = F.transform(points, lambda v: F.struct(*[
        c.alias(n) for c, n in zip(lv03(v["x"], v["y"]), ("x", "y"))]))
    nowhere = F.lit(None).cast("double")
    start = F.struct(nowhere.alias("x"), nowhere.alias("y"), nowhere.alias("m"), F.lit(0).alias("n"))
    # The first vertex starts the sum; from then on a missing coordinate makes it null.
    walked = F.aggregate(planar, start, lambda at, v: F.struct(
        v["x"].alias("x"), v["y"].alias("y"),
        F.when(at["n"] == 0, F.lit(0.0))
        .otherwise(at["m"] + planar_distance(at["x"], at["y"], v["x"], v["y"])).alias("m"),
        (at["n"] + 1).alias("n")), lambda at: at["m"])
    return F.when(F.size(points) >= 2, walked)


def legs_length(points: list[tuple[Column, Column]]) -> Column:
    """``line_length`` of a line whose vertices are known one by one, without a loop over an array."""
    planar = [lv03(lon, lat) for lon, lat in points]
    legs = [planar_distance(*a, *b) for a, b in zip(planar, planar[1:])]
    return sum(legs[1:], legs[0])
