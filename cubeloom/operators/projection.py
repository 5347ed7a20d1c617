"""Closed-form projections between EPSG:4326, EPSG:3857 and the UTM zones (WGS 84).

Everything goes through longitude and latitude; formulas are the usual spherical Mercator
and the series for the transverse Mercator in Snyder, Map Projections (USGS 1395).
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import UnsupportedProjection

# Fixed values of WGS 84 and UTM.
R = 6378137.0
FLATTENING = 1 / 298.257223563
E2 = FLATTENING * (2 - FLATTENING)
EP2 = E2 / (1 - E2)
K0 = 0.9996
FALSE_EAST, FALSE_NORTH = 500000.0, 10000000.0


def epsg(code) -> int:
    return int(str(code).upper().replace("EPSG:", ""))


def _utm(code: int) -> tuple[float, bool]:
    zone = code % 100
    if code // 100 not in (326, 327) or not 1 <= zone <= 60:
        raise UnsupportedProjection(f"EPSG:{code}")
    return math.radians(zone * 6 - 183), code // 100 == 327


def is_metric(code: int) -> bool:
    return code != 4326


def _meridian(lat: Column) -> Column:
    """Length of the meridian from the equator."""
    e4, e6 = E2**2, E2**3
    return R * ((1 - E2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * lat
                - (3 * E2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * F.sin(2 * lat)
                + (15 * e4 / 256 + 45 * e6 / 1024) * F.sin(4 * lat) - (35 * e6 / 3072) * F.sin(6 * lat))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once; keeps long series short in the plan."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _point(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def from_lonlat(p: Column, code: int) -> Column:
    """Projected ``struct<x, y>`` of a longitude / latitude ``struct<x, y>``."""
    if code == 4326:
        return p
    if code == 3857:
        return _point(F.radians(p["x"]) * R, F.ln(F.tan(math.pi / 4 + F.radians(p["y"]) / 2)) * R)
    lon0, south = _utm(code)
    lat = F.radians(p["y"])
    terms = F.struct(
        lat.alias("p"), (R / F.sqrt(1 - E2 * F.pow(F.sin(lat), F.lit(2)))).alias("n"), F.pow(F.tan(lat), F.lit(2)).alias("t"),
        (EP2 * F.pow(F.cos(lat), F.lit(2))).alias("c"), ((F.radians(p["x"]) - lon0) * F.cos(lat)).alias("a"))

    def series(s: Column) -> Column:
        n, t, c, a = s["n"], s["t"], s["c"], s["a"]
        a2 = a * a
        east = K0 * n * (a + (1 - t + c) * a2 * a / 6 + (5 - 18 * t + t * t + 72 * c - 58 * EP2) * a2 * a2 * a / 120) + FALSE_EAST
        north = K0 * (_meridian(s["p"]) + n * F.tan(s["p"]) * (
            a2 / 2 + (5 - t + 9 * c + 4 * c * c) * a2 * a2 / 24
            + (61 - 58 * t + t * t + 600 * c - 330 * EP2) * a2 * a2 * a2 / 720))
        return _point(east, north + FALSE_NORTH if south else north)

    return let(terms, series)


def to_lonlat(q: Column, code: int) -> Column:
    """Longitude / latitude ``struct<x, y>`` of a projected one."""
    if code == 4326:
        return q
    if code == 3857:
        return _point(F.degrees(q["x"] / R), F.degrees(2 * F.atan(F.exp(q["y"] / R)) - math.pi / 2))
    lon0, south = _utm(code)
    e1 = (1 - math.sqrt(1 - E2)) / (1 + math.sqrt(1 - E2))
    per_radian = R * (1 - E2 / 4 - 3 * E2**2 / 64 - 5 * E2**3 / 256)

    def footpoint(mu: Column) -> Column:
        return (mu + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu) + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu)
                + (151 * e1**3 / 96) * F.sin(6 * mu) + (1097 * e1**4 / 512) * F.sin(8 * mu))

    def terms(p: Column) -> Column:
        w = 1 - E2 * F.pow(F.sin(p), F.lit(2))
        n = R / F.sqrt(w)
        return F.struct(p.alias("p"), (EP2 * F.pow(F.cos(p), F.lit(2))).alias("c"), F.pow(F.tan(p), F.lit(2)).alias("t"),
                        n.alias("n"), (R * (1 - E2) / F.pow(w, F.lit(1.5))).alias("r"), ((q["x"] - FALSE_EAST) / (n * K0)).alias("d"))

    def series(s: Column) -> Column:
        p, c, t, n, r, d = (s[k] for k in ("p", "c", "t", "n", "r", "d"))
        d2 = d * d
        lat = p - (n * F.tan(p) / r) * (
            d2 / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * EP2) * d2 * d2 / 24
            + (61 + 90 * t + 298 * c + 45 * t * t - 252 * EP2 - 3 * c * c) * d2 * d2 * d2 / 720)
        lon = lon0 + (d - (1 + 2 * t + c) * d2 * d / 6
                      + (5 - 2 * c + 28 * t - 3 * c * c + 8 * EP2 + 24 * t * t) * d2 * d2 * d / 120) / F.cos(p)
        return _point(F.degrees(lon), F.degrees(lat))

    m = (q["y"] - FALSE_NORTH if south else q["y"]) / K0
    return let(let(let(m / per_radian, footpoint), terms), series)


def project_point(p: Column, source, target) -> Column:
    source, target = epsg(source), epsg(target)
    return p if source == target else from_lonlat(to_lonlat(p, source), target)


def project(x: Column, y: Column, source, target) -> tuple[Column, Column]:
    if epsg(source) == epsg(target):
        return x, y
    moved = project_point(_point(x, y), source, target)
    return moved["x"], moved["y"]


def project_all(points: list[tuple[Column, Column]], source, target) -> Column:
    """An array of projected points, the formula standing once in the plan."""
    return F.transform(F.array(*[_point(x, y) for x, y in points]), lambda p: project_point(p, source, target))


EDGE_POINTS = 16  # stretches of a box edge that are projected one by one, as edges become curves


def bbox_to(box: dict, target: int) -> dict:
    """Bounding box of a reprojected box, by points along its edges: literal columns, folded by the optimizer."""
    xs, ys = [], []
    west, south, width, height = box["west"], box["south"], box["east"] - box["west"], box["north"] - box["south"]
    for k in range(EDGE_POINTS + 1):
        share = k / EDGE_POINTS
        for x, y in ((west + share * width, south), (west + share * width, south + height),
                     (west, south + share * height), (west + width, south + share * height)):
            px, py = project(F.lit(float(x)), F.lit(float(y)), box["crs"], target)
            xs.append(px)
            ys.append(py)
    out = {"west": F.least(*xs), "east": F.greatest(*xs), "south": F.least(*ys), "north": F.greatest(*ys)}
    return out
