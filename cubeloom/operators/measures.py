"""Sizes of neighbourhoods: pixels, metres, and durations of fixed or calendar length."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: seconds of a unit of time, months of a calendar unit, metres of a unit of length
SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
MONTHS = {"month": 1, "year": 12}
METRES = {"m": 1.0, "km": 1000.0}
DEGREE = 111_319.49079327358  # metres of a degree of the equator

_ISO = re.compile(r"P(?:(\d+)Y)?(?:(\d+)M)?(?:(\d+)W)?(?:(\d+)D)?(?:T(?:(\d+)H)?(?:(\d+)M)?(?:(\d+(?:\.\d+)?)S)?)?", re.I)
_PLAIN = re.compile(r"(\d+(?:\.\d+)?)\s*([a-z]+)", re.I)


@dataclass(frozen=True)
class Measure:
    """An amount of ``px``, ``m``, ``s`` or ``month``."""

    amount: float
    unit: str


def measure(given, temporal: bool) -> Measure:
    """From a number (pixels, for time seconds), a text such as ``100 m``, ``10 days`` or ``P10D``, or a mapping with value and unit."""
    if isinstance(given, Measure):
        return given
    if isinstance(given, dict):
        value, unit = given["value"], given.get("unit")
        return measure(value if unit in (None, "") else f"{value} {unit}", temporal)
    if isinstance(given, (int, float)):
        return Measure(given, "s" if temporal else "px")
    text = str(given).strip()
    iso = _ISO.fullmatch(text)
    if iso and any(iso.groups()):
        years, months, weeks, days, hours, minutes, seconds = (float(g or 0) for g in iso.groups())
        whole, rest = 12 * years + months, ((weeks * 7 + days) * 24 + hours) * 3600 + minutes * 60 + seconds
        if whole and rest:
            raise ValueError(f"a size of calendar and fixed length: {given!r}")
        return _checked(Measure(whole, "month") if whole else Measure(rest, "s"), temporal, given)
    plain = _PLAIN.fullmatch(text)
    if not plain:
        raise ValueError(f"no size: {given!r}")
    amount, name = float(plain[1]), plain[2].lower()
    if name in ("px", "pixel", "pixels"):
        return _checked(Measure(amount, "px"), temporal, given)
    if name in METRES:
        return _checked(Measure(amount * METRES[name], "m"), temporal, given)
    name = name.removesuffix("s")
    if name in SECONDS:
        return _checked(Measure(amount * SECONDS[name], "s"), temporal, given)
    if name in MONTHS:
        return _checked(Measure(amount * MONTHS[name], "month"), temporal, given)
    raise ValueError(f"unknown unit: {given!r}")


def _checked(found: Measure, temporal: bool, given) -> Measure:
    if temporal != (found.unit in ("s", "month")):
        raise ValueError(f"{given!r} does not measure a {'temporal' if temporal else 'spatial'} dimension")
    if found.unit == "month" and found.amount != int(found.amount):
        raise ValueError(f"calendar lengths are whole: {given!r}")
    return found


def by_dimension(sizes) -> dict:
    """``{dimension: size}`` from such a mapping or from a list of mappings that name their dimension."""
    return dict(sizes or {}) if not isinstance(sizes, list) else {s["dimension"]: s for s in sizes}


def in_pixels(size: Measure, step: float, metres_per_unit: Column | float) -> Column | float:
    return size.amount if size.unit == "px" else size.amount / (step * metres_per_unit)


def months_of(t: Column) -> Column:
    return F.year(t) * 12 + F.month(t)


def time_block(t: Column, start: Column, size: Measure) -> Column:
    """The number of the block a time falls into; blocks of months begin with the month of the first label."""
    if size.unit == "month":
        return F.floor((months_of(t) - months_of(start)) / int(size.amount))
    return F.floor((F.unix_micros(t.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / (size.amount * 1e6))


def moved(t: Column, by: Measure, sign: int) -> Column:
    if by.unit == "month":
        return t.cast("timestamp_ntz") + F.make_ym_interval(F.lit(0), F.lit(sign * int(by.amount)))
    return F.timestamp_micros(F.unix_micros(t.cast("timestamp")) + F.lit(int(sign * by.amount * 1e6)))
