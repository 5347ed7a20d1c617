"""Dates and calendar periods. Time columns are timestamps without zone, read as UTC."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import TemporalExtentEmpty
from .math import col

RFC3339 = "yyyy-MM-dd'T'HH:mm:ss'Z'"
UNIT_SECONDS = {"millisecond": 0.001, "second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}


def date_between(x, min, max, exclude_max: bool = False) -> Column:
    x, low, high = col(x), _ts(min), _ts(max)
    return (x >= low) & ((x < high) if exclude_max else (x <= high))


def ntz(value: dt.datetime | None) -> Column:
    """A literal instant; goes by text, so the time zone of the Python process plays no part."""
    return F.lit(value.isoformat(sep=" ") if value else None).cast("timestamp_ntz")


def _ts(value) -> Column:
    return value if isinstance(value, Column) else ntz(parse(value))


def date_difference(date1, date2, unit: str = "second") -> Column:
    """``date2 - date1`` in a unit, with fractions."""
    a, b = _ts(date1).cast("timestamp"), _ts(date2).cast("timestamp")
    if unit in ("month", "year"):
        months = F.months_between(b, a, roundOff=False)
        return months if unit == "month" else months / 12
    if unit not in UNIT_SECONDS:
        raise ValueError(f"unknown unit {unit!r}")
    return (F.unix_micros(b) - F.unix_micros(a)) / F.lit(UNIT_SECONDS[unit] * 1e6)


def date_shift(date, value, unit: str, date_only: bool = False) -> Column:
    """Add n units; a day the target month lacks becomes its last day."""
    units = {"millisecond": "MILLISECOND", "second": "SECOND", "minute": "MINUTE", "hour": "HOUR",
             "day": "DAY", "week": "WEEK", "month": "MONTH", "year": "YEAR"}
    if unit not in units:
        raise ValueError(f"unknown unit {unit!r}")
    source = col(date).cast("timestamp_ntz") if date_only else col(date)
    moved = F.timestamp_add(units[unit], col(value).cast("int"), source)
    return moved.cast("date") if date_only else moved


def rfc3339(x, date_only: bool = False) -> Column:
    """RFC 3339 text of a timestamp or date."""
    x = col(x)
    return F.date_format(x, "yyyy-MM-dd") if date_only else F.date_format(x.cast("timestamp"), RFC3339)


def parse_rfc3339(x) -> Column:
    """Timestamp of RFC 3339 text: a date, or a date-time with or without zone."""
    return F.try_to_timestamp(col(x)).cast("timestamp_ntz")


def parse(value) -> dt.datetime | None:
    """A Python date, date-time or RFC 3339 text (also ``YYYY`` or ``YYYY-MM``) as a UTC date-time."""
    if value is None:
        return None
    if isinstance(value, dt.datetime):
        return value.astimezone(dt.timezone.utc).replace(tzinfo=None) if value.tzinfo else value
    if isinstance(value, dt.date):
        return dt.datetime(value.year, value.month, value.day)
    text = str(value).strip().replace("/", "-")
    short = re.fullmatch(r"(\d{4})(?:-(\d{1,2}))?", text)
    if short:
        return dt.datetime(int(short[1]), int(short[2] or 1), 1)
    return parse(dt.datetime.fromisoformat(text.replace("Z", "+00:00")))


def slot_end(text: str) -> dt.datetime:
    """The instant after the year, month or day that the text names."""
    start = parse(text)
    parts = len(re.split(r"[-/]", text.strip()))
    if parts == 1:
        return dt.datetime(start.year + 1, 1, 1)
    if parts == 2:
        return dt.datetime(start.year + start.month // 12, start.month % 12 + 1, 1)
    if ":" not in text:
        return start + dt.timedelta(days=1)
    raise ValueError(f"{text!r} is an instant, not a year, month or day")


def extent(value, end=None) -> tuple[dt.datetime | None, dt.datetime | None]:
    """A left-closed extent from two values, a pair, or the name of one year, month or day."""
    if end is None and isinstance(value, str):
        return parse(value), slot_end(value)
    start, stop = (value, end) if not isinstance(value, (list, tuple)) else (tuple(value) + (None,))[:2]
    start, stop = parse(start), parse(stop)
    if start and stop and stop <= start:
        raise TemporalExtentEmpty(f"{start} .. {stop}")
    return start, stop


# Calendar periods. Season names by month, and the month a season starts in.
SEASONS = {12: "djf", 1: "djf", 2: "djf", 3: "mam", 4: "mam", 5: "mam",
           6: "jja", 7: "jja", 8: "jja", 9: "son", 10: "son", 11: "son"}
PERIODS = ("hour", "day", "week", "dekad", "month", "season", "tropical-season", "year", "decade", "decade-ad")


def _pad(x: Column, n: int) -> Column:
    return F.lpad(x.cast("string"), n, "0")


def period_start(t: Column, period: str) -> Column:
    """The first instant of the calendar period an instant lies in."""
    kind = "timestamp_ntz"
    if period in ("hour", "day", "week", "month", "year"):
        return F.date_trunc(period, t).cast(kind)
    if period == "dekad":
        first = F.least(F.floor((F.dayofmonth(t) - 1) / 10) * 10, F.lit(20))
        return F.timestamp_add("DAY", first.cast("int"), F.date_trunc("month", t).cast(kind))
    if period == "season":
        return F.timestamp_add("MONTH", -(F.month(t) % 3), F.date_trunc("month", t).cast(kind))
    if period == "tropical-season":
        return F.timestamp_add("MONTH", -((F.month(t) + 1) % 6), F.date_trunc("month", t).cast(kind))
    if period in ("decade", "decade-ad"):
        back = F.year(t) % 10 if period == "decade" else (F.year(t) + 9) % 10
        return F.timestamp_add("YEAR", -back, F.date_trunc("year", t).cast(kind))
    raise ValueError(f"unknown period {period!r}, use one of {PERIODS}")


def period_part(t: Column, period: str) -> Column:
    """The part of a period label without the year, such as ``djf`` or ``07``."""
    month = F.month(t)
    if period == "hour":
        return _pad(F.hour(t), 2)
    if period == "day":
        return _pad(F.dayofyear(t), 3)
    if period == "week":
        return _pad(F.weekofyear(t), 2)
    if period == "dekad":
        return _pad((month - 1) * 3 + F.least(F.floor((F.dayofmonth(t) - 1) / 10), F.lit(2)) + 1, 2)
    if period == "month":
        return _pad(month, 2)
    if period == "season":
        return F.element_at(F.array(*[F.lit(SEASONS[m]) for m in range(1, 13)]), month)
    if period == "tropical-season":
        return F.when(month.between(5, 10), "mjjaso").otherwise("ndjfma")
    return period_label(t, period)


def period_label(t: Column, period: str) -> Column:
    """The label of the period, such as ``2020-djf``.

    A season that starts in one year and ends in the next takes the later year, a week
    its ISO year.
    """
    year, month = F.year(t), F.month(t)
    if period == "hour":
        return F.concat(F.date_format(t, "yyyy-MM-dd-"), period_part(t, period))
    if period == "week":
        year = F.extract(F.lit("YEAROFWEEK"), t)
    elif period == "season":
        year = year + F.when(month == 12, 1).otherwise(0)
    elif period == "tropical-season":
        year = year + F.when(month >= 11, 1).otherwise(0)
    elif period == "year":
        return _pad(year, 4)
    elif period == "decade":
        return _pad(year - year % 10, 4)
    elif period == "decade-ad":
        return _pad(year - (year + 9) % 10, 4)
    return F.concat(_pad(year, 4), F.lit("-"), period_part(t, period))


def period_spine(first: Column, last: Column, period: str) -> Column:
    """An array with the first instants of all periods from ``first`` to ``last``."""
    steps = {"hour": "HOUR", "day": "DAY", "week": "WEEK", "month": "MONTH", "season": "QUARTER",
             "tropical-season": "HALF", "year": "YEAR", "decade": "DECADE", "decade-ad": "DECADE"}
    start, stop = period_start(first, period), period_start(last, period)
    if period == "dekad":
        months = F.sequence(F.date_trunc("month", first), F.date_trunc("month", last), F.expr("interval 1 month"))
        all_ = F.flatten(F.transform(months, lambda m: F.array(*[
            F.timestamp_add("DAY", F.lit(d), m.cast("timestamp_ntz")) for d in (0, 10, 20)])))
        return F.filter(all_, lambda d: (d >= start) & (d <= stop))
    step = {"QUARTER": "3 month", "HALF": "6 month", "DECADE": "10 year"}.get(steps[period], f"1 {steps[period]}")
    return F.sequence(start, stop, F.expr(f"interval {step}"))
