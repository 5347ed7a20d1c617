"""Comparison, logic and tests for missing data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .math import INF, col


def _folded(x, y):
    return F.lower(col(x)), F.lower(col(y))


def eq(x, y, delta: float | None = None, case_sensitive: bool = True) -> Column:
    if delta is not None:
        return F.abs(col(x) - col(y)) <= delta
    if not case_sensitive:
        x, y = _folded(x, y)
    return col(x) == col(y)


def neq(x, y, delta: float | None = None, case_sensitive: bool = True) -> Column:
    return ~eq(x, y, delta, case_sensitive)


def gt(x, y) -> Column:
    return col(x) > col(y)


def gte(x, y) -> Column:
    return col(x) >= col(y)


def lt(x, y) -> Column:
    return col(x) < col(y)


def lte(x, y) -> Column:
    return col(x) <= col(y)


def between(x, min, max, exclude_max: bool = False) -> Column:
    x = col(x)
    return (x >= min) & ((x < max) if exclude_max else (x <= max))


def and_(x, y) -> Column:
    return col(x) & col(y)


def or_(x, y) -> Column:
    return col(x) | col(y)


def xor(x, y) -> Column:
    return col(x).cast("boolean") != col(y).cast("boolean")


def not_(x) -> Column:
    return ~col(x)


def if_(value, accept, reject=None) -> Column:
    """``accept`` where the value is true; false and null give ``reject``."""
    return F.when(col(value), col(accept)).otherwise(col(reject))


def is_nan(x, numeric: bool = True) -> Column:
    """NaN test; every value of a non-numeric column is not a number."""
    return F.isnan(col(x)) if numeric else F.lit(True)


def is_nodata(x) -> Column:
    return col(x).isNull()


def is_infinite(x) -> Column:
    return F.coalesce(F.abs(col(x)) == F.lit(INF), F.lit(False))


def is_valid(x) -> Column:
    """Neither null nor NaN nor infinite."""
    x = col(x)
    return x.isNotNull() & ~F.isnan(x) & ~is_infinite(x)
