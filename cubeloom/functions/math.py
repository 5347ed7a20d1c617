"""Scalar math, as functions from Column to Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NAN = float("nan")
INF = float("inf")


def col(x) -> Column:
    """Columns stay, anything else is a literal."""
    return x if isinstance(x, Column) else F.lit(x)


def absolute(x) -> Column:
    return F.abs(col(x))


def add(x, y) -> Column:
    return col(x) + col(y)


def subtract(x, y) -> Column:
    return col(x) - col(y)


def multiply(x, y) -> Column:
    return col(x) * col(y)


def divide(x, y, ieee: bool = False) -> Column:
    """Quotient. A zero divisor gives null, or with ``ieee`` the infinities and NaN."""
    x, y = col(x).cast("double"), col(y).cast("double")
    quotient = F.try_divide(x, y)
    if not ieee:
        return quotient
    limit = F.when((x == 0) | F.isnan(x), NAN).when(x > 0, INF).otherwise(-INF)
    return F.when((y == 0) & x.isNotNull(), limit).otherwise(quotient)


def mod(x, y) -> Column:
    """Remainder with the sign of the divisor; null for a zero divisor."""
    x, y = col(x).cast("double"), col(y).cast("double")
    return x - y * F.floor(F.try_divide(x, y))


def power(base, p) -> Column:
    return F.pow(col(base), col(p))


def exp(p) -> Column:
    return F.exp(col(p))


def ln(x) -> Column:
    return F.ln(col(x))


def log(x, base) -> Column:
    if base == 2:
        return F.log2(col(x))
    if base == 10:
        return F.log10(col(x))
    return F.try_divide(F.ln(col(x)), F.ln(col(base)))


def log2(x) -> Column:
    return log(x, 2)


def log10(x) -> Column:
    return log(x, 10)


def sqrt(x) -> Column:
    return F.sqrt(col(x))


def sgn(x) -> Column:
    return F.signum(col(x))


def ceil(x) -> Column:
    return F.ceil(col(x))


def floor(x) -> Column:
    return F.floor(col(x))


def int_(x) -> Column:
    """Integer part, towards zero."""
    x = col(x)
    return F.when(x < 0, F.ceil(x)).otherwise(F.floor(x))


def round_(x, p: int = 0) -> Column:
    """Round to p digits, ties to the even digit; negative p rounds to powers of ten."""
    return F.bround(col(x), p)


def clip(x, min, max) -> Column:
    x, low, high = col(x), col(min), col(max)
    return F.when(x < low, low).when(x > high, high).otherwise(x)


def linear_scale_range(x, input_min, input_max, output_min=0.0, output_max=1.0) -> Column:
    """Clip to the input range, then map it linearly to the output range."""
    low, high, to, top = (float(v) for v in (input_min, input_max, output_min, output_max))
    inside = clip(col(x).cast("double"), low, high)
    return (inside - low) / (high - low) * (top - to) + to


def normalized_difference(x, y) -> Column:
    x, y = col(x), col(y)
    return F.try_divide(x - y, x + y)


def sin(x) -> Column:
    return F.sin(col(x))


def cos(x) -> Column:
    return F.cos(col(x))


def tan(x) -> Column:
    return F.tan(col(x))


def arcsin(x) -> Column:
    return F.asin(col(x))


def arccos(x) -> Column:
    return F.acos(col(x))


def arctan(x) -> Column:
    return F.atan(col(x))


def arctan2(y, x) -> Column:
    return F.atan2(col(y), col(x))


def sinh(x) -> Column:
    return F.sinh(col(x))


def cosh(x) -> Column:
    return F.cosh(col(x))


def tanh(x) -> Column:
    return F.tanh(col(x))


def arsinh(x) -> Column:
    return F.asinh(col(x))


def arcosh(x) -> Column:
    return F.acosh(col(x))


def artanh(x) -> Column:
    return F.atanh(col(x))


def pi() -> Column:
    return F.pi()


def e() -> Column:
    return F.e()


def nan() -> Column:
    return F.lit(NAN)


def constant(x) -> Column:
    return F.lit(x)


UNSIGNED_TOP = {"uint8": 2**8 - 1, "uint16": 2**16 - 1, "uint32": 2**32 - 1}
SIGNED = {"int8": ("tinyint", 7), "int16": ("smallint", 15), "int32": ("int", 31), "int64": ("bigint", 63)}
NEXT_SIGNED = {"uint8": "smallint", "uint16": "int", "uint32": "bigint"}


def convert(x: Column, data_type: str) -> Column:
    """Cast to a named numeric type; integers are limited to the range of the type."""
    if data_type in UNSIGNED_TOP:
        return clip(x, 0, UNSIGNED_TOP[data_type]).cast(NEXT_SIGNED[data_type])
    if data_type in SIGNED:
        name, bits = SIGNED[data_type]
        return x.cast("bigint").cast(name) if bits == 63 else clip(x, -(2**bits), 2**bits - 1).cast(name)
    types = {"float32": "float", "float64": "double", "boolean": "boolean", "string": "string"}
    if data_type not in types:
        raise ValueError(f"unknown data type {data_type!r}")
    return x.cast(types[data_type])
