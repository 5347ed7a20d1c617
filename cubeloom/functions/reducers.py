"""Reducers, each as a group aggregate and as an expression over one array.

Rank-based reducers (median, quantiles, mode) have no group aggregate here: over groups
of unknown size they run as the plan in ``plans.ranked``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import UnsupportedReducer
from .logic import is_valid


@dataclass(frozen=True)
class Reducer:
    name: str
    agg: Callable[[Column, Column | None], Column] | None
    arr: Callable[[Column], Column]
    ranked: tuple[float, ...] | str | None = None
    scalar: bool = True
    strict: bool = False


def _some(a: Column) -> Column:
    return F.filter(a, lambda v: v.isNotNull())


def _fold(a: Column, step) -> Column:
    some = F.transform(_some(a), lambda v: v.cast("double"))
    return F.aggregate(some, F.lit(None).cast("double"), lambda acc, v: F.when(acc.isNull(), v).otherwise(step(acc, v)))


def _arr_sum(a):
    return _fold(a, lambda x, y: x + y)


def _arr_mean(a):
    return F.try_divide(_arr_sum(a), F.size(_some(a)))


def _arr_var(a):
    m = _arr_mean(a)
    squares = F.transform(_some(a), lambda v: (v - m) * (v - m))
    return F.when(F.size(_some(a)) > 1, _arr_sum(squares) / (F.size(_some(a)) - 1))


def _arr_quantiles(a: Column, probs) -> Column:
    ordered, n = F.sort_array(_some(a)), F.size(_some(a))

    def one(p: float) -> Column:
        pos = (n - 1) * F.lit(p)
        low, high = F.get(ordered, F.floor(pos).cast("int")), F.get(ordered, F.ceil(pos).cast("int"))
        return F.when(n > 0, low + (high - low) * (pos - F.floor(pos)))

    return F.array(*[one(p) for p in probs])


def _arr_mode(a: Column) -> Column:
    some = _some(a)
    counted = F.transform(
        F.array_distinct(some),
        lambda v: F.struct(F.size(F.filter(some, lambda w: w == v)).alias("n"), (-v).alias("neg"), v.alias("v")),
    )
    return F.array_max(counted)["v"]


def _make(name: str, ignore_nodata: bool, agg, arr, **kw) -> Reducer:
    """Wrap the two forms so that with ``ignore_nodata=False`` one null makes the result null."""
    if ignore_nodata:
        return Reducer(name, agg, arr, **kw)

    def strict_agg(c, order):
        return F.when(F.count(F.lit(1)) == F.count(c), agg(c, order))

    def strict_arr(a):
        return F.when(~F.exists(a, lambda v: v.isNull()), arr(a))

    return Reducer(name, strict_agg if agg else None, strict_arr, strict=True, **kw)


def sum(ignore_nodata: bool = True) -> Reducer:
    return _make("sum", ignore_nodata, lambda c, o: F.sum(c), _arr_sum)


def product(ignore_nodata: bool = True) -> Reducer:
    return _make("product", ignore_nodata, lambda c, o: F.product(c), lambda a: _fold(a, lambda x, y: x * y))


def mean(ignore_nodata: bool = True) -> Reducer:
    return _make("mean", ignore_nodata, lambda c, o: F.avg(c), _arr_mean)


def min(ignore_nodata: bool = True) -> Reducer:
    return _make("min", ignore_nodata, lambda c, o: F.min(c), lambda a: F.array_min(a))


def max(ignore_nodata: bool = True) -> Reducer:
    return _make("max", ignore_nodata, lambda c, o: F.max(c), lambda a: F.array_max(a))


def extrema(ignore_nodata: bool = True) -> Reducer:
    return _make(
        "extrema", ignore_nodata, lambda c, o: F.array(F.min(c), F.max(c)),
        lambda a: F.array(F.array_min(a), F.array_max(a)), scalar=False,
    )


def sd(ignore_nodata: bool = True) -> Reducer:
    return _make("sd", ignore_nodata, lambda c, o: F.stddev_samp(c), lambda a: F.sqrt(_arr_var(a)))


def variance(ignore_nodata: bool = True) -> Reducer:
    return _make("variance", ignore_nodata, lambda c, o: F.var_samp(c), _arr_var)


def rms(ignore_nodata: bool = True) -> Reducer:
    return _make(
        "rms", ignore_nodata, lambda c, o: F.sqrt(F.avg(c * c)),
        lambda a: F.sqrt(_arr_mean(F.transform(a, lambda v: v * v))),
    )


def median(ignore_nodata: bool = True) -> Reducer:
    return _make("median", ignore_nodata, None, lambda a: _arr_quantiles(a, [0.5])[0], ranked=(0.5,))


def quantiles(probabilities=None, q: int | None = None, ignore_nodata: bool = True) -> Reducer:
    from ..plans.ranked import probabilities_of

    probs = tuple(probabilities_of(probabilities, q))
    return _make("quantiles", ignore_nodata, None, lambda a: _arr_quantiles(a, probs), ranked=probs, scalar=False)


def mode() -> Reducer:
    return Reducer("mode", None, _arr_mode, ranked="mode")


def count(condition=None) -> Reducer:
    """Valid values by default, all with ``True``, or those a function of the value accepts."""
    if condition is True:
        return Reducer("count", lambda c, o: F.count(F.lit(1)), lambda a: F.size(a).cast("long"))
    test = condition or is_valid
    return Reducer(
        "count", lambda c, o: F.count_if(F.coalesce(test(c), F.lit(False))),
        lambda a: F.size(F.filter(a, lambda v: F.coalesce(test(v), F.lit(False)))).cast("long"),
    )


def _ends(name: str, pick, at: int, ignore_nodata: bool) -> Reducer:
    def agg(c, order):
        if order is None:
            raise UnsupportedReducer(f"{name} needs an ordered dimension")
        return pick(c, F.when(c.isNotNull(), order) if ignore_nodata else order)

    def arr(a):
        src = _some(a) if ignore_nodata else a
        return F.get(src, F.lit(0) if at == 0 else F.size(src) - 1)

    return Reducer(name, agg, arr)


def first(ignore_nodata: bool = True) -> Reducer:
    return _ends("first", F.min_by, 0, ignore_nodata)


def last(ignore_nodata: bool = True) -> Reducer:
    return _ends("last", F.max_by, -1, ignore_nodata)


def all(ignore_nodata: bool = True) -> Reducer:
    """True if every value is; strict form is three-valued."""
    if ignore_nodata:
        return Reducer("all", lambda c, o: F.bool_and(c), lambda a: F.when(F.size(_some(a)) > 0, F.forall(_some(a), lambda v: v)))
    return Reducer(
        "all", lambda c, o: F.when(~F.bool_and(c), F.lit(False)).when(F.count(F.lit(1)) > F.count(c), None).otherwise(F.bool_and(c)),
        lambda a: F.forall(a, lambda v: v),
    )


def any(ignore_nodata: bool = True) -> Reducer:
    if ignore_nodata:
        return Reducer("any", lambda c, o: F.bool_or(c), lambda a: F.when(F.size(_some(a)) > 0, F.exists(_some(a), lambda v: v)))
    return Reducer(
        "any", lambda c, o: F.when(F.bool_or(c), F.lit(True)).when(F.count(F.lit(1)) > F.count(c), None).otherwise(F.bool_or(c)),
        lambda a: F.exists(a, lambda v: v),
    )


class Series:
    """What a reducer function gets: the values of one group, as aggregate expressions."""

    def __init__(self, column: Column, order: Column | None, array: bool = False):
        self._column, self._order, self._array = column, order, array

    def reduce(self, reducer) -> Column:
        red = resolve(reducer)
        if self._array:
            return red.arr(self._column)
        if red.agg is None:
            raise UnsupportedReducer(f"pass {red.name} as the reducer itself; it is not an aggregate expression")
        return red.agg(self._column, self._order)

    def __getattr__(self, name: str):
        if name not in NAMES:
            raise AttributeError(name)
        return lambda *a, **k: self.reduce(NAMES[name](*a, **k))


NAMES = {f.__name__: f for f in (
    sum, product, mean, median, min, max, extrema, sd, variance, quantiles, count, first, last, all, any, mode, rms)}


def resolve(reducer) -> Reducer:
    """A reducer from its name, itself, a factory, or a function of a ``Series``."""
    if isinstance(reducer, Reducer):
        return reducer
    if isinstance(reducer, str):
        if reducer not in NAMES:
            raise UnsupportedReducer(reducer)
        return NAMES[reducer]()
    if reducer in NAMES.values():
        return reducer()
    return Reducer("custom", lambda c, o: reducer(Series(c, o)), lambda a: reducer(Series(a, None, array=True)))
