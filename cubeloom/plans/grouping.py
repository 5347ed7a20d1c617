"""Group reduction shared by all aggregating operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.reducers import Reducer, resolve
from . import ranked


def group_reduce(
    df: DataFrame, keys: list[str], values: list[str], reducer, order: str | None = None, extra=(),
) -> DataFrame:
    """Reduce the value columns per group.

    Algebraic reducers become one ``groupBy().agg`` with a partial aggregate before the
    shuffle, rank-based ones the plan in ``ranked``. ``extra`` holds more aggregates.
    """
    red: Reducer = resolve(reducer)
    if red.ranked is None:
        aggs = [red.agg(F.col(v), F.col(order) if order else None).alias(v) for v in values]
        return df.groupBy(*keys).agg(*aggs, *extra)
    if red.ranked == "mode":
        out = ranked.modes(df, keys, values)
    else:
        out = ranked.quantiles(df, keys, values, list(red.ranked))
        if red.scalar:
            out = out.withColumns({v: F.col(v)[0] for v in values})
    checks = list(extra)
    if red.strict:
        checks += [F.count_if(F.col(v).isNull()).alias(f"__nulls_{v}") for v in values]
    if checks:
        side = df.groupBy(*keys).agg(*checks)
        out = out.join(side, keys) if keys else out.withColumns(
            {c: side.select(c).scalar() for c in side.columns}
        )
    if red.strict:
        blank = [F.lit(None).cast("double")] * (1 if red.scalar else len(red.ranked))
        null = blank[0] if red.scalar else F.array(*blank)
        out = out.withColumns({v: F.when(F.col(f"__nulls_{v}") > 0, null).otherwise(F.col(v)) for v in values})
        out = out.drop(*[f"__nulls_{v}" for v in values])
    return out
