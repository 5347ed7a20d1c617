"""Ordered scans that do not put one unbounded key into one task.

A plain ``Window.partitionBy(key).orderBy(t)`` sorts the whole series of a key in one
task. Here, at every size, the order column is cut into ranges of about equal row counts
(a mergeable quantile sketch gives the cuts, as a subquery of the plan), the window runs
per (key, range), one summary row per (key, range) is carried forward, and both are put
together. Then no task sees more of one key than one range holds, even if that key has a
third of all rows. Rows are shuffled once, by key and range: the summaries read the same
shuffle files, so apart from the cuts (one column) the input is read once. One scan can
carry several running values and the positions they were met at. No Spark job runs while a
plan is built.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = "__chunk"


def range_count(df: DataFrame) -> int:
    """Number of ranges: a power of two that follows the configured parallelism, without a stop."""
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n = 8
    while n < wanted:
        n *= 2
    return n


def order_key(df: DataFrame, name: str) -> Column:
    """A numeric image of an order column, monotone in it."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.unix_micros(F.col(name).cast("timestamp"))
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(name)
    if isinstance(dtype, T.DateType):
        return F.unix_date(name).cast("long")
    if isinstance(dtype, T.NumericType):
        return F.col(name)
    raise TypeError(f"cannot range-partition by {dtype.simpleString()} column {name!r}")


def cut_points(df: DataFrame, order: str, ranges: int) -> DataFrame:
    """One row with the borders of ranges of about equal row counts, to be used as a subquery."""
    return df.select(F.percentile_approx(
        order_key(df, order), [i / ranges for i in range(1, ranges)], max(10_000, 20 * ranges)).alias("cuts"))


def with_chunk(df: DataFrame, order: str, ranges: int | None = None, cuts: DataFrame | None = None) -> DataFrame:
    """Add the range number of ``order`` to every row; ``cuts`` of another table make its ranges those of both."""
    ranges = ranges or range_count(df)
    if ranges == 1:
        return df.withColumn(CHUNK, F.lit(0))
    cuts = cut_points(df, order, ranges) if cuts is None else cuts
    steps = []
    step = ranges // 2
    while step:
        steps.append(step)
        step //= 2
    found = F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda low, s: F.when(F.get(F.col("__cuts"), low + s - 1) < F.col("__key"), low + s).otherwise(low),
    )
    return (
        df.withColumns({"__cuts": cuts.scalar(), "__key": order_key(df, order)})
        .withColumn(CHUNK, F.coalesce(F.when(F.col("__key").isNotNull(), found), F.lit(0)))
        .drop("__cuts", "__key")
    )


@dataclass(frozen=True)
class Running:
    """One running value.

    ``window`` is applied to rows in order and to the summaries in order of the ranges;
    ``summary`` condenses the rows of one range, in any order; ``combine`` joins what
    came before the range with what was seen inside it. ``shift`` moves a value that holds
    places within its range by the number of rows in front of the range; ``value`` may
    use such a place as the column ``AT`` (1 for the first row of a range).
    """

    window: Callable[[Column], Column]
    value: Column
    combine: Callable[[Column, Column], Column]
    summary: Callable[[Column], Column] | None = None
    forward: bool = True
    total: bool = False  # the value over the whole key instead of the running one
    shift: Callable[[Column, Column], Column] | None = None


AT = "__at"  # place of a row within its key and range


def running_sum(value: Column) -> Running:
    return Running(F.sum, value, lambda c, l: F.when(c.isNull(), l).when(l.isNull(), c).otherwise(c + l))


def running_product(value: Column) -> Running:
    return Running(F.product, value, lambda c, l: F.when(c.isNull(), l).when(l.isNull(), c).otherwise(c * l))


def running_max(value: Column) -> Running:
    return Running(F.max, value, lambda c, l: F.greatest(c, l))


def running_min(value: Column) -> Running:
    return Running(F.min, value, lambda c, l: F.least(c, l))


def total_sum(value: Column) -> Running:
    return Running(F.sum, value, lambda c, l: c, total=True)


def position() -> Running:
    """The 1-based place of a row in the series of its key."""
    return Running(F.max, F.col(AT), lambda c, l: l, shift=lambda at, rows: at + rows)


def _known(value: Column, order: Column) -> Column:
    return F.when(value.isNotNull(), F.struct(order.alias("o"), value.alias("v")))


def _moved(known: Column, rows: Column) -> Column:
    return F.when(known.isNotNull(), F.struct((known["o"] + rows).alias("o"), known["v"].alias("v")))


def last_known(value: Column, order: Column | None = None) -> Running:
    """The latest ``struct(order, value)`` so far whose value is not null; without an order, with its position."""
    return Running(F.max, _known(value, F.col(AT) if order is None else order), lambda c, l: F.coalesce(l, c), shift=_moved if order is None else None)


def next_known(value: Column, order: Column | None = None) -> Running:
    """The earliest ``struct(order, value)`` from here on whose value is not null; without an order, with its position."""
    return Running(F.min, _known(value, F.col(AT) if order is None else order), lambda c, l: F.coalesce(l, c), forward=False,
                   shift=_moved if order is None else None)


def _running_frame(part, *order: Column, last: int = 0):
    """Rows so far. Backward runs sort the other way: a frame that ends unbounded costs n squared."""
    return part.orderBy(*order).rowsBetween(Window.unboundedPreceding, last)


def shared(rows: DataFrame, *by: str) -> tuple[DataFrame, Column]:
    """``rows`` shuffled by columns, and a row count for aggregates over them that read the same shuffle.

    Two readers share the files of a shuffle only if both ask it for the same columns. The
    count names every column in a condition that always holds, so that none is pruned.
    """
    return rows.repartition(*by), F.count_if(F.hash(*[F.col(f"`{c}`") for c in rows.columns]) >= F.lit(-(2**31)))


def scan(
    df: DataFrame, keys: list[str], order: str, runs: dict[str, Running], ranges: int | None = None, then: str | None = None,
) -> DataFrame:
    """Add one column per running value to ``df``, whose rows may have their ranges already; ``then`` orders rows of one place."""
    rows, count = shared(df if CHUNK in df.columns else with_chunk(df, order, ranges), *keys, CHUNK)
    part = Window.partitionBy(*keys, CHUNK)
    by = [order, then] if then else [order]
    before, after = _running_frame(part, *map(F.asc, by)), _running_frame(part, *map(F.desc, by))
    placed = any(r.shift for r in runs.values())
    if placed:
        rows = rows.withColumn(AT, F.row_number().over(part.orderBy(*map(F.asc, by))).cast("long"))
    rows = rows.withColumns({f"__v_{n}": r.value for n, r in runs.items()})
    local = rows.withColumns(
        {f"__l_{n}": r.window(F.col(f"__v_{n}")).over(before if r.forward else after)
         for n, r in runs.items() if not r.total}
    )
    sums = rows.groupBy(*keys, CHUNK).agg(
        count.alias("__rows"),
        *[(r.summary or r.window)(F.col(f"__v_{n}")).alias(f"__s_{n}") for n, r in runs.items()]
    ).where("__rows > 0")
    # at most one row per key and range from here on
    call = Window.partitionBy(*(keys or [F.lit(0)]))
    cbefore, cafter = _running_frame(call, F.asc(CHUNK), last=-1), _running_frame(call, F.desc(CHUNK), last=-1)
    if placed:
        sums = sums.withColumn("__front", F.coalesce(F.sum("__rows").over(cbefore), F.lit(0)))
        sums = sums.withColumns({f"__s_{n}": r.shift(F.col(f"__s_{n}"), F.col("__front")) for n, r in runs.items() if r.shift})
    carry = sums.select(
        *keys, CHUNK, *(["__front"] if placed else []),
        *[r.window(F.col(f"__s_{n}")).over(call if r.total else cbefore if r.forward else cafter).alias(f"__c_{n}")
          for n, r in runs.items()],
    )
    joined = local.join(carry, [*keys, CHUNK])

    def found(n: str, r: Running) -> Column:
        if r.total:
            return F.col(f"__c_{n}")
        inside = F.col(f"__l_{n}")
        return r.combine(F.col(f"__c_{n}"), r.shift(inside, F.col("__front")) if r.shift else inside)

    return joined.select(*df.columns, *[found(n, r).alias(n) for n, r in runs.items()])


def with_position(df: DataFrame, keys: list[str], order: str, name: str = "__pos", total: str | None = None,
                  more: dict[str, Running] | None = None) -> DataFrame:
    """Add the 0-based position in the series of each key (and its length), with other running values of the same scan."""
    runs = {"__rank": position(), **(more or {})}
    if total:
        runs[total] = total_sum(F.lit(1).cast("long"))
    return scan(df, keys, order, runs).withColumn(name, F.col("__rank") - 1).drop("__rank")
