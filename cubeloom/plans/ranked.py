"""Exact order statistics of a group without gathering or sorting an unbounded group.

The built-in ``percentile`` keeps the distinct values of a group in one buffer. Instead,
at every size, equal values are counted first and dealt by their leading binary digits.
A histogram of those digits per group (its size follows the number of digits, not of rows) tells in
which bucket each wanted rank lies; only values of these buckets are put in order.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scan import shared

STEPS = 4096  # buckets of one power of two


def leading_digits(value: Column) -> Column:
    """A whole number that never falls as the value rises: sign, exponent and the first 12 binary digits.

    An exponent that the logarithm rounds to a neighbour gives the same number, since the
    digits then count past their range. NaN stands above infinity, as in Spark's order.
    """
    size = F.abs(value)
    exponent = F.floor(F.log2(size))
    digits = exponent * STEPS + F.floor(size / F.pow(F.lit(2.0), exponent) * STEPS)
    top = F.lit(2200 * STEPS)  # above 1024 + 1100
    rank = F.when(size == float("inf"), top).otherwise(digits + 1100 * STEPS)
    return F.when(value == 0, F.lit(0)).when(F.isnan(value), top + 1).when(value < 0, -rank).otherwise(rank).cast("long")


def _counted(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """How often every value occurs per group and column ``__i``; nulls too, so that no group is lost."""
    long = df.select(
        *keys,
        F.explode(F.array(*[
            F.struct(F.lit(i).alias("i"), F.col(v).cast("double").alias("v")) for i, v in enumerate(values)
        ])).alias("__e"),
    ).select(*keys, F.col("__e.i").alias("__i"), F.col("__e.v").alias("__v"))
    return long.groupBy(*keys, "__i", "__v").agg(F.count(F.lit(1)).alias("__n"))


def quantiles(df: DataFrame, keys: list[str], values: list[str], probabilities: list[float]) -> DataFrame:
    """One array of interpolated quantiles per group and value column; nulls are skipped."""
    no_value = F.lit(-(2**62)).cast("long")
    counted = _counted(df, keys, values).withColumn("__d", F.coalesce(leading_digits(F.col("__v")), no_value))
    series, bucket = [*keys, "__i"], [*keys, "__i", "__d"]
    dealt, count = shared(counted, *bucket)

    def hits(cum: Column, n: Column) -> dict[str, Column]:
        found = {}
        for j, p in enumerate(probabilities):
            pos = (F.col("__all") - 1) * F.lit(float(p))
            for side, rank in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
                found[f"{side}{j}"] = (cum > rank) & (cum - n <= rank)
        return found

    def some(found: dict[str, Column]) -> Column:
        return F.array_contains(F.array(*found.values()), True)

    valid = F.when(F.col("__v").isNotNull(), F.col("__n")).otherwise(F.lit(0))
    upto = Window.partitionBy(*series).orderBy("__d").rowsBetween(Window.unboundedPreceding, 0)
    histogram = dealt.groupBy(*bucket).agg(F.sum(valid).alias("__c"), count.alias("__rows")).where("__rows > 0").withColumns(
        {"__upto": F.sum("__c").over(upto), "__all": F.sum("__c").over(Window.partitionBy(*series))})
    wanted = histogram.where(some(hits(F.col("__upto"), F.col("__c"))) | (F.col("__d") == no_value)).select(
        *bucket, (F.col("__upto") - F.col("__c")).alias("__front"), "__all")
    inside = Window.partitionBy(*bucket).orderBy("__v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = dealt.join(wanted, bucket).withColumn("__m", valid).withColumn("__cum", F.col("__front") + F.sum("__m").over(inside))
    hit = hits(F.col("__cum"), F.col("__m"))
    picked = ranked.where(some(hit) | F.col("__v").isNull()).groupBy(*keys).agg(
        *[F.max(F.when((F.col("__i") == i) & h, F.col("__v"))).alias(f"__{i}_{n}")
          for i in range(len(values)) for n, h in hit.items()],
        *[F.max(F.when(F.col("__i") == i, F.col("__all"))).alias(f"__{i}_all") for i in range(len(values))],
    )

    def one(i: int, j: int, p: float):
        pos = (F.col(f"__{i}_all") - 1) * F.lit(float(p))
        low, high = F.col(f"__{i}_lo{j}"), F.col(f"__{i}_hi{j}")
        return low + (high - low) * (pos - F.floor(pos))

    return picked.select(
        *keys, *[F.array(*[one(i, j, p) for j, p in enumerate(probabilities)]).alias(v) for i, v in enumerate(values)]
    )


def modes(df: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The most frequent value per group and value column, the smallest on a tie."""
    counted = _counted(df, keys, values)
    return counted.groupBy(*keys).agg(*[
        F.max_by("__v", F.when((F.col("__i") == i) & F.col("__v").isNotNull(), F.struct("__n", -F.col("__v")))).alias(v)
        for i, v in enumerate(values)
    ])


def probabilities_of(probabilities, q: int | None = None) -> list[float]:
    """A list of probabilities, or the q-1 cut points of q equal intervals."""
    from ..errors import AscendingProbabilitiesRequired

    if probabilities is None:
        probabilities = q
    if isinstance(probabilities, int):
        return [i / probabilities for i in range(1, probabilities)]
    probs = [float(p) for p in probabilities]
    if probs != sorted(probs) or any(not 0 <= p <= 1 or math.isnan(p) for p in probs):
        raise AscendingProbabilitiesRequired(str(probabilities))
    return probs
