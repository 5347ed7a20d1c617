"""Comparing two cubes with tolerance."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .merge import outer_join


def cube_differences(actual, expected, rtol: float = 1e-6, atol: float = 1e-6) -> DataFrame:
    """Per slice of the non-spatial labels and band, how far the two cubes differ.

    A cell differs when ``|actual - expected| > atol + rtol * |expected|`` or when only one
    cube has a value; NaN equals NaN. Slices without a difference are left out.
    """
    if actual.schema.dim_names != expected.schema.dim_names or actual.schema.values != expected.schema.values:
        raise ValueError(f"cubes differ in shape: {actual.schema.all_names}, {expected.schema.all_names}")
    a, e = actual.to_values(), expected.to_values()
    dims = a.schema.dim_names
    value = a.schema.values[0]
    left = a.df.select(*dims, F.col(value).cast("double").alias("__a"))
    right = e.df.select(*dims, F.col(value).cast("double").alias("__e"))
    both = outer_join(left, right, a.schema)
    gap = F.abs(F.col("__a") - F.col("__e"))
    bad = F.coalesce(
        (gap > atol + rtol * F.abs(F.col("__e"))) & ~(F.isnan("__a") & F.isnan("__e")),
        F.col("__a").isNull() != F.col("__e").isNull())
    both = both.withColumns({"__bad": bad, "__d": F.when(bad, gap)})
    x, y = a.schema.xy
    out = both.groupBy(*a.schema.others(x, y)).agg(
        F.count_if("__bad").alias("diff_count"), F.count("__e").alias("total_count"),
        F.min("__d").alias("diff_min"), F.max("__d").alias("diff_max"), F.avg("__d").alias("diff_mean"),
        F.var_pop("__d").alias("diff_var"),
        *[f(F.when(F.col("__bad"), F.col(c))).alias(n) for n, f, c in (
            ("min_x", F.min, x), ("min_y", F.min, y), ("max_x", F.max, x), ("max_y", F.max, y))])
    out = out.withColumn("diff_share", F.try_divide(F.col("diff_count") * 100.0, F.col("total_count")))
    return out.where("diff_count > 0")


def assert_cubes_close(actual, expected, rtol: float = 1e-6, atol: float = 1e-6, pixel_tolerance: float = 0.0) -> None:
    """Raise AssertionError with the worst slices unless the cubes agree.

    ``pixel_tolerance`` is the share of differing pixels, in percent, that may be ignored.
    """
    issues = cube_differences(actual, expected, rtol, atol)
    total = expected.to_values().df.select(F.count("value")).first()[0] if pixel_tolerance else 0
    bad = issues.agg(F.sum("diff_count")).first()[0] or 0
    if bad and not (pixel_tolerance and bad * 100.0 / max(total, 1) <= pixel_tolerance):
        worst = issues.orderBy(F.desc("diff_max")).limit(10).collect()
        raise AssertionError(f"{bad} differing pixels; worst slices: {[r.asDict() for r in worst]}")
