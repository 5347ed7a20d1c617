"""Run tables: one row per run, with status, times and costs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..errors import MissingParameter

# Columns of a run table and their types.
RUN_COLUMNS = {
    "id": "string", "backend_name": "string", "status": "string", "start_time": "string",
    "running_start_time": "string", "cpu": "string", "memory": "string", "duration": "string", "costs": "double",
}


def normalize_runs(df: DataFrame) -> DataFrame:
    """Add the columns a run table lacks; a run without status is ``not_started``."""
    for name, kind in RUN_COLUMNS.items():
        if name not in df.columns:
            value = F.lit("not_started") if name == "status" else F.lit(None)
            df = df.withColumn(name, value.cast(kind))
    return df


def count_by_status(df: DataFrame, statuses: list[str] | None = None) -> DataFrame:
    rows = df.where(F.col("status").isin(list(statuses))) if statuses is not None else df
    return rows.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def get_by_status(df: DataFrame, statuses: list[str], max: int | None = None, order: str = "id") -> DataFrame:
    """Rows with one of the statuses; at most ``max``, in order of the id."""
    rows = df.where(F.col("status").isin(list(statuses))) if statuses else df
    return rows if max is None else rows.orderBy(order).limit(max)


def get_by_ids(df: DataFrame, ids: list, key: str = "id") -> DataFrame:
    return df.where(F.col(key).isin(list(ids)))


def update_runs(df: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """New values by id; unknown ids are ignored, columns and rows not named stay."""
    cols = [c for c in changes.columns if c != key and c in df.columns]
    new = changes.select(key, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in cols])
    joined = df.join(new, key, "left")
    return joined.select(*[
        F.when(F.col("__hit"), F.coalesce(F.col(f"__new_{c}"), F.col(c))).otherwise(F.col(c)).alias(c) if c in cols else F.col(c)
        for c in df.columns])


def with_parameters(df: DataFrame, parameters: dict[str, T.DataType | str], defaults: dict | None = None) -> DataFrame:
    """One run per row: parameters from its columns, then from defaults; a missing required one is an error."""
    defaults = defaults or {}
    out = df
    for name, kind in parameters.items():
        if name in df.columns:
            given = F.col(name).cast(kind)
            rest = F.lit(defaults[name]).cast(kind) if name in defaults else F.raise_error(F.lit(f"MissingParameter: {name}")).cast(kind)
            out = out.withColumn(name, F.coalesce(given, rest))
        elif name in defaults:
            out = out.withColumn(name, F.lit(defaults[name]).cast(kind))
        else:
            raise MissingParameter(name)
    return out
