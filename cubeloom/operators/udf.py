"""User functions on pixel series, blocks and zones.

A user hands over Python functions, never source text. Spark groups the rows; the function
sees pandas frames or numpy arrays of one group inside a task.
"""

from __future__ import annotations

import inspect
from dataclasses import replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import errors as err
from ..schema import CubeSchema
from .base import CubeBase

USER_FUNCTIONS = ("apply_timeseries", "apply_datacube", "apply_vectorcube")


def call_on_group(fn, context: dict | None, keep: str | None = None):
    """Wrap a pandas function for ``applyInPandas``; with ``keep`` only the flagged rows remain."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = fn(pdf, context or {})
        return out[out[keep].astype(bool)].drop(columns=[keep]) if keep and keep in out else out

    return run


def _series_group(pdf: pd.DataFrame, fn, t: str, values: list[str], context: dict) -> pd.DataFrame:
    pdf = pdf.sort_values(t)
    for v in values:
        series = pd.Series(pdf[v].to_numpy(dtype=float), index=pd.DatetimeIndex(pdf[t]))
        out = fn(series, context)
        if len(out) != len(pdf):
            raise ValueError("a time series function must keep the length")
        pdf[v] = np.asarray(out, dtype=float)
    return pdf


def _block_group(pdf: pd.DataFrame, fn, dims: list[str], values: list[str], context: dict, out_values: list[str]) -> pd.DataFrame:
    """Pivot a block to an array of dims (t, bands, y, x), call the function, unpivot."""
    axes = [d for d in dims if d is not None]
    labels = {d: np.sort(pdf[d].unique()) for d in axes}
    where = tuple(np.searchsorted(labels[d], pdf[d].to_numpy()) for d in axes)
    array = np.full([len(values), *[len(labels[d]) for d in axes]], np.nan)
    for k, v in enumerate(values):
        array[(k, *where)] = pdf[v].to_numpy(dtype=float)
    array = np.moveaxis(array, 0, 1)  # t, bands, y, x
    out = np.moveaxis(np.asarray(fn(array, context)), 1, 0)
    if out.shape[0] != len(out_values) or out.shape[1:] != tuple(len(labels[d]) for d in axes):
        raise ValueError(f"unexpected result shape {out.shape}")
    frame = pdf[axes].copy()
    for k, v in enumerate(out_values):
        frame[v] = out[(k, *where)]
    return frame


class UdfOps(CubeBase):
    def run_udf(self, udf, context: dict | None = None, size: dict | None = None):
        """Run user functions, found by name: a function, a dict or a module of them.

        ``apply_metadata`` (schema, context) may state the schema of the result.
        """
        found = _find(udf)
        metadata = found.get("apply_metadata")
        for name in USER_FUNCTIONS:
            if name in found:
                break
        else:
            raise err.NoUserFunction(f"none of {USER_FUNCTIONS}")
        schema = metadata(self.schema, context or {}) if metadata else self.schema
        if name == "apply_timeseries":
            return self.apply_timeseries(found[name], context)
        if name == "apply_datacube":
            return self.apply_datacube(found[name], size or {}, context, schema)
        raise err.NoUserFunction("apply_vectorcube runs on zonal results: use apply_vectorcube(...)")

    def _row_type(self, schema: CubeSchema, dims: list[str]) -> T.StructType:
        fields = [self.df.schema[d] for d in dims]
        return T.StructType([*fields, *[T.StructField(v, T.DoubleType()) for v in schema.values]])

    def apply_timeseries(self, fn, context: dict | None = None, dimension: str | None = None):
        """Series to series of the same length, per pixel and band.

        The function needs the whole series, so its length is bounded by the number of
        labels of the time dimension.
        """
        schema = self.schema
        t = schema.only("temporal", dimension)
        values, ctx = schema.values, context or {}

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            return _series_group(pdf, fn, t, values, ctx)

        row = self._row_type(schema, schema.dim_names)
        out = self.df.select(*schema.dim_names, *schema.values).groupBy(*schema.others(t)).applyInPandas(run, row)
        return self._new(out)

    def apply_datacube(self, fn, size: dict | None = None, context: dict | None = None, schema: CubeSchema | None = None):
        """Array block to array block; blocks have dims t, bands, y, x and ``size`` pixels in x and y."""
        mine = self.schema
        schema = schema or mine
        x, y = mine.xy
        t = mine.only("temporal")
        size = {x: 64, y: 64, **(size or {})}
        df = self.df.withColumns({
            f"__b{d}": F.floor(F.col(d) / (size[d] * (mine.dim(d).step or 1.0))) for d in (x, y)})
        rest = [d for d in mine.dim_names if d not in (t, y, x)]
        values, out_values, ctx = mine.values, schema.values, context or {}

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            return _block_with_rest(pdf, fn, [t, y, x], rest, values, ctx, out_values)

        row = self._row_type(schema, [*rest, t, y, x])
        out = df.groupBy(f"__b{x}", f"__b{y}", *rest).applyInPandas(run, row)
        return self._new(out, schema)

    def reduce_bands_udf(self, fn, name: str = "value"):
        """User reducer along the bands: a function of one pandas Series per band, Arrow batches."""
        values = self.schema.values
        udf = F.pandas_udf(_typed_map(fn), "double")
        df = self.df.withColumn(name, udf(*[F.col(v).cast("double") for v in values]))
        return self._new(df, self.schema.single(name))

    def reduce_temporal_udf(self, fn):
        """User reducer along time: pandas Series to scalar, per pixel and band."""
        t = self.schema.only("temporal")
        udf = F.pandas_udf(_typed_reducer(fn), "double")
        out = self.df.groupBy(*self.schema.others(t)).agg(
            *[udf(F.col(v).cast("double")).alias(v) for v in self.schema.values])
        return self._new(out, self.schema.without(t))


def _typed_map(fn):
    def combine(*bands: pd.Series) -> pd.Series:
        return fn(*bands)

    return combine


def _typed_reducer(fn):
    def reduce(v: pd.Series) -> float:
        return float(fn(v))

    return reduce


def _block_with_rest(pdf, fn, dims, rest, values, context, out_values):
    frame = _block_group(pdf, fn, dims, values, context, out_values)
    for r in rest:
        frame[r] = pdf[r].iloc[0]
    return frame[[*rest, *dims, *out_values]]


def _find(udf) -> dict:
    if isinstance(udf, dict):
        return udf
    if inspect.ismodule(udf):
        return {n: f for n, f in inspect.getmembers(udf, inspect.isfunction)}
    if callable(udf):
        return {getattr(udf, "__name__", ""): udf}
    raise err.NoUserFunction(repr(udf))


def apply_vectorcube(zonal, fn, schema, batch: int = 64, context: dict | None = None) -> DataFrame:
    """User function on (geometries, values), both pandas frames, per batch of geometries."""
    geoms = zonal.geometries.df.select("geom_id", "geom_type", "minx", "miny", "maxx", "maxy", *zonal.geometries.properties)
    geoms = geoms.toDF(*geoms.columns)  # new column identities: both sides stem from one table
    values = zonal.df.withColumn("__batch", F.floor(F.col("geom_id") / batch))
    geoms = geoms.withColumn("__batch", F.floor(F.col("geom_id") / batch))
    ctx = context or {}

    def run(g: pd.DataFrame, v: pd.DataFrame) -> pd.DataFrame:
        _, out = fn(g.drop(columns="__batch"), v.drop(columns="__batch"), ctx)
        return out

    return geoms.groupBy("__batch").cogroup(values.groupBy("__batch")).applyInPandas(run, schema)


class Processes:
    """User-defined processes: named, parameterised functions from cube to cube."""

    def __init__(self):
        self._saved: dict[str, tuple] = {}

    def save(self, name: str, fn, defaults: dict | None = None, summary: str | None = None):
        self._saved[name] = (fn, dict(defaults or {}), summary)
        return fn

    def names(self) -> list[str]:
        return sorted(self._saved)

    def run(self, name: str, cube, **params):
        fn, defaults, _ = self._saved[name]
        known = inspect.signature(fn).parameters
        merged = {**defaults, **params}
        missing = [n for n, p in list(known.items())[1:] if p.default is p.empty and n not in merged]
        if missing:
            raise err.MissingParameter(f"{name}: {missing}")
        return fn(cube, **merged)


processes = Processes()


def inspect_cube(cube, message: str = "", code: str = "User", level: str = "info"):
    """Pass the data on unchanged and observe row count and value range on the way.

    Returns the cube and an Observation; read it after an action.
    """
    from pyspark.sql import Observation

    seen = Observation(f"{level}-{code}")
    exprs = [F.lit(message).alias("message"), F.count(F.lit(1)).alias("rows")]
    for v in cube.schema.values:
        exprs += [F.min(v).alias(f"min_{v}"), F.max(v).alias(f"max_{v}")]
    return type(cube)(cube.df.observe(seen, *exprs), replace(cube.schema)), seen
