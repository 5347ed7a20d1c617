"""The cube: a DataFrame with one row per cell, and its schema."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .operators.aggregate import AggregateOps
from .operators.apply import ApplyOps
from .operators.bands import BandOps
from .operators.dims import DimOps
from .operators.filters import FilterOps
from .operators.focal import FocalOps
from .operators.learn import LearnOps
from .operators.merge import MergeOps
from .operators.polygonize import PolygonizeOps
from .operators.resample import ResampleOps
from .operators.udf import UdfOps
from .schema import Band, CubeSchema, Dim


class Cube(DimOps, FilterOps, ApplyOps, AggregateOps, MergeOps, ResampleOps, FocalOps, BandOps, LearnOps, UdfOps, PolygonizeOps):
    """Operators return a new cube with a longer lazy plan; nothing runs before an action."""

    @classmethod
    def of(cls, df: DataFrame, spatial=("x", "y"), temporal=("t",), other=(), bands: list[Band | str] | None = None,
           band_dim: str | None = "bands", step: float | tuple[float, float] | None = 1.0, crs: int | None = None,
           collection_id: str | None = None) -> "Cube":
        """A cube over a DataFrame: name the key columns, the rest are bands.

        NaN values become null here, so that every later operator has one kind of no-data.
        """
        steps = step if isinstance(step, tuple) else (step,) * len(spatial)
        dims = [Dim(d, "spatial", s, crs) for d, s in zip(spatial, (*steps, *[None] * len(spatial)))]
        dims += [Dim(d, "temporal") for d in temporal]
        dims += [Dim(d, "bands" if d == "bands" else "other") for d in other]
        names = {d.name for d in dims}
        found = [b if isinstance(b, Band) else Band(b) for b in (bands or [c for c in df.columns if c not in names])]
        schema = CubeSchema(tuple(dims), tuple(found), band_dim if len(found) != 1 or bands else None, collection_id)
        if schema.band_dim and schema.band_dim in names:
            schema = replace(schema, band_dim=None)
        floats = {b.name: F.nanvl(F.col(b.name), F.lit(None).cast("double")) for b in found
                  if isinstance(df.schema[b.name].dataType, (T.DoubleType, T.FloatType))}
        df = df.withColumns(floats) if floats else df
        return cls(df.select(*schema.dim_names, *schema.values), schema)

    @classmethod
    def empty(cls, spark) -> "Cube":
        """A cube with no dimensions and no data."""
        return cls(spark.createDataFrame([], T.StructType([])), CubeSchema((), (), None))

    def __repr__(self) -> str:
        return f"Cube(dims={self.schema.all_names}, values={self.schema.values})"
