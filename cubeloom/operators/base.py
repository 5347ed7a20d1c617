"""What all operator groups share: a DataFrame and its cube schema."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CubeSchema


class CubeBase:
    def __init__(self, df: DataFrame, schema: CubeSchema):
        self.df = df
        self.schema = schema

    def _new(self, df: DataFrame, schema: CubeSchema | None = None):
        schema = schema or self.schema
        return type(self)(df.select(*schema.dim_names, *schema.values), schema)

    @property
    def spark(self):
        return self.df.sparkSession

    def _map_values(self, fn) -> DataFrame:
        return self.df.withColumns({v: fn(F.col(v)) for v in self.schema.values})

    def _between(self, name: str, low, high) -> Column:
        """Range test in the type of the column, so that it reaches the scan.

        A cast of a whole-number column would keep the filter out of Parquet.
        """
        c = F.col(name)
        if isinstance(self.df.schema[name].dataType, T.IntegralType):
            low = F.ceil(low).cast("long") if isinstance(low, Column) else math.ceil(low)
            high = F.floor(high).cast("long") if isinstance(high, Column) else math.floor(high)
        return (c >= low) & (c <= high)

    def _scalars(self, **aggregates: Column) -> dict[str, Column]:
        """Whole-cube aggregates as scalar subqueries, so nothing visits the driver."""
        row = self.df.agg(F.struct(*[c.alias(n) for n, c in aggregates.items()]).alias("s"))
        return {n: row.scalar()[n] for n in aggregates}
