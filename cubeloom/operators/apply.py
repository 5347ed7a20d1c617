"""Cell-wise work, work along a dimension, and reduction of a dimension."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from .. import errors as err
from ..functions.reducers import resolve
from ..plans import scan as sc
from ..plans.grouping import group_reduce
from ..schema import Dim
from .base import CubeBase

CUMULATIVE = {
    "cumsum": sc.running_sum, "cumproduct": sc.running_product,
    "cummax": sc.running_max, "cummin": sc.running_min,
}


class ApplyOps(CubeBase):
    def apply(self, process):
        """Map a function of one Column over every value."""
        return self._new(self._map_values(process))

    # -- along a dimension ---------------------------------------------------------

    def apply_dimension(self, process, dimension: str, target_dimension: str | None = None):
        """Map an array to an array along a dimension.

        The named order functions (``cumsum`` and the like, ``array_interpolate_linear``)
        run as range-wise scans. A function of an array Column gets each series as one
        array, so the number of labels of the dimension bounds the array.
        """
        schema = self.schema
        if dimension == schema.band_dim:
            return self._apply_bands(process, target_dimension)
        schema.dim(dimension)
        if isinstance(process, str):
            if target_dimension:
                raise err.DimensionMismatch("order functions keep their dimension")
            if process in CUMULATIVE:
                return self.cumulate(process, dimension)
            if process == "array_interpolate_linear":
                return self.interpolate_linear(dimension)
            raise ValueError(f"unknown process {process!r}")
        keys = schema.others(dimension)
        merged = target_dimension if target_dimension in keys else None
        if merged:
            keys = [k for k in keys if k != merged]
        entry = F.struct(F.col(dimension).alias("d"), *[F.col(v).alias(f"v{i}") for i, v in enumerate(schema.values)])
        grouped = self.df.groupBy(*keys).agg(F.array_sort(F.collect_list(entry)).alias("__s"))
        outs = [process(F.col("__s")[f"v{i}"]) for i in range(len(schema.values))]
        grouped = grouped.withColumns({f"__o{i}": o for i, o in enumerate(outs)})
        zipped = F.arrays_zip(*[F.col(f"__o{i}").alias(f"v{i}") for i in range(len(outs))])
        rows = grouped.select(*keys, "__s", F.posexplode(zipped).alias("__i", "__e"))
        values = [F.col("__e")[f"v{i}"].alias(v) for i, v in enumerate(schema.values)]
        if target_dimension is None:
            same = F.when(F.col("__i") < F.size("__s"), F.get("__s", F.col("__i"))["d"])
            label = F.coalesce(same, F.raise_error(F.lit("length changed: name a target dimension"))).alias(dimension)
            return self._new(rows.select(*keys, label, *values))
        rest = schema.without(dimension, *([merged] if merged else []))
        kind = schema.dim(merged).type if merged else "other"
        return self._new(rows.select(*keys, F.col("__i").alias(target_dimension), *values),
                         rest.with_dim(Dim(target_dimension, kind)))

    def _apply_bands(self, process, target_dimension: str | None):
        """Row-wise: the bands of a cell are the array. The result length must be stated by the process."""
        schema = self.schema
        data = F.array(*[F.col(v).cast("double") for v in schema.values])
        out = process(data) if callable(process) else process
        if isinstance(out, (list, tuple)):
            names = schema.values if len(out) == len(schema.values) else [str(i) for i in range(len(out))]
            return self._new(self.df.select(*schema.dim_names, *[c.alias(n) for c, n in zip(out, names)]),
                             schema.with_bands(names, target_dimension or schema.band_dim))
        df = self.df.withColumn("__a", out)
        if target_dimension:
            df = df.select(*schema.dim_names, F.posexplode("__a").alias(target_dimension, "value"))
            return self._new(df, schema.single().with_dim(Dim(target_dimension)))
        return self._new(df.select(*schema.dim_names, *[F.get("__a", F.lit(i)).alias(v) for i, v in enumerate(schema.values)]))

    def cumulate(self, how: str, dimension: str, ignore_nodata: bool = True):
        """Running sum, product, maximum or minimum along a dimension."""
        schema = self.schema
        runs = {}
        for v in schema.values:
            runs[f"__run_{v}"] = CUMULATIVE[how](F.col(v).cast("double"))
            if not ignore_nodata:
                runs[f"__nul_{v}"] = sc.running_sum(F.col(v).isNull().cast("long"))
        df = sc.scan(self.df, schema.others(dimension), dimension, runs)

        def shown(v: str) -> Column:
            good = F.col(v).isNotNull()
            return F.when(good if ignore_nodata else good & (F.col(f"__nul_{v}") == 0), F.col(f"__run_{v}"))

        return self._new(df.withColumns({v: shown(v) for v in schema.values}))

    def _neighbours(self, at: Column | None) -> dict[str, sc.Running]:
        """The valid neighbours of every value on both sides, met at the given labels or at their positions."""
        runs = {}
        for v in self.schema.values:
            runs[f"__l_{v}"] = sc.last_known(F.col(v).cast("double"), at)
            runs[f"__r_{v}"] = sc.next_known(F.col(v).cast("double"), at)
        return runs

    def _on_the_line(self, at: Column) -> dict[str, Column]:
        def filled(v: str) -> Column:
            l, r = F.col(f"__l_{v}"), F.col(f"__r_{v}")
            return F.coalesce(F.col(v).cast("double"),
                              l["v"] + (r["v"] - l["v"]) * F.try_divide(at - l["o"], r["o"] - l["o"]))

        return {v: filled(v) for v in self.schema.values}

    def interpolate_linear(self, dimension: str, by: str = "position"):
        """Fill inner gaps on the line between the valid neighbours, by position or by label; one scan either way."""
        keys = self.schema.others(dimension)
        if by == "position":
            df = sc.with_position(self.df, keys, dimension, more=self._neighbours(None))
            return self._new(df.withColumns(self._on_the_line((F.col("__pos") + 1).cast("double"))))
        at = sc.order_key(self.df, dimension).cast("double")
        df = sc.scan(self.df, keys, dimension, self._neighbours(at))
        return self._new(df.withColumns(self._on_the_line(at)))

    def smooth_savitzky_golay(self, dimension: str, window: int = 5, degree: int = 2, fill: bool = True):
        """Savitzky-Golay smoothing of each series, edges by the polynomial of the end window.

        Gaps are interpolated by label first, in the same range-wise scan that gives the
        positions. Blocks of positions, each with the few rows it needs from its neighbours, are then
        smoothed. The weights are fixed. A series shorter than the window stays as it is.
        """
        if window % 2 == 0 or degree >= window:
            raise ValueError("the window must be odd and larger than the degree")
        schema = self.schema
        keys = schema.others(dimension)
        at = sc.order_key(self.df, dimension).cast("double")
        df = sc.with_position(self.df, keys, dimension, total="__len", more=self._neighbours(at) if fill else None)
        if fill:
            df = df.withColumns(self._on_the_line(at)).drop(*self._neighbours(at))
        block, reach, half = 4096, window - 1, window // 2
        own = F.floor(F.col("__pos") / block)
        near = F.array_distinct(F.array(
            own, F.floor(F.greatest(F.col("__pos") - reach, F.lit(0)) / block), F.floor((F.col("__pos") + reach) / block)))
        spread = df.withColumns({"__own": own, "__block": F.explode(near)})
        w = Window.partitionBy(*keys, "__block").orderBy("__pos")
        design = np.vander(np.arange(window), degree + 1, increasing=True)
        hat = design @ np.linalg.pinv(design)  # row i: weights that give the fit at place i of a window

        def at_place(v: str, place: int) -> Column:
            total = F.lit(0.0)
            for j in range(window):
                shift = j - place
                value = F.lag(v, -shift).over(w) if shift < 0 else F.lead(v, shift).over(w) if shift else F.col(v)
                total = total + float(hat[place, j]) * value
            return total

        def smoothed(v: str) -> Column:
            pos, n = F.col("__pos"), F.col("__len")
            out = F.when(n < window, F.col(v))
            for k in range(half):
                out = out.when(pos == k, at_place(v, k)).when(pos == n - 1 - k, at_place(v, window - 1 - k))
            return out.otherwise(at_place(v, half))

        df = spread.withColumns({f"__o_{v}": smoothed(v) for v in schema.values})
        df = df.where(F.col("__own") == F.col("__block"))
        return self._new(df.withColumns({v: F.col(f"__o_{v}") for v in schema.values}))

    # -- reduction -----------------------------------------------------------------

    def reduce_dimension(self, reducer, dimension: str):
        """Array to scalar over one dimension, which is removed."""
        schema = self.schema
        if dimension == schema.band_dim:
            data = F.array(*[F.col(v).cast("double") for v in schema.values])
            return self._new(self.df.withColumn("value", resolve(reducer).arr(data)), schema.single())
        keys = schema.others(dimension)
        return self._new(group_reduce(self.df, keys, schema.values, reducer, dimension), schema.without(dimension))

    def reduce_bands(self, reducer):
        if not self.schema.band_dim:
            raise err.DimensionNotAvailable("no band dimension")
        return self.reduce_dimension(reducer, self.schema.band_dim)

    def reduce_temporal(self, reducer):
        return self.reduce_dimension(reducer, self.schema.only("temporal"))

    def reduce_spatial(self, reducer):
        """Reduce over x and y together."""
        schema = self.schema
        x, y = schema.xy
        keys = schema.others(x, y)
        return self._new(group_reduce(self.df, keys, schema.values, reducer), schema.without(x, y))

    def min_time(self):
        return self.reduce_temporal("min")

    def max_time(self):
        return self.reduce_temporal("max")

    def mean_time(self):
        return self.reduce_temporal("mean")

    def median_time(self):
        return self.reduce_temporal("median")

    def count_time(self):
        return self.reduce_temporal("count")
