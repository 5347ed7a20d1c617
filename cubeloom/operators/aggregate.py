"""Aggregation over calendar periods, intervals, windows and geometries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import errors as err
from ..functions import dates
from ..functions.logic import is_valid
from ..functions.reducers import resolve
from ..plans.grouping import group_reduce
from ..schema import Dim
from .base import CubeBase
from .geometry import pixel_hits


def _interval_literals(intervals, labels) -> list[tuple]:
    out = []
    for i, (start, stop) in enumerate(intervals):
        start, stop = dates.parse(start), dates.parse(stop)
        if start and stop and stop <= start:
            raise err.TemporalExtentEmpty(f"{start} .. {stop}")
        out.append((start, stop, labels[i] if labels is not None else start))
    found = [o[2] for o in out]
    if len(set(found)) != len(found):
        raise err.LabelExists("interval labels are not distinct; give labels")
    return out


class AggregateOps(CubeBase):
    def aggregate_temporal(self, intervals, reducer, labels: list | None = None, dimension: str | None = None,
                           complete: bool = True):
        """One value per left-closed interval; intervals may overlap, an empty one gives null."""
        schema = self.schema
        t = schema.only("temporal", dimension)
        if labels is not None and len(labels) != len(intervals):
            raise err.LabelsNotEnumerated("one label per interval")
        spans = _interval_literals(intervals, labels)
        low = dates.ntz(min((s[0] for s in spans if s[0]), default=None))

        def holds(s: tuple) -> Column:
            cond = F.lit(True)
            if s[0]:
                cond = cond & (F.col(t) >= dates.ntz(s[0]))
            if s[1]:
                cond = cond & (F.col(t) < dates.ntz(s[1]))
            return cond

        names = [dates.ntz(s[2]) if labels is None else F.lit(s[2]).cast("string") for s in spans]
        member = F.array_compact(F.array(*[F.when(holds(s), n) for s, n in zip(spans, names)]))
        keys = schema.others(t)
        rows = self.df
        if all(s[0] for s in spans):
            rows = rows.where(F.col(t) >= low)
        if all(s[1] for s in spans):
            rows = rows.where(F.col(t) < dates.ntz(max(s[1] for s in spans)))
        rows = rows.withColumn("__label", F.explode(member))
        out = group_reduce(rows, [*keys, "__label"], schema.values, reducer, t)
        if complete:
            spine = self.df.select(*keys).distinct().withColumn("__label", F.explode(F.array(*names)))
            out = _filled(spine, out, [*keys, "__label"], schema.values, reducer)
        return self._new(out.withColumnRenamed("__label", t))

    def aggregate_temporal_period(self, period: str, reducer, dimension: str | None = None, complete: bool = True):
        """One value per calendar period, with a label for every period of the source extent."""
        schema = self.schema
        t = schema.only("temporal", dimension)
        keys = schema.others(t)
        rows = self.df.withColumn("__start", dates.period_start(F.col(t), period))
        out = group_reduce(rows, [*keys, "__start"], schema.values, reducer, t)
        if complete:
            # the gaps of a series are those between its own periods and towards the ends of the cube
            ends = self._scalars(low=F.min(t), high=F.max(t))
            series = Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__start")
            out = out.withColumns({"__low": ends["low"], "__high": ends["high"]})
            out = out.withColumns({"__before": F.lag("__start").over(series), "__next": F.lead("__start").over(series)})
            start, coming = F.col("__start"), F.col("__next")
            first = F.when(F.col("__before").isNull(), dates.period_start(F.col("__low"), period)).otherwise(start)
            last = F.coalesce(coming, dates.period_start(F.col("__high"), period))
            out = out.withColumn("__at", F.explode(F.filter(
                dates.period_spine(first, last, period), lambda p: coming.isNull() | (p < coming))))
            empty = F.lit(0).cast("long") if resolve(reducer).name == "count" else F.lit(None)
            out = out.select(*keys, F.col("__at").alias("__start"), *[
                F.when(F.col("__at") == start, F.col(v)).otherwise(empty).alias(v) for v in schema.values])
        label = dates.period_label(F.col("__start"), period)
        return self._new(out.withColumn(t, label))

    def aggregate_spatial(self, geometries, reducer, target_dimension: str | None = None):
        """Zonal statistics: one value per geometry and other label; pixels may count for many geometries.

        Geometries without pixels stay, without values. With ``target_dimension`` the
        labels ``value``, ``total_count`` and ``valid_count`` are added; cells without a
        row are not counted.
        """
        schema = self.schema
        x, y = schema.xy
        if target_dimension and schema.has(target_dimension):
            raise err.TargetDimensionExists(target_dimension)
        keys = ["geom_id", *schema.others(x, y)]
        counts = [F.count(F.lit(1)).alias("__total")] + [
            F.count_if(is_valid(F.col(v))).alias(f"__valid_{v}") for v in schema.values]
        out = group_reduce(pixel_hits(self, geometries), keys, schema.values, reducer,
                           schema.dim_names[-1], extra=counts if target_dimension else ())
        out = geometries.df.select("geom_id").join(out, "geom_id", "left")
        from .vector import VectorCube

        rest = schema.without(x, y)
        result = zonal_schema(rest)
        if not target_dimension:
            return VectorCube(out.select(*result.dim_names, *schema.values), result, geometries)
        entries = [F.struct(F.lit("value").alias("l"), *[F.col(v).cast("double").alias(v) for v in schema.values]),
                   F.struct(F.lit("total_count").alias("l"), *[F.col("__total").cast("double").alias(v) for v in schema.values]),
                   F.struct(F.lit("valid_count").alias("l"), *[F.col(f"__valid_{v}").cast("double").alias(v) for v in schema.values])]
        out = out.select(*result.dim_names, F.explode(F.array(*entries)).alias("__e")).select(
            *result.dim_names, F.col("__e.l").alias(target_dimension), *[F.col("__e")[v].alias(v) for v in schema.values])
        return VectorCube(out, result.with_dim(Dim(target_dimension)), geometries)

    def aggregate_spatial_window(self, reducer, size: tuple[int, int], boundary: str = "pad", align: str = "upper-left"):
        """Non-overlapping windows of pixels; labels are the window centres."""
        if boundary not in ("pad", "trim") or align not in ("upper-left", "upper-right", "lower-left", "lower-right"):
            raise ValueError(f"boundary {boundary!r}, align {align!r}")
        schema = self.schema
        x, y = schema.xy
        ends = self._scalars(x0=F.min(x), x1=F.max(x), y0=F.min(y), y1=F.max(y))
        df = self.df
        plan = {}
        for name, n, low, high, from_high in (
            (x, size[0], ends["x0"], ends["x1"], align.endswith("right")),
            (y, size[1], ends["y0"], ends["y1"], align.startswith("upper")),
        ):
            step = schema.dim(name).step or 1.0
            anchor, sign = (high, -1) if from_high else (low, 1)
            index = F.round((F.col(name) - anchor) * sign / step)
            if boundary == "trim":
                full = F.floor((F.round((high - low) / step) + 1) / n) * n
                df = df.where(index < full)
            centre = anchor + sign * step * (F.floor(index / n) * n + (n - 1) / 2)
            plan[name] = centre.cast("double")
        df = df.withColumns({f"__w_{k}": c for k, c in plan.items()}).drop(x, y)
        df = df.withColumnRenamed(f"__w_{x}", x).withColumnRenamed(f"__w_{y}", y)
        return self._new(group_reduce(df, schema.dim_names, schema.values, reducer))

    # zonal time series shortcuts

    def polygonal_mean_timeseries(self, polygon):
        return self.aggregate_spatial(polygon, "mean")

    def polygonal_median_timeseries(self, polygon):
        return self.aggregate_spatial(polygon, "median")

    def polygonal_standarddeviation_timeseries(self, polygon):
        return self.aggregate_spatial(polygon, "sd")

    def polygonal_histogram_timeseries(self, polygon) -> DataFrame:
        """How often each value occurs per geometry, other labels and band, in long form."""
        long = self.to_values()
        x, y = long.schema.xy
        keys = ["geom_id", *long.schema.others(x, y), "value"]
        return pixel_hits(long, polygon).where(F.col("value").isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))

    # climatology

    def climatological_normal(self, period: str, climatology_period: tuple[int, int] = (1981, 2010)):
        """Mean per recurring period over a closed range of years.

        A season that starts the year before the range counts only if all its months are
        there; one that runs past the range never counts.
        """
        schema = self.schema
        t = schema.only("temporal")
        first, last = (int(str(y)[:4]) for y in climatology_period)
        year, month = F.year(t), F.month(t)
        if period == "climatology-period":
            part = F.lit("climatology-period")
        elif period in ("day", "month", "season", "tropical-season"):
            part = dates.period_part(F.col(t), period)
        else:
            raise ValueError(f"no climatology per {period!r}")
        early = {"season": [12], "tropical-season": [11, 12]}.get(period, [])
        season_year = year + F.when(month.isin(early), 1).otherwise(0) if early else year
        # plain bounds on the time reach the scan; the exact test follows
        span = (F.col(t) >= dates.ntz(dates.parse(f"{first - 1}-11-01" if early else f"{first}-01-01"))) & (F.col(t) < dates.ntz(dates.parse(f"{last + 1}-01-01")))
        df = self.df.where(span & season_year.between(first, last))
        if early:
            have = self.df.where(span & (year == first - 1) & month.isin(early)).agg(F.count_distinct(month).alias("n"))
            wraps = (season_year == first) & part.isin("djf", "ndjfma") & month.isin(*early, 1, 2, 3, 4)
            df = df.where(~wraps | (have.scalar() == len(early)))
        rows = df.withColumn("__part", part).drop(t).withColumnRenamed("__part", t)
        return self._new(group_reduce(rows, schema.dim_names, schema.values, "mean"))

    def anomaly(self, normals, period: str):
        """Data with period labels minus the normal of the same part of the year."""
        schema = self.schema
        t = schema.only("temporal")
        keys = schema.others(t)
        if period in ("single-period", "climatology-period"):
            on = keys
            left = self.df
        else:
            on = [*keys, "__part"]
            whole = period in ("year", "decade", "decade-ad")
            part = F.col(t) if whole else F.substring_index(F.col(t), "-", -1)
            left = self.df.withColumn("__part", part)
        right = normals.df.select(
            *keys, *([F.col(normals.schema.only("temporal")).alias("__part")] if "__part" in on else []),
            *[F.col(v).alias(f"__n_{v}") for v in schema.values])
        df = left.join(right, on, "left")
        return self._new(df.withColumns({v: F.col(v) - F.col(f"__n_{v}") for v in schema.values}))


def zonal_schema(rest):
    """Schema of a zonal result: the geometry dimension first."""
    return replace(rest, dims=(Dim("geom_id", "geometry"), *rest.dims))


def _filled(spine: DataFrame, out: DataFrame, on: list[str], values: list[str], reducer) -> DataFrame:
    """Left join to the complete labels; counts of an empty group are 0, not null."""
    df = spine.join(out, on, "left")
    if resolve(reducer).name == "count":
        df = df.withColumns({v: F.coalesce(F.col(v), F.lit(0).cast("long")) for v in values})
    return df
