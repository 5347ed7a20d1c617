"""Dimension and label operators, the schema system at run time."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import errors as err
from ..functions.math import convert
from ..schema import CONSTANT, Band, Dim
from .base import CubeBase


class DimOps(CubeBase):
    def add_dimension(self, name: str, label, type: str = "other"):
        """Add a dimension that has one label."""
        schema = self.schema
        if schema.has(name):
            raise err.DimensionExists(name)
        if type == "bands":
            if schema.band_dim:
                raise err.DimensionExists(schema.band_dim)
            renamed = self.df.withColumnRenamed(schema.values[0], label)
            return self._new(renamed, schema.with_bands([label], name))
        value = F.lit(label).cast("timestamp_ntz") if type == "temporal" else F.lit(label)
        return self._new(self.df.withColumn(name, value.alias(name, metadata={CONSTANT: True})), schema.with_dim(Dim(name, type)))

    def drop_dimension(self, name: str):
        """Remove a dimension with at most one label; more labels fail when the plan runs."""
        schema = self.schema
        if name == schema.band_dim:
            if len(schema.bands) > 1:
                raise err.DimensionMismatch(f"{name} has {len(schema.bands)} labels")
            return self._new(self.df.withColumnRenamed(schema.values[0], "value"), schema.single())
        schema.dim(name)
        one = self._scalars(low=F.min(name), high=F.max(name))
        checked = F.when(
            one["low"].eqNullSafe(one["high"]), F.col(schema.values[0])
        ).otherwise(F.raise_error(F.lit(f"DimensionMismatch: {name} has more than one label")))
        return self._new(self.df.withColumn(schema.values[0], checked), schema.without(name))

    def rename_dimension(self, source: str, target: str):
        schema = self.schema
        if not schema.has(source):
            raise err.DimensionNotAvailable(source)
        if schema.has(target):
            raise err.DimensionExists(target)
        if source == schema.band_dim:
            return self._new(self.df, replace(schema, band_dim=target))
        dims = tuple(replace(d, name=target) if d.name == source else d for d in schema.dims)
        return self._new(self.df.withColumnRenamed(source, target), replace(schema, dims=dims))

    def rename_labels(self, dimension: str, target: list, source: list | None = None):
        """Rename labels; without source labels, the present ones must be 0..n-1."""
        schema = self.schema
        if dimension == schema.band_dim:
            source = list(source or [])
            if not source:
                if len(target) != len(schema.bands):
                    raise err.LabelsNotEnumerated("give one target per band")
                source = schema.values
            if len(source) != len(target):
                raise err.LabelsNotEnumerated("source and target differ in length")
            for s in source:
                if s not in schema.values:
                    raise err.LabelNotAvailable(s)
            kept = [v for v in schema.values if v not in source]
            if set(kept) & set(target) or len(set(target)) < len(target):
                raise err.LabelExists(str(target))
            names = dict(zip(source, target))
            bands = [replace(b, name=names[b.name]) if b.name in names else b for b in schema.bands]
            df = self.df.select(*schema.dim_names, *[F.col(v).alias(names.get(v, v)) for v in schema.values])
            return self._new(df, schema.with_bands(bands))
        schema.dim(dimension)
        label = F.col(dimension)
        if not source:
            found = F.when(label.between(0, len(target) - 1), F.get(F.array(*[F.lit(t) for t in target]), label.cast("int")))
            new = F.coalesce(found, F.raise_error(F.lit("LabelsNotEnumerated")))
        else:
            if len(source) != len(target):
                raise err.LabelsNotEnumerated("source and target differ in length")
            clash = [t for t in target if t not in source]
            new = F.when(label.isin(clash) if clash else F.lit(False), F.raise_error(F.lit("LabelExists")))
            for s, t in zip(source, target):
                new = new.when(label == F.lit(s), F.lit(t))
            present = self.df.agg(F.array_distinct(F.collect_set(F.when(label.isin(list(source)), label))).alias("p"))
            missing = F.size(present.scalar()) < len(source)
            new = F.when(missing, F.raise_error(F.lit("LabelNotAvailable"))).otherwise(new.otherwise(label))
        return self._new(self.df.withColumn(dimension, new), schema)

    def dimension_labels(self, dimension: str) -> DataFrame:
        """The labels of a dimension in cube order, one row each."""
        schema = self.schema
        if dimension == schema.band_dim:
            bands = F.array(*[F.lit(v) for v in schema.values])
            return self.df.limit(1).select(F.explode(bands).alias(dimension))
        schema.dim(dimension)
        return self.df.select(dimension).distinct().orderBy(dimension)

    def flatten_dimensions(self, dimensions: list[str], target_dimension: str, label_separator: str = "~"):
        """Combine dimensions into one whose labels are joined texts."""
        schema = self.schema
        for d in dimensions:
            if not schema.has(d):
                raise err.DimensionNotAvailable(d)
        if schema.has(target_dimension) and target_dimension not in dimensions:
            raise err.TargetDimensionExists(target_dimension)
        cube = self.to_long() if schema.band_dim in dimensions else self
        label = F.concat_ws(label_separator, *[F.col(d).cast("string") for d in dimensions])
        rest = cube.schema.without(*dimensions)
        df = cube.df.withColumn("__flat", label).drop(*dimensions).withColumnRenamed("__flat", target_dimension)
        return self._new(df, rest.with_dim(Dim(target_dimension)))

    def unflatten_dimension(self, dimension: str, target_dimensions: list[str], label_separator: str = "~"):
        """Split the labels of one dimension into several dimensions."""
        schema = self.schema
        schema.dim(dimension)
        rest = schema.without(dimension)
        for t in target_dimensions:
            if rest.has(t):
                raise err.TargetDimensionExists(t)
        parts = F.split(F.col(dimension), "\\Q" + label_separator + "\\E", -1)
        good = F.when(F.size(parts) == len(target_dimensions), parts).otherwise(
            F.raise_error(F.lit(f"{dimension}: labels do not split into {len(target_dimensions)} parts")))
        df = self.df.withColumn("__parts", good).drop(dimension)
        df = df.withColumns({t: F.col("__parts")[i] for i, t in enumerate(target_dimensions)})
        for t in target_dimensions:
            rest = rest.with_dim(Dim(t))
        return self._new(df, rest)

    def trim_cube(self):
        """Cut, at both ends of each dimension, the labels without any valid value."""
        schema = self.schema
        some = F.coalesce(*[F.col(v) for v in schema.values]).isNotNull()
        wanted = {}
        for i, d in enumerate(schema.dim_names):
            wanted[f"lo{i}"], wanted[f"hi{i}"] = F.min(F.when(some, F.col(d))), F.max(F.when(some, F.col(d)))
        ends = self._scalars(**wanted)
        df = self.df
        for i, d in enumerate(schema.dim_names):
            df = df.where(F.col(d).between(ends[f"lo{i}"], ends[f"hi{i}"]))
        return self._new(df)

    def filter_labels(self, condition, dimension: str):
        """Keep the labels for which a function of the label is true."""
        schema = self.schema
        if dimension == schema.band_dim:
            kept = [b for b in schema.bands if condition(b.name)]
            return self._new(self.df, schema.with_bands(kept))
        schema.dim(dimension)
        return self._new(self.df.where(condition(F.col(dimension))))

    def band(self, key):
        """One band; the band dimension is dropped."""
        name = self.schema.find_bands(key)[0]
        return self._new(self.df.withColumn("value", F.col(name)), self.schema.single())

    def filter_bands(self, bands: list | None = None, wavelengths: list | None = None):
        """Keep bands by name, common name or wavelength range, in the given order."""
        schema = self.schema
        if not bands and not wavelengths:
            raise err.BandNotFound("give bands or wavelengths")
        names: list[str] = []
        for key in [bands] if isinstance(bands, str) else bands or []:
            names += schema.find_bands(key)
        for low, high in wavelengths or []:
            names += [b.name for b in schema.bands if b.wavelength is not None and low <= b.wavelength <= high]
        by_name = {b.name: b for b in schema.bands}
        return self._new(self.df, schema.with_bands([by_name[n] for n in dict.fromkeys(names)]))

    def convert_data_type(self, data_type: str):
        return self._new(self._map_values(lambda c: convert(c, data_type)))

    def to_long(self, value: str = "value"):
        """Bands as labels of a key column: one row per cell and band."""
        schema = self.schema
        if not schema.band_dim:
            return self
        df = self.df.withColumns({v: F.col(v).cast("double") for v in schema.values}).unpivot(
            schema.dim_names, schema.values, schema.band_dim, value)
        return self._new(df, replace(schema, bands=(Band(value),), band_dim=None).with_dim(Dim(schema.band_dim, "bands")))

    def to_values(self):
        """The cube with its only value column named ``value``, bands as labels."""
        long = self.to_long()
        return long if long.schema.values == ["value"] else self._new(
            long.df.withColumnRenamed(long.schema.values[0], "value"), long.schema.single())

    def to_wide(self, dimension: str, labels: list[str]):
        """Labels of a key column as bands; the labels are named, so no extra pass finds them."""
        rest = self.schema.without(dimension)
        v = F.col(self.schema.values[0])
        df = self.df.groupBy(*rest.dim_names).agg(
            *[F.max(F.when(F.col(dimension) == label, v)).alias(label) for label in labels])
        return self._new(df, rest.with_bands(labels, dimension))


