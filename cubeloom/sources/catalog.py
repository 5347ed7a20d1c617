"""Named collections and earlier results."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cube import Cube
from ..functions import dates
from ..schema import Band

Loader = Callable[[SparkSession], DataFrame]


@dataclass(frozen=True)
class Collection:
    """Where a collection lies and how its columns form a cube.

    ``source`` is a Parquet path or a function that gives a DataFrame. ``properties`` are
    scene columns that can be filtered on and are dropped from the cube.
    """

    source: str | Loader
    spatial: tuple[str, ...] = ("x", "y")
    temporal: tuple[str, ...] = ("t",)
    other: tuple[str, ...] = ()
    bands: tuple[Band | str, ...] = ()
    properties: tuple[str, ...] = ()
    band_dim: str | None = "bands"
    step: float | tuple[float, float] = 1.0
    crs: int | None = None
    id: str | None = field(default=None)


class Catalog:
    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._entries: dict[str, Collection] = {}

    def register(self, name: str, collection: Collection) -> "Catalog":
        self._entries[name] = collection
        return self

    def names(self) -> list[str]:
        return sorted(self._entries)

    def load_collection(self, id: str, spatial_extent=None, temporal_extent=None, bands: list[str] | None = None,
                        properties: list[Column] | None = None, max_cloud_cover: float | None = None) -> Cube:
        """A collection with its restrictions as plain filters, which reach the scan.

        ``properties`` are conditions on scene columns, all of which must hold.
        """
        entry = self._entries[id]
        df = self.spark.read.parquet(entry.source) if isinstance(entry.source, str) else entry.source(self.spark)
        for condition in properties or []:
            df = df.where(condition)
        if max_cloud_cover is not None:
            df = df.where(F.col("cloud_cover") <= max_cloud_cover)
        keys = [*entry.spatial, *entry.temporal, *entry.other]
        df = df.drop(*[p for p in entry.properties if p not in keys])
        cube = Cube.of(df, entry.spatial, entry.temporal, entry.other, list(entry.bands) or None, entry.band_dim,
                       entry.step, entry.crs, entry.id or id)
        return restrict(cube, spatial_extent, temporal_extent, bands)

    def load_result(self, path: str, like: str, spatial_extent=None, temporal_extent=None, bands=None) -> Cube:
        """A result written earlier, read with the layout of a registered collection."""
        entry = self._entries[like]
        df = self.spark.read.parquet(path)
        if "month" in df.columns and temporal_extent is not None:
            # written by month: the extent also picks the folders
            start, end = dates.extent(*temporal_extent) if isinstance(temporal_extent, (list, tuple)) else dates.extent(temporal_extent)
            if start:
                df = df.where(F.col("month") >= start.strftime("%Y-%m"))
            if end:
                df = df.where(F.col("month") <= end.strftime("%Y-%m"))
        cube = Cube.of(df, entry.spatial, entry.temporal, entry.other, list(entry.bands) or None, entry.band_dim,
                       entry.step, entry.crs, entry.id or like)
        return restrict(cube, spatial_extent, temporal_extent, bands)


def restrict(cube: Cube, spatial_extent=None, temporal_extent=None, bands=None) -> Cube:
    """The extents and bands all loaders share."""
    if spatial_extent is not None:
        from ..operators.vector import Geometries

        cube = cube.filter_spatial(spatial_extent) if isinstance(spatial_extent, Geometries) else cube.filter_bbox(spatial_extent)
    if temporal_extent is not None:
        start, end = temporal_extent if isinstance(temporal_extent, (list, tuple)) else (temporal_extent, None)
        cube = cube.filter_temporal((start, end)) if isinstance(temporal_extent, (list, tuple)) else cube.filter_temporal(start)
    return cube.filter_bands(bands) if bands else cube
