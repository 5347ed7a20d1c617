"""STAC items as a table: query the items, then read the Parquet assets they name."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..cube import Cube
from ..functions import dates
from ..operators.filters import bbox_dict
from ..schema import Band
from .catalog import restrict

BAND = ("struct<name:string,common_name:string,center_wavelength:double,`eo:common_name`:string,`eo:center_wavelength`:double>")
ASSET = f"struct<href:string,type:string,roles:array<string>,bands:array<{BAND}>,`eo:bands`:array<{BAND}>>"
PROPERTIES = f"struct<datetime:string,start_datetime:string,end_datetime:string,`eo:cloud_cover`:double,platform:string,`eo:bands`:array<{BAND}>,bands:array<{BAND}>>"
ITEM_SCHEMA = (
    f"type string, id string, collection string, bbox array<double>, properties {PROPERTIES}, assets map<string,{ASSET}>, "
    f"bands array<{BAND}>, item_assets map<string,{ASSET}>, summaries struct<`eo:bands`:array<{BAND}>,bands:array<{BAND}>>"
)


def read_items(spark: SparkSession, path, multiline: bool = False) -> DataFrame:
    """STAC items or collections, one JSON object per line (or per file with ``multiline``)."""
    return spark.read.schema(ITEM_SCHEMA).option("multiLine", multiline).json(path)


def select_items(items: DataFrame, spatial_extent=None, temporal_extent=None, properties: list[Column] | None = None) -> DataFrame:
    """Items that touch the extents and meet all conditions on ``properties.*``."""
    rows = items
    if spatial_extent is not None:
        b = bbox_dict(spatial_extent)
        n = F.size("bbox")  # 4 numbers, or 6 with heights
        rows = rows.where((F.col("bbox")[0] <= b["east"]) & (F.get("bbox", (n / 2).cast("int")) >= b["west"])
                          & (F.col("bbox")[1] <= b["north"]) & (F.get("bbox", (n / 2).cast("int") + 1) >= b["south"]))
    if temporal_extent is not None:
        start, end = dates.extent(temporal_extent)
        first = dates.parse_rfc3339(F.coalesce("properties.start_datetime", "properties.datetime"))
        last = dates.parse_rfc3339(F.coalesce("properties.end_datetime", "properties.datetime"))
        if start:
            rows = rows.where(last >= dates.ntz(start))
        if end:
            rows = rows.where(first < dates.ntz(end))
    return reduce(lambda df, c: df.where(c), properties or [], rows)


def asset_paths(items: DataFrame) -> DataFrame:
    """The distinct hrefs of Parquet data assets."""
    a = items.select(F.explode(F.map_values("assets")).alias("a"))
    return a.where(F.coalesce(F.col("a.type").contains("parquet"), F.col("a.href").endswith(".parquet"))).select(
        F.col("a.href").alias("href")).distinct()


def load_stac(spark: SparkSession, path, spatial_extent=None, temporal_extent=None, bands=None,
              properties: list[Column] | None = None, multiline: bool = False, **layout) -> Cube:
    """A cube from the Parquet assets of the matching items.

    Only the list of asset paths, which Spark needs to plan the scan, visits the driver.
    """
    items = select_items(read_items(spark, path, multiline), spatial_extent, temporal_extent, properties)
    paths = [r.href for r in asset_paths(items).toLocalIterator()]
    if not paths:
        raise FileNotFoundError("no asset matches")
    return restrict(Cube.of(spark.read.parquet(*paths), **layout), spatial_extent, temporal_extent, bands)


def band_table(items: DataFrame) -> DataFrame:
    """Bands named in items or collections: one row per name, in order of first appearance."""
    def of(place: int, bands: Column) -> Column:
        return F.transform(F.coalesce(bands, F.array().cast(f"array<{BAND}>")), lambda b, i: F.struct(
            F.lit(place).alias("place"), i.alias("pos"), b["name"].alias("name"),
            F.coalesce(b["common_name"], b["eo:common_name"]).alias("common_name"),
            F.coalesce(b["center_wavelength"], b["eo:center_wavelength"]).alias("wavelength")))

    def assets(field: str) -> Column:
        empty = F.array().cast(f"array<{BAND}>")
        return F.coalesce(F.flatten(F.transform(F.map_values(field), lambda a: F.coalesce(a["bands"], a["eo:bands"], empty))), empty)

    found = F.concat(
        of(0, F.coalesce(F.col("summaries.bands"), F.col("summaries.`eo:bands`"))), of(1, F.col("bands")),
        of(2, F.coalesce(F.col("properties.bands"), F.col("properties.`eo:bands`"))), of(3, assets("item_assets")), of(4, assets("assets")))
    rows = items.select("id", F.explode(found).alias("b")).select(
        F.struct("b.place", "id", "b.pos").alias("o"), "b.name", "b.common_name", "b.wavelength").where("name is not null")
    # few names, many rows: an aggregate, not a window over each name
    first = rows.groupBy("name").agg(F.min("o").alias("o"), F.min_by("common_name", "o").alias("common_name"),
                                     F.min_by("wavelength", "o").alias("wavelength"))
    return first.select("name", "common_name", "wavelength", F.row_number().over(Window.orderBy("o")).alias("position"))


def bands_of(items: DataFrame) -> list[Band]:
    """The band table as schema bands (a handful of rows)."""
    return [Band(r["name"], r["common_name"], r["wavelength"]) for r in band_table(items).orderBy("position").collect()]
