"""Reading and writing files by format name, and writing several results of one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..errors import FormatUnsuitable
from ..operators.vector import Geometries

# Format names (lower case) and the Spark source each stands for.
FORMATS = {"parquet": "parquet", "geoparquet": "parquet", "csv": "csv", "json": "json", "orc": "orc",
           "geojson": "geojson", "geojsonseq": "geojson"}


def _format(name: str) -> str:
    if name.lower() not in FORMATS:
        raise FormatUnsuitable(f"{name!r}, use one of {sorted(FORMATS)}")
    return FORMATS[name.lower()]


def load_uploaded_files(spark: SparkSession, paths: list[str], format: str, options: dict | None = None):
    """Files of one format as one table (or geometries); a path that cannot be read is an error."""
    kind = _format(format)
    if kind == "geojson":
        from .geojson import load_geojson

        return load_geojson(spark, paths, multiline=format.lower() == "geojson", **(options or {}))
    defaults = {"header": "true"} if kind == "csv" else {}
    reader = spark.read.format(kind).options(**{**defaults, **(options or {})})
    return reader.load(paths)


def load_url(spark: SparkSession, url: str, format: str, options: dict | None = None):
    """One vector file or folder of a Spark-readable URI."""
    return load_uploaded_files(spark, [url], format, options)


def save_result(data, path: str, format: str = "parquet", options: dict | None = None, partition_by: list[str] | None = None,
                mode: str = "errorifexists") -> bool:
    """Write a cube or table; ``sample_by_feature`` gives one folder per geometry."""
    kind = _format(format)
    options = dict(options or {})
    if isinstance(data, Geometries):
        if kind == "geojson":
            from .geojson import to_geojson_lines

            to_geojson_lines(data, path)
            return True
        data = data.df
    df: DataFrame = data if isinstance(data, DataFrame) else data.df
    if kind == "geojson":
        raise FormatUnsuitable("only geometries go to GeoJSON")
    if kind == "csv" and any(t.startswith(("array", "struct", "map")) for _, t in df.dtypes):
        raise FormatUnsuitable("csv holds no nested values")
    if options.pop("sample_by_feature", False):
        if "geom_id" not in df.columns:
            raise FormatUnsuitable("sample_by_feature needs the dimension geom_id")
        partition_by = ["geom_id", *(partition_by or [])]
    defaults = {"header": "true"} if kind == "csv" else {}
    writer = df.write.format(kind).options(**{**defaults, **options}).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return True


def save_cube_layout(cube, path: str, tile: int = 512, mode: str = "errorifexists") -> None:
    """Parquet by month, clustered by spatial tile, so that extents prune files and row groups."""
    from pyspark.sql import functions as F

    x, y = cube.schema.xy
    t = cube.schema.only("temporal")
    df = cube.df.withColumns({
        "month": F.date_format(t, "yyyy-MM"),
        "__tx": F.floor(F.col(x) / (tile * (cube.schema.dim(x).step or 1.0))),
        "__ty": F.floor(F.col(y) / (tile * (cube.schema.dim(y).step or 1.0)))})
    df = df.repartitionByRange("month", "__tx", "__ty", x, y, t).sortWithinPartitions("month", "__tx", "__ty", t).drop("__tx", "__ty")
    df.write.mode(mode).partitionBy("month").parquet(path)


def write_all(results: dict, folder: str, format: str = "parquet", shared: DataFrame | None = None, mode: str = "errorifexists") -> list[str]:
    """Write several results of one plan; a shared parent frame is kept while they are written."""
    paths = []
    if shared is not None:
        shared.persist()
    try:
        for name, data in results.items():
            save_result(data, f"{folder}/{name}", format, mode=mode)
            paths.append(f"{folder}/{name}")
    finally:
        if shared is not None:
            shared.unpersist()
    return paths
