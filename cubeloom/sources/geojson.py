"""GeoJSON documents as geometry tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.vector import PARTS, Geometries, VectorCube
from ..schema import Band, CubeSchema, Dim

GEOMETRY = "struct<type:string,coordinates:string>"
FEATURE = f"struct<type:string,id:string,geometry:{GEOMETRY},properties:string>"
DOCUMENT = f"type string, id string, coordinates string, geometry {GEOMETRY}, properties string, features array<{FEATURE}>"


def parts_of(kind: Column, coordinates: Column) -> Column:
    """Coordinates of any geometry type as arrays of points."""
    def nested(depth: int) -> Column:
        return F.from_json(coordinates, "array<" * depth + "double" + ">" * depth)

    def points(a: Column) -> Column:
        return F.transform(a, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))

    one = F.when(F.size(nested(1)) >= 2, F.array(points(F.array(nested(1)))))
    rings = F.transform(nested(3), points)
    empty = F.array().cast(PARTS)
    found = (
        F.when(kind == "Point", one).when(kind.isin("MultiPoint", "LineString"), F.array(points(nested(2))))
        .when(kind.isin("Polygon", "MultiLineString"), rings)
        .when(kind == "MultiPolygon", F.transform(F.flatten(nested(4)), points))
        .when(kind.isNull(), empty).otherwise(F.raise_error(F.concat(F.lit("UnsupportedGeometry: "), kind)).cast(PARTS)))
    return F.coalesce(found, empty)


def read_features(spark: SparkSession, path, multiline: bool = True) -> DataFrame:
    """One row per feature: its id, type, parts and properties as JSON text.

    With ``multiline`` each file is one document; otherwise each line is one, which Spark
    can split (the layout for large tables).
    """
    docs = spark.read.schema(DOCUMENT).option("multiLine", multiline).json(path).withColumn("__file", F.col("_metadata.file_name"))
    alone = F.array(F.struct(
        F.col("type"), F.col("id"), F.coalesce(F.col("geometry"), F.struct(F.col("type").alias("type"), F.col("coordinates").alias("coordinates"))).alias("geometry"),
        F.col("properties")))
    rows = docs.select("__file", F.posexplode(F.when(F.col("type") == "FeatureCollection", F.col("features")).otherwise(alone).cast(f"array<{FEATURE}>")).alias("__place", "f"))
    return rows.select(
        "__file", "__place",
        F.col("f.id").alias("feature_id"), F.col("f.geometry.type").alias("geom_type"),
        parts_of(F.col("f.geometry.type"), F.col("f.geometry.coordinates")).alias("parts"), F.col("f.properties").alias("properties"))


def load_geojson(spark: SparkSession, path, properties: list[str] | None = None, multiline: bool = True, crs: int = 4326,
                 id_property: str | None = None):
    """Geometries, or with ``properties`` a vector cube with a ``properties`` dimension.

    One property: its value, or one label per array index if it holds arrays. Several:
    one label per property. Missing values are null. ``geom_id`` is the feature id (or an
    id property) if it is a whole number, else a negative number made from a hash of the id; features
    without an id take a hash of their content and place in the file. Either way every
    evaluation gives the same. The id as it is written stays as ``feature_id``.
    """
    rows = read_features(spark, path, multiline)
    given = F.get_json_object("properties", f"$.{id_property}") if id_property else F.col("feature_id")
    number = F.try_to_number(given, F.lit("999999999999999999")).cast("long")
    content = F.xxhash64(F.to_json("parts"), "properties", "geom_type", "__file", "__place")
    hashed = F.coalesce(F.when(given.isNotNull(), F.xxhash64(given)), content).bitwiseOR(F.lit(-(2**63)))
    rows = rows.withColumn("geom_id", F.coalesce(number, hashed)).withColumn("feature_id", given)
    geoms = Geometries(rows.select("geom_id", "geom_type", "parts", "feature_id", "properties"), crs)
    if not properties:
        return geoms
    raw = {p: F.get_json_object("properties", f"$.{p}") for p in properties}
    if len(properties) == 1:
        name, text = next(iter(raw.items()))
        array = F.from_json(text, "array<double>")
        is_array = F.startswith(F.trim(text), F.lit("["))
        longest = rows.agg(F.struct(F.max(F.when(is_array, F.size(array))).alias("n"))).scalar()["n"]
        index = F.sequence(F.lit(0), F.coalesce(longest, F.lit(1)) - 1)
        df = rows.withColumns({"__n": longest, "__i": F.explode(index)})
        label = F.when(F.col("__n").isNull(), F.lit(name)).otherwise(F.col("__i").cast("string"))
        value = F.when(F.col("__n").isNull(), text.cast("double")).otherwise(F.get(array, F.col("__i")))
        df = df.select("geom_id", label.alias("properties_"), value.alias("value"))
    else:
        entries = F.array(*[F.struct(F.lit(p).alias("l"), t.cast("double").alias("v")) for p, t in raw.items()])
        df = rows.select("geom_id", F.explode(entries).alias("e")).select("geom_id", F.col("e.l").alias("properties_"), F.col("e.v").alias("value"))
    schema = CubeSchema((Dim("geom_id", "geometry"), Dim("properties", "other")), (Band("value"),))
    return VectorCube(df.withColumnRenamed("properties_", "properties"), schema, geoms)


def to_geojson_lines(geometries: Geometries, path: str) -> None:
    """Write geometries as one GeoJSON feature per line; polygons of several parts keep even-odd rings."""
    ring = F.transform("parts", lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    coords = F.when(F.col("geom_type") == "Point", F.to_json(ring[0][0])).when(
        F.col("geom_type").isin("MultiPoint", "LineString"), F.to_json(ring[0])).when(
        F.col("geom_type") == "MultiPolygon", F.to_json(F.transform(ring, lambda r: F.array(r)))).otherwise(F.to_json(ring))
    props = geometries.properties
    body = F.to_json(F.struct(*props)) if props else F.lit("{}")
    line = F.concat(F.lit('{"type":"Feature","id":"'), F.col("geom_id").cast("string"), F.lit('","geometry":{"type":"'), F.col("geom_type"),
                    F.lit('","coordinates":'), coords, F.lit('},"properties":'), body, F.lit("}"))
    geometries.df.select(line.alias("value")).write.text(path)
