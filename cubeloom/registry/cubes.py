"""Queries for loading, labels, filters, masks, aggregation, merging and resampling."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..cube import Cube
from ..functions.dates import ntz
from ..operators import compare, runs, udf
from ..operators.bands import index_table
from ..operators.filters import collection_property as prop
from ..schema import Band
from ..session import scratch_path
from ..sources import files, stac
from ..sources.catalog import Catalog, Collection
from .base import IN_ELL, IN_SQUARE, IN_TRIANGLE, query

OPT = "B02 B04 B08"
BANDS = [Band("B02", "blue", 0.4966), Band("B04", "red", 0.6645), Band("B08", "nir", 0.8351), Band("SCL")]


def catalog(t) -> Catalog:
    c = Catalog(t.spark)
    c.register("OPTICAL", Collection(lambda s: t.view("cube_wide"), bands=tuple(BANDS), id="SENTINEL2_L2A"))
    c.register("SCENES", Collection(
        lambda s: t.view("scenes").select((F.col("scene_id") % 40).alias("x"), F.floor(F.col("scene_id") / 40).alias("y"), "t",
                                          "platform", "cloud_cover", F.col("scene_id").cast("double").alias("value")),
        bands=("value",), properties=("platform",), band_dim=None))
    return c


# -- 2.1 sources and sinks


@query("load_collection", """SELECT x, y, t, B08, B02 FROM cube_wide
WHERE x >= 1 AND x <= 6 AND y >= 0 AND y <= 5 AND t >= TIMESTAMP '1996-01-01' AND t < TIMESTAMP '1998-01-01'""", "B08 B02")
def _(t):
    return catalog(t).load_collection("OPTICAL", {"west": 1, "south": 0, "east": 6, "north": 5}, ("1996", "1998"), ["B08", "B02"])


@query("load_collection_max_cloud_cover", """SELECT scene_id % 40 AS x, scene_id // 40 AS y, t, CAST(scene_id AS DOUBLE) AS value FROM scenes
WHERE cloud_cover <= 20""")
def _(t):
    return catalog(t).load_collection("SCENES", max_cloud_cover=20)


@query("collection_property_filters", """SELECT scene_id % 40 AS x, scene_id // 40 AS y, t, CAST(scene_id AS DOUBLE) AS value FROM scenes
WHERE platform IN ('1-URGENT', '2-HIGH') AND cloud_cover > 5 AND cloud_cover < 60 AND platform <> '2-HIGH'""")
def _(t):
    return catalog(t).load_collection("SCENES", properties=[
        prop("platform").is_one_of("1-URGENT", "2-HIGH"), prop("cloud_cover") > 5, prop("cloud_cover") < 60, prop("platform") != "2-HIGH"])


def _stac_folder(t) -> tuple[str, str]:
    """Cubes per year as Parquet assets, and one STAC item per year that names them."""
    data, items = scratch_path(t.spark, "assets"), scratch_path(t.spark, "items")
    cube = t.wide.df.withColumn("year", F.year("t"))
    cube.write.partitionBy("year").parquet(data)
    rows = cube.groupBy("year").agg(F.min("x").alias("w"), F.min("y").alias("s"), F.max("x").alias("e"), F.max("y").alias("n"),
                                    F.count(F.lit(1)).alias("rows"))
    bands = F.array(*[F.struct(F.lit(b.name).alias("name"), F.lit(b.common_name).alias("common_name"), F.lit(b.wavelength).alias("center_wavelength"))
                      for b in BANDS])
    item = rows.select(
        F.lit("Feature").alias("type"), F.concat(F.lit("scene-"), F.col("year").cast("string")).alias("id"), F.array("w", "s", "e", "n").alias("bbox"),
        F.struct(F.concat(F.col("year").cast("string"), F.lit("-01-01T00:00:00Z")).alias("start_datetime"),
                 F.concat(F.col("year").cast("string"), F.lit("-12-31T23:59:59Z")).alias("end_datetime"),
                 F.lit("sat-1").alias("platform"), (F.col("year") % 10 * 10.0).alias("eo:cloud_cover")).alias("properties"),
        F.create_map(F.lit("data"), F.struct(
            F.concat(F.lit(data + "/year="), F.col("year").cast("string")).alias("href"), F.lit("application/x-parquet").alias("type"), bands.alias("bands"))).alias("assets"))
    item.write.json(items)
    return data, items


@query("load_stac", """SELECT x, y, t, B04, SCL FROM cube_wide WHERE t >= TIMESTAMP '1996-01-01' AND t < TIMESTAMP '2000-01-01'
AND year(t) % 10 <= 7 AND x <= 7""", "B04")
def _(t):
    _, items = _stac_folder(t)
    return stac.load_stac(t.spark, items, [-0.5, -0.5, 7, 99], ("1996", "2000"), ["B04", "SCL"],
                          properties=[F.col("properties.`eo:cloud_cover`") <= 70])


@query("stac_band_metadata", """SELECT b.name AS name, b.common_name AS common_name, b.wavelength AS wavelength, CAST(row_number() OVER (ORDER BY b.pos) AS INTEGER) AS position
FROM (VALUES (1, 'B02', 'blue', 0.4966::DOUBLE), (2, 'B04', 'red', 0.6645::DOUBLE), (3, 'B08', 'nir', 0.8351::DOUBLE), (4, 'SCL', NULL, NULL)) b(pos, name, common_name, wavelength)
WHERE EXISTS (SELECT 1 FROM lineitem)""", "wavelength")
def _(t):
    _, items = _stac_folder(t)
    return stac.band_table(stac.read_items(t.spark, items))


@query("stac_band_metadata_by_item", """WITH named AS (
  SELECT 'B' || n_nationkey % 7 AS name, CASE WHEN n_nationkey % 2 = 0 THEN n_name END AS common_name, n_nationkey / 10.0::DOUBLE AS wavelength,
         'scene-' || n_regionkey AS id, n_nationkey AS pos FROM nation
), first AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY id, pos) AS k FROM named)
SELECT name, common_name, wavelength, CAST(row_number() OVER (ORDER BY id, pos) AS INTEGER) AS position FROM first WHERE k = 1""", "wavelength")
def _(t):
    """Items with different bands, some named more than once: the first one counts, in order of appearance."""
    items = scratch_path(t.spark, "items")
    band = F.struct(F.col("n_nationkey").alias("k"), F.concat(F.lit("B"), F.col("n_nationkey") % 7).alias("name"),
                    F.when(F.col("n_nationkey") % 2 == 0, F.col("n_name")).alias("common_name"), (F.col("n_nationkey") / 10).alias("center_wavelength"))
    rows = t.table("nation").groupBy("n_regionkey").agg(F.sort_array(F.collect_list(band)).alias("b"))
    bands = F.transform("b", lambda b: F.struct(b["name"].alias("name"), b["common_name"].alias("common_name"), b["center_wavelength"].alias("center_wavelength")))
    rows.select(F.lit("Feature").alias("type"), F.concat(F.lit("scene-"), F.col("n_regionkey")).alias("id"),
                F.create_map(F.lit("data"), F.struct(F.lit("none").alias("href"), bands.alias("bands"))).alias("assets")).write.json(items)
    return stac.band_table(stac.read_items(t.spark, items))


@query("load_result", """SELECT x, y, t, B04 FROM cube_wide WHERE x >= 2 AND x <= 8 AND y >= 1 AND y <= 9
AND t >= TIMESTAMP '1997-05-01' AND t < TIMESTAMP '1997-06-01'""", "B04")
def _(t):
    path = scratch_path(t.spark, "result")
    files.save_cube_layout(t.wide, path)
    return catalog(t).load_result(path, "OPTICAL", [2, 1, 8, 9], "1997-05", ["B04"])


@query("save_result", "SELECT x, y, t, B02, B04, B08 FROM cube_wide", OPT)
def _(t):
    path = scratch_path(t.spark, "saved")
    files.save_result(t.optical, path, "Parquet")
    return t.spark.read.parquet(path)


@query("save_result_sample_by_feature", f"""SELECT geom_id, count(*) AS n, sum(B04) AS total FROM (
SELECT CAST(1 AS BIGINT) AS geom_id, B04, x + 0.25 AS px, y + 0.25 AS py FROM cube_wide WHERE x + 0.25 > 0.5 AND x + 0.25 < 4.5 AND y + 0.25 > 0.5 AND y + 0.25 < 4.5
UNION ALL SELECT 3, B04, px, py FROM (SELECT B04, x + 0.25 AS px, y + 0.25 AS py FROM cube_wide) c WHERE {IN_TRIANGLE}) u GROUP BY geom_id""", "total:3")
def _(t):
    from ..operators.geometry import pixel_hits

    path = scratch_path(t.spark, "samples")
    files.save_result(pixel_hits(t.shifted, t.zones("square", "triangle")), path, "parquet", {"sample_by_feature": True})
    back = t.spark.read.parquet(path)
    return back.groupBy(F.col("geom_id").cast("bigint").alias("geom_id")).agg(F.count(F.lit(1)).alias("n"), F.sum("B04").alias("total"))


@query("load_uploaded_files", "SELECT s_suppkey, s_name, s_acctbal FROM supplier", "s_acctbal")
def _(t):
    a, b = scratch_path(t.spark, "csv"), scratch_path(t.spark, "csv")
    rows = t.table("supplier").select("s_suppkey", "s_name", "s_acctbal")
    files.save_result(rows.where("s_suppkey % 2 = 0"), a, "CSV")
    files.save_result(rows.where("s_suppkey % 2 = 1"), b, "csv")
    return files.load_uploaded_files(t.spark, [a, b], "csv").select(
        F.col("s_suppkey").cast("bigint"), "s_name", F.col("s_acctbal").cast("double"))


@query("create_data_cube", "SELECT x, y, elev FROM cube_static", "elev")
def _(t):
    empty = Cube.empty(t.spark)
    assert empty.schema.all_names == []
    return empty._new(t.static.df, t.static.schema)


@query("create_data_cube_filled", """SELECT x, y, 'elevation' AS kind, elev AS value FROM cube_static
UNION ALL SELECT x, y, 'copies' AS kind, CAST(2 AS DOUBLE) AS value FROM cube_static""", "value")
def _(t):
    """An empty cube takes the first cube merged into it as it is, and goes on from there."""
    value = Cube.of(t.static.df.withColumnRenamed("elev", "value"), temporal=(), bands=["value"], band_dim=None)
    filled = Cube.empty(t.spark).merge_cubes(value.add_dimension("kind", "elevation"))
    two = value.apply(lambda v: F.lit(2.0)).add_dimension("kind", "copies")
    return filled.merge_cubes(two).merge_cubes(Cube.empty(t.spark)).df.select("x", "y", "kind", "value")


@query("multi_result", """SELECT x, y, 'max' AS kind, max(B04) AS value FROM cube_wide GROUP BY x, y
UNION ALL SELECT x, y, 'min' AS kind, min(B04) AS value FROM cube_wide GROUP BY x, y""", "value")
def _(t):
    parent = t.wide.filter_bands(["B04"])
    folder = scratch_path(t.spark, "multi")
    files.write_all({"max": parent.max_time(), "min": parent.min_time()}, folder, shared=parent.df)
    return t.spark.read.parquet(folder + "/max").withColumn("kind", F.lit("max")).unionByName(
        t.spark.read.parquet(folder + "/min").withColumn("kind", F.lit("min"))).select("x", "y", "kind", F.col("B04").alias("value"))


# -- 2.2 dimensions and labels


@query("add_dimension", "SELECT x, y, t, 'S2' AS platform, B02, B04, B08 FROM cube_wide", OPT)
def _(t):
    return t.optical.add_dimension("platform", "S2")


@query("drop_dimension", "SELECT x, y, elev FROM cube_static", "elev")
def _(t):
    return t.static.add_dimension("source", "dem").drop_dimension("source")


@query("rename_dimension", "SELECT x AS lon, y, t, B02, B04, B08 FROM cube_wide", OPT)
def _(t):
    return t.optical.rename_dimension("x", "lon")


@query("rename_labels", """SELECT x, y, t, CASE bands WHEN 'click' THEN 'tap' WHEN 'error' THEN 'failure' ELSE bands END AS bands, value FROM cube_long""", "value")
def _(t):
    return t.long.rename_labels("bands", ["tap", "failure"], ["click", "error"])


@query("rename_labels_bands", "SELECT x, y, t, B02 AS blue, B04, B08 AS nir FROM cube_wide", "blue B04 nir")
def _(t):
    return t.optical.rename_labels("bands", ["blue", "nir"], ["B02", "B08"])


@query("dimension_labels", "SELECT DISTINCT t FROM cube_wide")
def _(t):
    return t.wide.dimension_labels("t")


@query("flatten_dimensions", "SELECT concat(CAST(y AS VARCHAR), '/', CAST(x AS VARCHAR)) AS pixel, t, B02, B04, B08 FROM cube_wide", OPT)
def _(t):
    return t.optical.flatten_dimensions(["y", "x"], "pixel", "/")


@query("unflatten_dimension", "SELECT t, CAST(y AS VARCHAR) AS row, CAST(x AS VARCHAR) AS col, B02, B04, B08 FROM cube_wide", OPT)
def _(t):
    return t.optical.flatten_dimensions(["y", "x"], "pixel", ".").unflatten_dimension("pixel", ["row", "col"], ".")


@query("trim_cube", """SELECT c.x, c.y, c.t, c.v FROM (SELECT x, y, t, CASE WHEN x >= 2 AND y >= 0 AND t >= TIMESTAMP '1996-06-15' AND t < TIMESTAMP '2000-02-02' THEN B04 END AS v FROM cube_wide) c
WHERE c.x >= (SELECT min(x) FROM cube_wide WHERE x >= 2) AND c.t BETWEEN (SELECT min(t) FROM cube_wide WHERE x >= 2 AND t >= TIMESTAMP '1996-06-15' AND t < TIMESTAMP '2000-02-02')
AND (SELECT max(t) FROM cube_wide WHERE x >= 2 AND t >= TIMESTAMP '1996-06-15' AND t < TIMESTAMP '2000-02-02')""", "v")
def _(t):
    keep = (F.col("x") >= 2) & (F.col("t") >= ntz(dt.datetime(1996, 6, 15))) & (F.col("t") < ntz(dt.datetime(2000, 2, 2)))
    c = t.wide.filter_bands(["B04"])
    return c._new(c.df.withColumn("v", F.when(keep, F.col("B04"))), c.schema.single("v")).trim_cube()


@query("filter_labels", "SELECT x, y, t, bands, value FROM cube_long WHERE bands IN ('click', 'view', 'purchase')", "value")
def _(t):
    return t.long.filter_labels(lambda v: v.isin("click", "view", "purchase"), "bands")


@query("band", "SELECT x, y, t, B08 AS value FROM cube_wide", "value")
def _(t):
    return t.wide.band("nir")


@query("filter_bands", "SELECT x, y, t, B08, B02, B04 FROM cube_wide", OPT)
def _(t):
    return t.wide.filter_bands(["nir", "blau"], wavelengths=[[0.6, 0.7]])


# -- 2.3 filters and masks


@query("filter_temporal", """SELECT x, y, t, B02, B04, B08 FROM cube_wide WHERE t >= TIMESTAMP '1996-03-01' AND t < TIMESTAMP '1999-01-01'""", OPT)
def _(t):
    return t.optical.filter_temporal("1996-03", "1999")


@query("filter_bbox", "SELECT x, y, t, B02, B04, B08 FROM cube_wide WHERE x BETWEEN 2 AND 6.5 AND y BETWEEN 0 AND 4", OPT)
def _(t):
    return t.optical.filter_bbox({"west": 2, "east": 6.5, "south": 0, "north": 4})


@query("bbox_antimeridian", """SELECT lon, lat, value FROM (SELECT CAST(c_custkey % 360 - 180 AS DOUBLE) AS lon, CAST(c_custkey * 7 % 179 - 89 AS DOUBLE) AS lat, c_acctbal AS value FROM customer) c
WHERE (lon >= 170 OR lon <= -160) AND lat BETWEEN -50 AND 60""", "value")
def _(t):
    c = t.table("customer").select(
        (F.col("c_custkey") % 360 - 180).cast("double").alias("lon"), (F.col("c_custkey") * 7 % 179 - 89).cast("double").alias("lat"), F.col("c_acctbal").alias("value"))
    return Cube.of(c, ("lon", "lat"), (), bands=["value"], band_dim=None, crs=4326).filter_bbox({"west": 170, "east": 200, "south": -50, "north": 60, "crs": 4326})


@query("filter_spatial", "SELECT x + 0.25 AS x, y + 0.25 AS y, t, B02, B04, B08 FROM cube_wide WHERE x + 0.25 BETWEEN 0 AND 6 AND y + 0.25 BETWEEN 0 AND 6", "x y B02 B04 B08")
def _(t):
    return t.shifted.filter_spatial(t.zones("square", "triangle", "empty"))


@query("mask_polygon", f"""SELECT px AS x, py AS y, t, CASE WHEN {IN_SQUARE} OR {IN_ELL} THEN B04 END AS B04, CASE WHEN {IN_SQUARE} OR {IN_ELL} THEN B08 END AS B08
FROM (SELECT x + 0.25 AS px, y + 0.25 AS py, t, B04, B08 FROM cube_wide) c""", "x y B04 B08")
def _(t):
    return t.shifted.filter_bands(["B04", "B08"]).mask_polygon(t.zones("square", "ell", "far", "empty"))


@query("mask_polygon_crs", f"""SELECT px AS x, py AS y, t, CASE WHEN {IN_SQUARE} OR {IN_ELL} THEN B04 END AS B04
FROM (SELECT x + 0.25 AS px, y + 0.25 AS py, t, B04 FROM cube_wide) c""", "x y B04")
def _(t):
    """The polygons come in degrees and are brought to the system of the cube."""
    return t.shifted.filter_bands(["B04"]).mask_polygon(t.zones("square", "ell").vector_reproject(4326))


@query("mask_polygon_inside", f"""SELECT px AS x, py AS y, t, CASE WHEN {IN_TRIANGLE} THEN -1.0 ELSE B04 END AS B04
FROM (SELECT x + 0.25 AS px, y + 0.25 AS py, t, B04 FROM cube_wide) c""", "x y B04")
def _(t):
    return t.shifted.filter_bands(["B04"]).mask_polygon(t.zones("triangle"), replacement=-1.0, inside=True)


@query("mask", """SELECT x, y, t, CASE WHEN SCL >= 6 THEN NULL ELSE B02 END AS B02, CASE WHEN SCL >= 6 THEN NULL ELSE B04 END AS B04,
CASE WHEN SCL >= 6 THEN NULL ELSE B08 END AS B08 FROM cube_wide""", OPT)
def _(t):
    cloud = t.wide.band("SCL").apply(lambda v: (v >= 6).cast("int"))
    return t.optical.mask(cloud)


@query("mask_without_time", """SELECT c.x, c.y, c.t, CASE WHEN s.elev > 5000 THEN -9.0 ELSE c.B04 END AS B04 FROM cube_wide c LEFT JOIN cube_static s ON c.x = s.x AND c.y = s.y""", "B04")
def _(t):
    return t.wide.filter_bands(["B04"]).mask(t.static.apply(lambda v: v > 5000), replacement=-9.0)


# -- 2.4 apply and reduce


@query("apply_dimension", """SELECT x, y, r AS rank, B04, B08 FROM (
SELECT x, y, list_sort(list(B04))[1:3] AS a, list_sort(list(B08))[1:3] AS b FROM cube_wide GROUP BY x, y) c,
LATERAL (SELECT i - 1 AS r, a[i] AS B04, b[i] AS B08 FROM (SELECT CAST(unnest(range(1, len(a) + 1)) AS INTEGER) AS i) n) u""", "B04 B08")
def _(t):
    return t.wide.filter_bands(["B04", "B08"]).apply_dimension(lambda a: F.slice(F.sort_array(a), 1, 3), "t", "rank")


@query("apply_dimension_bands", "SELECT x, y, t, B02 / (B02 + B04 + B08) AS B02, B04 / (B02 + B04 + B08) AS B04, B08 / (B02 + B04 + B08) AS B08 FROM cube_wide", OPT)
def _(t):
    return t.optical.apply_dimension(lambda a: [F.try_divide(a[i], a[0] + a[1] + a[2]) for i in range(3)], "bands")


@query("reduce_dimension", "SELECT x, y, max(B02) - min(B02) AS B02, max(B04) - min(B04) AS B04, max(B08) - min(B08) AS B08 FROM cube_wide GROUP BY x, y", OPT)
def _(t):
    return t.optical.reduce_dimension(lambda s: s.max() - s.min(), "t")


@query("reduce_bands", "SELECT x, y, t, greatest(B02, B04, B08) - least(B02, B04, B08) AS value FROM cube_wide", "value")
def _(t):
    return t.optical.reduce_bands(lambda s: s.max() - s.min())


@query("reduce_temporal", "SELECT x, y, bands, stddev_samp(value) AS value FROM cube_long GROUP BY x, y, bands", "value")
def _(t):
    return t.long.reduce_temporal("sd")


@query("reduce_spatial", "SELECT t, avg(B02) AS B02, avg(B04) AS B04, avg(B08) AS B08 FROM cube_wide GROUP BY t", OPT)
def _(t):
    return t.optical.reduce_spatial("mean")


@query("reduce_spatial_median", "SELECT bands, quantile_cont(value, 0.5) AS value FROM cube_long GROUP BY bands", "value")
def _(t):
    return Cube(t.long.df.drop("t"), t.long.schema.without("t")).reduce_spatial("median")


for _name, _agg in (("min", "min"), ("max", "max"), ("mean", "avg"), ("median", "median"), ("count", "count")):
    def _composite(name=_name, agg=_agg):
        @query(f"{name}_time", f"SELECT x, y, bands, {agg}(value) AS value FROM cube_long GROUP BY x, y, bands", "" if name == "count" else "value")
        def _(t):
            return getattr(t.long, f"{name}_time")()

    _composite()


@query("apply_neighborhood", """SELECT x, y, t, B04 - avg(B04) OVER (PARTITION BY t, x // 4, y // 4) AS B04 FROM cube_wide""", "B04")
def _(t):
    c = t.wide.filter_bands(["B04"])

    def demean(block):
        mean = block.reduce_spatial("mean").rename_labels("bands", ["m"])
        return block._new(block.df.join(mean.df, ["t", "block"]).withColumn("B04", F.col("B04") - F.col("m")))

    return c.apply_neighborhood(demean, {"x": 4, "y": 4})


@query("apply_neighborhood_units", """SELECT x, y, t, B04 - avg(B04) OVER (PARTITION BY x // 3, y // 2,
  ((year(t) * 12 + month(t)) - (SELECT min(year(t) * 12 + month(t)) FROM cube_wide)) // 2) AS B04 FROM cube_wide""", "B04")
def _(t):
    """Blocks of 30 m by 2 pixels by two calendar months, in pixels of ten metres."""
    c = t.wide.filter_bands(["B04"])
    c = Cube.of(c.df.withColumns({"x": F.col("x") * 10, "y": F.col("y") * 10}), bands=["B04"], step=10.0, crs=32631)

    def demean(block):
        mean = block.df.groupBy("block").agg(F.avg("B04").alias("m"))
        return block._new(block.df.join(mean, "block").withColumn("B04", F.col("B04") - F.col("m")))

    out = c.apply_neighborhood(demean, [{"dimension": "x", "value": 30, "unit": "m"}, {"dimension": "y", "value": 2, "unit": "px"}, {"dimension": "t", "value": "P2M"}])
    return out.df.withColumns({"x": (F.col("x") / 10).cast("long"), "y": (F.col("y") / 10).cast("long")})


@query("apply_neighborhood_overlap", """SELECT c.x, c.y, c.t, CAST(count(n.t) AS DOUBLE) AS B04 FROM cube_wide c JOIN cube_wide n ON n.x = c.x AND n.y = c.y
  AND epoch_us(n.t) + 10 * 86400000000 >= (SELECT epoch_us(min(t)) FROM cube_wide) + 30 * 86400000000 * ((epoch_us(c.t) - (SELECT epoch_us(min(t)) FROM cube_wide)) // (30 * 86400000000))
  AND epoch_us(n.t) - 10 * 86400000000 < (SELECT epoch_us(min(t)) FROM cube_wide) + 30 * 86400000000 * ((epoch_us(c.t) - (SELECT epoch_us(min(t)) FROM cube_wide)) // (30 * 86400000000) + 1)
GROUP BY c.x, c.y, c.t""")
def _(t):
    """How many labels of its series a block of 30 days sees with 10 days of overlap on both sides."""
    c = t.wide.filter_bands(["B04"])

    def count(block):
        n = block.df.groupBy("x", "y", "block").agg(F.count(F.lit(1)).cast("double").alias("n"))
        return block._new(block.df.join(n, ["x", "y", "block"]).withColumn("B04", F.col("n")))

    return c.apply_neighborhood(count, {"t": "30 days"}, {"t": "P10D"})


@query("apply_neighborhood_pandas", """SELECT c.x, c.y, c.t, CAST(count(n.x) AS DOUBLE) AS B04 FROM cube_wide c JOIN cube_wide n
ON n.t = c.t AND n.x BETWEEN (c.x // 5) * 5 - 2 AND (c.x // 5) * 5 + 6 AND n.y BETWEEN (c.y // 5) * 5 - 2 AND (c.y // 5) * 5 + 6 GROUP BY c.x, c.y, c.t""")
def _(t):
    def count_all(pdf, context):
        pdf["B04"] = pdf.groupby("t")["x"].transform("size").astype(float)
        return pdf[["x", "y", "t", "B04", "__core"]]

    c = t.wide.filter_bands(["B04"])
    # blocks in time keep a group small however long the series is
    return c.apply_neighborhood(count_all, {"x": 5, "y": 5, "t": 90 * 86400}, {"x": 2, "y": 2}, schema="x bigint, y bigint, t timestamp_ntz, B04 double").df


@query("apply_polygon", f"""SELECT px AS x, py AS y, t, CASE WHEN g IS NULL THEN -1.0 ELSE B04 - avg(B04) OVER (PARTITION BY t, g) END AS B04
FROM (SELECT *, CASE WHEN {IN_SQUARE} THEN 1 WHEN px > 6.1 AND px < 8.5 AND py > 0.1 AND py < 3.5 THEN 2 END AS g
 FROM (SELECT x + 0.25 AS px, y + 0.25 AS py, t, B04 FROM cube_wide) c) d""", "x y B04")
def _(t):
    return _segments(t, "apply_polygon")


@query("chunk_polygon", f"""SELECT px AS x, py AS y, t, CASE WHEN g IS NULL THEN -1.0 ELSE B04 - avg(B04) OVER (PARTITION BY t, g) END AS B04
FROM (SELECT *, CASE WHEN {IN_SQUARE} THEN 1 WHEN px > 6.1 AND px < 8.5 AND py > 0.1 AND py < 3.5 THEN 2 END AS g
 FROM (SELECT x + 0.25 AS px, y + 0.25 AS py, t, B04 FROM cube_wide) c) d""", "x y B04")
def _(t):
    return _segments(t, "chunk_polygon")


def _segments(t, method: str):
    from ..operators.vector import Geometries
    from .base import SQUARE

    zones = Geometries.from_shapes(t.spark, [
        {"type": "Polygon", "id": 1, "coordinates": [SQUARE]},
        {"type": "Polygon", "id": 2, "coordinates": [[(6.1, 0.1), (8.5, 0.1), (8.5, 3.5), (6.1, 3.5), (6.1, 0.1)]]}], 3857)

    def demean(sub):
        mean = sub.reduce_spatial("mean").rename_labels("bands", ["m"])
        return sub._new(sub.df.join(mean.df, ["t", "geom_id"]).withColumn("B04", F.col("B04") - F.col("m")))

    return getattr(t.shifted.filter_bands(["B04"]), method)(zones, demean, mask_value=-1.0)


# -- 2.5 aggregation


@query("aggregate_temporal", """SELECT p.x, p.y, i.s AS t, avg(c.B04) AS B04, avg(c.B08) AS B08 FROM (SELECT DISTINCT x, y FROM cube_wide) p
CROSS JOIN (VALUES (TIMESTAMP '1996-01-01', TIMESTAMP '1997-01-01'), (TIMESTAMP '1996-06-01', TIMESTAMP '1998-01-01'), (TIMESTAMP '2050-01-01', TIMESTAMP '2051-01-01')) i(s, e)
LEFT JOIN cube_wide c ON c.x = p.x AND c.y = p.y AND c.t >= i.s AND c.t < i.e GROUP BY p.x, p.y, i.s""", "B04 B08")
def _(t):
    return t.wide.filter_bands(["B04", "B08"]).aggregate_temporal([("1996", "1997"), ("1996-06", "1998"), ("2050", "2051")], "mean")


@query("aggregate_temporal_labels", """SELECT p.x, p.y, i.l AS t, count(c.B04) AS B04 FROM (SELECT DISTINCT x, y FROM cube_wide) p
CROSS JOIN (VALUES ('a', TIMESTAMP '1996-01-01', TIMESTAMP '1997-01-01'), ('b', TIMESTAMP '1996-01-01', TIMESTAMP '1996-02-01'), ('none', TIMESTAMP '2050-01-01', TIMESTAMP '2051-01-01')) i(l, s, e)
LEFT JOIN cube_wide c ON c.x = p.x AND c.y = p.y AND c.t >= i.s AND c.t < i.e GROUP BY p.x, p.y, i.l""")
def _(t):
    return t.wide.filter_bands(["B04"]).aggregate_temporal([("1996", "1997"), ("1996-01", "1996-02"), ("2050", "2051")], "count", labels=["a", "b", "none"])


def _period_sql(start: str, step: str, label: str, cube: str = "cube_wide", cols: str = "avg(c.B04) AS B04, avg(c.B08) AS B08", keys: str = "x, y") -> str:
    """Spine of period starts for every pixel, joined to the groups by start."""
    pk = ", ".join(f"p.{k.strip()}" for k in keys.split(","))
    on = " AND ".join(f"c.{k.strip()} = p.{k.strip()}" for k in keys.split(","))
    return f"""SELECT {pk}, {label} AS t, {cols} FROM (SELECT DISTINCT {keys} FROM {cube}) p
CROSS JOIN (SELECT unnest(generate_series((SELECT min({start}) FROM {cube}), (SELECT max({start}) FROM {cube}), INTERVAL {step})) AS s) i
LEFT JOIN (SELECT *, {start} AS ps FROM {cube}) c ON {on} AND c.ps = i.s GROUP BY {pk}, i.s"""


_P = {
    "month": ("date_trunc('month', t)::TIMESTAMP", "1 MONTH", "strftime(i.s, '%Y-%m')"),
    "week": ("date_trunc('week', t)::TIMESTAMP", "7 DAY", "strftime(i.s, '%G-%V')"),
    "season": ("(date_trunc('month', t) - to_months(CAST(month(t) % 3 AS INTEGER)))::TIMESTAMP", "3 MONTH",
               "concat(year(i.s + INTERVAL 1 MONTH), CASE month(i.s) WHEN 12 THEN '-djf' WHEN 3 THEN '-mam' WHEN 6 THEN '-jja' ELSE '-son' END)"),
    "tropical_season": ("(date_trunc('month', t) - to_months(CAST((month(t) + 1) % 6 AS INTEGER)))::TIMESTAMP", "6 MONTH",
                        "concat(year(i.s + INTERVAL 2 MONTH), CASE month(i.s) WHEN 11 THEN '-ndjfma' ELSE '-mjjaso' END)"),
    "year": ("date_trunc('year', t)::TIMESTAMP", "1 YEAR", "strftime(i.s, '%Y')"),
    "decade": ("make_timestamp(year(t) - year(t) % 10, 1, 1, 0, 0, 0)", "10 YEAR", "strftime(i.s, '%Y')"),
    "decade_ad": ("make_timestamp(year(t) - (year(t) + 9) % 10, 1, 1, 0, 0, 0)", "10 YEAR", "strftime(i.s, '%Y')"),
}
for _period, (_start, _step, _label) in _P.items():
    def _period_query(period=_period, start=_start, step=_step, label=_label):
        @query(f"aggregate_temporal_period_{period}", _period_sql(start, step, label), "B04 B08")
        def _(t):
            return t.wide.filter_bands(["B04", "B08"]).aggregate_temporal_period(period.replace("_", "-"), "mean")

    _period_query()


@query("aggregate_temporal_period_day", _period_sql("date_trunc('day', t)::TIMESTAMP", "1 DAY", "strftime(i.s, '%Y-%j')", "cube_long", "sum(c.value) AS value", "x, y, bands"), "value")
def _(t):
    return t.long.aggregate_temporal_period("day", "sum")


@query("aggregate_temporal_period_hour", """SELECT x, y, bands, strftime(t, '%Y-%m-%d-%H') AS t, max(value) AS value FROM cube_long GROUP BY x, y, bands, strftime(t, '%Y-%m-%d-%H')""", "value")
def _(t):
    return t.long.aggregate_temporal_period("hour", "max", complete=False)


_DEKAD = "CAST((month(t) - 1) * 3 + least((day(t) - 1) // 10, 2) + 1 AS INTEGER)"


@query("aggregate_temporal_period_dekad", f"""SELECT p.x, p.y, concat(i.y, '-', lpad(CAST(i.d AS VARCHAR), 2, '0')) AS t, median(c.B04) AS B04
FROM (SELECT DISTINCT x, y FROM cube_wide) p CROSS JOIN (SELECT yy.y, dd.d FROM (SELECT unnest(range(1990, 2010)) AS y) yy CROSS JOIN (SELECT unnest(range(1, 37)) AS d) dd) i
LEFT JOIN (SELECT *, year(t) * 100 + {_DEKAD} AS k FROM cube_wide) c ON c.x = p.x AND c.y = p.y AND c.k = i.y * 100 + i.d
WHERE i.y * 100 + i.d BETWEEN (SELECT min(year(t) * 100 + {_DEKAD}) FROM cube_wide) AND (SELECT max(year(t) * 100 + {_DEKAD}) FROM cube_wide)
GROUP BY p.x, p.y, i.y, i.d""", "B04")
def _(t):
    return t.wide.filter_bands(["B04"]).aggregate_temporal_period("dekad", "median")


_ZONES = f"""(SELECT CAST(1 AS BIGINT) AS geom_id, * FROM px WHERE {IN_SQUARE} UNION ALL SELECT 2, * FROM px WHERE {IN_ELL} UNION ALL SELECT 3, * FROM px WHERE {IN_TRIANGLE})"""
_PX = "(SELECT x + 0.25 AS px, y + 0.25 AS py, t, B02, B04, B08 FROM cube_wide)"
_GEOMS = "(VALUES (CAST(1 AS BIGINT)), (2), (3), (4), (5)) g(geom_id)"


def _zonal(cols: str, tail: str = "GROUP BY g.geom_id, z.t") -> str:
    return f"SELECT g.geom_id, z.t, {cols} FROM {_GEOMS} LEFT JOIN {_ZONES.replace('FROM px', 'FROM ' + _PX + ' px')} z ON z.geom_id = g.geom_id {tail}"


@query("aggregate_spatial", _zonal("avg(z.B02) AS B02, avg(z.B04) AS B04, avg(z.B08) AS B08"), OPT)
def _(t):
    return t.shifted.aggregate_spatial(t.zones(), "mean")


@query("aggregate_spatial_crs", _zonal("avg(z.B02) AS B02, avg(z.B04) AS B04, avg(z.B08) AS B08"), OPT)
def _(t):
    """The polygons come in degrees and are brought to the system of the cube."""
    return t.shifted.aggregate_spatial(t.zones().vector_reproject(4326), "mean")


@query("aggregate_spatial_counts", f"""SELECT geom_id, t, u.info AS info, CASE u.info WHEN 'value' THEN value WHEN 'total_count' THEN total ELSE valid END AS B02
FROM ({_zonal("max(z.B02) AS value, CAST(CASE WHEN count(z.px) > 0 THEN count(z.px) END AS DOUBLE) AS total, CAST(CASE WHEN count(z.px) > 0 THEN count(z.B02) END AS DOUBLE) AS valid")}) a
CROSS JOIN (VALUES ('value'), ('total_count'), ('valid_count')) u(info)""", "B02")
def _(t):
    return t.shifted.filter_bands(["B02"]).aggregate_spatial(t.zones(), "max", target_dimension="info").df


@query("aggregate_spatial_window", """SELECT CAST((x // 3) * 3 + 1 AS DOUBLE) AS x, CAST((SELECT max(y) FROM cube_wide) - 0.5 - 2 * (((SELECT max(y) FROM cube_wide) - y) // 2) AS DOUBLE) AS y, t,
avg(B04) AS B04, avg(B08) AS B08 FROM cube_wide GROUP BY 1, 2, 3""", "x y B04 B08")
def _(t):
    return t.wide.filter_bands(["B04", "B08"]).aggregate_spatial_window("mean", (3, 2))


@query("aggregate_spatial_window_trim", """SELECT CAST(m.x - 1 - 3 * ((m.x - c.x) // 3) AS DOUBLE) AS x, CAST((c.y // 2) * 2 + 0.5 AS DOUBLE) AS y, c.t, max(c.B04) AS B04
FROM cube_wide c, (SELECT max(x) AS x, min(x) AS x0, max(y) AS y FROM cube_wide) m
WHERE m.x - c.x < ((m.x - m.x0 + 1) // 3) * 3 AND c.y < ((m.y + 1) // 2) * 2 GROUP BY 1, 2, 3""", "x y B04")
def _(t):
    return t.wide.filter_bands(["B04"]).aggregate_spatial_window("max", (3, 2), boundary="trim", align="lower-right")


@query("polygonal_mean_timeseries", _zonal("avg(z.B04) AS B04"), "B04")
def _(t):
    return t.shifted.filter_bands(["B04"]).polygonal_mean_timeseries(t.zones()).df


@query("polygonal_median_timeseries", _zonal("median(z.B04) AS B04"), "B04")
def _(t):
    return t.shifted.filter_bands(["B04"]).polygonal_median_timeseries(t.zones()).df


@query("polygonal_standarddeviation_timeseries", _zonal("stddev_samp(z.B04) AS B04"), "B04")
def _(t):
    return t.shifted.filter_bands(["B04"]).polygonal_standarddeviation_timeseries(t.zones()).df


@query("polygonal_histogram_timeseries", f"""SELECT z.geom_id, z.t, u.bands AS bands, CASE u.bands WHEN 'B02' THEN round(z.B02, 9) ELSE round(z.B04, 9) END AS value, count(*) AS n
FROM {_ZONES.replace('FROM px', 'FROM ' + _PX + ' px')} z CROSS JOIN (VALUES ('B02'), ('B04')) u(bands)
WHERE CASE u.bands WHEN 'B02' THEN z.B02 ELSE z.B04 END IS NOT NULL GROUP BY 1, 2, 3, 4""", "value")
def _(t):
    c = t.shifted.filter_bands(["B02", "B04"]).apply(lambda v: F.round(v, 9))
    return c.polygonal_histogram_timeseries(t.zones())


@query("timeseries_table", f"""SELECT t, max(B04) FILTER (WHERE geom_id = 1) AS "1", max(B04) FILTER (WHERE geom_id = 2) AS "2" FROM ({_zonal("max(floor(z.B04)) AS B04")}) a WHERE t IS NOT NULL GROUP BY t""")
def _(t):
    z = t.shifted.filter_bands(["B04"]).apply(lambda v: F.floor(v).cast("double")).aggregate_spatial(t.zones(), "max")
    return z.timeseries_table([1, 2])


_MAXIMA = f"""({_zonal("max(floor(z.B04)) AS B04, max(floor(z.B08)) AS B08")})"""


def _maxima(t, *zones):
    return t.shifted.filter_bands(["B04", "B08"]).apply(lambda v: F.floor(v).cast("double")).aggregate_spatial(t.zones(*zones), "max")


@query("timeseries_table_found_polygons", f"""SELECT t, {", ".join(f'max({b}) FILTER (WHERE geom_id = {i}) AS "{i}_{b}"' for i in (1, 2, 3) for b in ("B04", "B08"))}
FROM {_MAXIMA} a WHERE t IS NOT NULL GROUP BY t""")
def _(t):
    return _maxima(t, "square", "ell", "triangle").timeseries_table()


@query("timeseries_table_one_polygon", f"SELECT t, max(B04) AS B04, max(B08) AS B08 FROM {_MAXIMA} a WHERE t IS NOT NULL AND geom_id = 2 GROUP BY t")
def _(t):
    return _maxima(t, "ell").timeseries_table()


_SEASON = "CASE WHEN month(t) IN (12, 1, 2) THEN 'djf' WHEN month(t) BETWEEN 3 AND 5 THEN 'mam' WHEN month(t) BETWEEN 6 AND 8 THEN 'jja' ELSE 'son' END"


@query("climatological_normal", f"""SELECT x, y, s AS t, avg(B04) AS B04, avg(B08) AS B08 FROM (SELECT *, {_SEASON} AS s, year(t) + CASE WHEN month(t) = 12 THEN 1 ELSE 0 END AS sy FROM cube_wide) c
WHERE sy BETWEEN 1995 AND 2000 AND NOT (sy = 1995 AND s = 'djf' AND (SELECT count(*) FROM cube_wide WHERE year(t) = 1994 AND month(t) = 12) = 0) GROUP BY x, y, s""", "B04 B08")
def _(t):
    return t.wide.filter_bands(["B04", "B08"]).climatological_normal("season", (1995, 2000))


@query("climatological_normal_month", """SELECT x, y, strftime(t, '%m') AS t, avg(B04) AS B04 FROM cube_wide WHERE year(t) BETWEEN 1996 AND 1999 GROUP BY 1, 2, 3""", "B04")
def _(t):
    return t.wide.filter_bands(["B04"]).climatological_normal("month", (1996, 1999))


@query("anomaly", """SELECT m.x, m.y, m.t, m.B04 - n.B04 AS B04 FROM (SELECT x, y, strftime(t, '%Y-%m') AS t, strftime(t, '%m') AS p, avg(B04) AS B04 FROM cube_wide GROUP BY 1, 2, 3, 4) m
LEFT JOIN (SELECT x, y, strftime(t, '%m') AS p, avg(B04) AS B04 FROM cube_wide WHERE year(t) BETWEEN 1996 AND 1999 GROUP BY 1, 2, 3) n ON n.x = m.x AND n.y = m.y AND n.p = m.p""", "B04")
def _(t):
    c = t.wide.filter_bands(["B04"])
    return c.aggregate_temporal_period("month", "mean", complete=False).anomaly(c.climatological_normal("month", (1996, 1999)), "month")


# -- 2.6 merging and resampling


@query("merge_cubes", """SELECT coalesce(a.x, b.x) AS x, coalesce(a.y, b.y) AS y, coalesce(a.t, b.t) AS t,
CASE WHEN a.x IS NOT NULL AND b.x IS NOT NULL THEN greatest(a.B04, b.B04) ELSE coalesce(a.B04, b.B04) END AS B04, b.B08 AS B08
FROM (SELECT x, y, t, B04 FROM cube_wide WHERE x <= 6) a FULL OUTER JOIN (SELECT x, y, t, B04 / 2 + 10 AS B04, B08 FROM cube_wide WHERE x >= 4) b ON a.x = b.x AND a.y = b.y AND a.t = b.t""", "B04 B08")
def _(t):
    a = t.wide.filter_bands(["B04"]).filter_labels(lambda v: v <= 6, "x")
    b = t.wide.filter_bands(["B04", "B08"]).filter_labels(lambda v: v >= 4, "x")
    b = b._new(b.df.withColumn("B04", F.col("B04") / 2 + 10))
    return a.merge_cubes(b, lambda x, y: F.greatest(x, y))


@query("merge_cubes_broadcast", """SELECT c.x, c.y, c.t, c.B04 - s.elev / 1000 AS B04, c.B08 - s.elev / 1000 AS B08 FROM cube_wide c LEFT JOIN cube_static s ON c.x = s.x AND c.y = s.y""", "B04 B08")
def _(t):
    return t.wide.filter_bands(["B04", "B08"]).merge_cubes(t.static, lambda x, y: x - y / 1000)


@query("merge_cubes_bands", "SELECT x, y, t, B02, B08 FROM cube_wide", "B02 B08")
def _(t):
    return t.wide.filter_bands(["B02"]).merge_cubes(t.wide.filter_bands(["B08"]))


@query("merge_cubes_disjoint", "SELECT x, y, t, B04 FROM cube_wide", "B04")
def _(t):
    c = t.wide.filter_bands(["B04"])
    return c.filter_temporal(None, "1998").merge_cubes(c.filter_temporal("1998", "2100"))


@query("cube_cube_operators", "SELECT x, y, t, (B08 - B04) / (B08 + B04) AS value FROM cube_wide", "value")
def _(t):
    n, r = t.wide.band("nir"), t.wide.band("red")
    return (n - r) / (n + r)


_NEAREST = """SELECT x, y, bands, t, arg_min(CASE WHEN {ok} THEN v END, CASE WHEN {ok} THEN abs(epoch_us(t) - epoch_us(st)) * 2 + CASE WHEN st > t THEN 1 ELSE 0 END END) AS value FROM (
SELECT p.x, p.y, p.bands, g.t, s.t AS st, s.value AS v FROM (SELECT DISTINCT x, y, bands FROM cube_long) p
CROSS JOIN (SELECT DISTINCT date_trunc('day', t)::TIMESTAMP AS t FROM cube_long) g JOIN cube_long s ON s.x = p.x AND s.y = p.y AND s.bands = p.bands) c GROUP BY x, y, bands, t"""


@query("resample_cube_temporal", _NEAREST.format(ok="true"), "value")
def _(t):
    return t.long.resample_cube_temporal(t.daily)


@query("resample_cube_temporal_valid_within", _NEAREST.format(ok="v IS NOT NULL AND abs(epoch_us(t) - epoch_us(st)) <= 1.5 * 86400e6"), "value")
def _(t):
    return t.long.resample_cube_temporal(t.daily, valid_within=1.5)


_GRID = "(SELECT min(x) - 0.5 AS w, max(x) + 0.5 AS e, min(y) - 0.5 AS s, max(y) + 0.5 AS n FROM cube_static) g"
# target cell k covers w + 2.5 k .. w + 2.5 (k + 1); rows are counted from the top
_CELLS = """(SELECT g.w + 2.5 * (k.i + 0.5) AS cx, g.n - ceil((g.n - g.s) / 2.5) * 2.5 + 2.5 * (l.i + 0.5) AS cy
FROM """ + _GRID + """, (SELECT unnest(range(0, 200)) AS i) k, (SELECT unnest(range(0, 20000)) AS i) l
WHERE k.i < ceil((g.e - g.w) / 2.5) AND l.i < ceil((g.n - g.s) / 2.5)) c"""


def _resample(method: str, agg: str, on: str) -> None:
    @query(f"resample_spatial_{method}", f"SELECT c.cx AS x, c.cy AS y, {agg} AS elev FROM {_CELLS} JOIN cube_static p ON {on} GROUP BY c.cx, c.cy", "x y elev")
    def _(t):
        return t.static.resample_spatial(2.5, method=method)


_TOUCH = "p.x + 0.5 > c.cx - 1.25 AND p.x - 0.5 < c.cx + 1.25 AND p.y + 0.5 > c.cy - 1.25 AND p.y - 0.5 < c.cy + 1.25"
_W = "(least(p.x + 0.5, c.cx + 1.25) - greatest(p.x - 0.5, c.cx - 1.25)) * (least(p.y + 0.5, c.cy + 1.25) - greatest(p.y - 0.5, c.cy - 1.25))"
_TENT = "greatest(1 - abs(c.cx - p.x) / 2.5, 0) * greatest(1 - abs(c.cy - p.y) / 2.5, 0)"


def _cubic_sql(d: str) -> str:
    return f"(CASE WHEN {d} <= 1 THEN 1.5 * {d} * {d} * {d} - 2.5 * {d} * {d} + 1 WHEN {d} < 2 THEN -0.5 * {d} * {d} * {d} + 2.5 * {d} * {d} - 4 * {d} + 2 ELSE 0 END)"


def _spline_sql(d: str) -> str:
    return f"(CASE WHEN {d} <= 1 THEN 2.0 / 3 - {d} * {d} + {d} * {d} * {d} / 2 WHEN {d} < 2 THEN (2 - {d}) * (2 - {d}) * (2 - {d}) / 6 ELSE 0 END)"


def _lanczos_sql(d: str) -> str:
    return f"(CASE WHEN {d} = 0 THEN 1 WHEN {d} < 3 THEN 3 * sin(pi() * {d}) * sin(pi() * {d} / 3) / (pi() * pi() * {d} * {d}) ELSE 0 END)"


_DX, _DY = "(abs(c.cx - p.x) / 2.5)", "(abs(c.cy - p.y) / 2.5)"
_resample("near", "max(p.elev)", "c.cx >= p.x - 0.5 AND c.cx < p.x + 0.5 AND c.cy >= p.y - 0.5 AND c.cy < p.y + 0.5")
_resample("average", f"sum(p.elev * {_W}) / sum({_W})", _TOUCH)
_resample("sum", f"sum(p.elev * {_W})", _TOUCH)
_resample("rms", f"sqrt(sum(p.elev * p.elev * {_W}) / sum({_W}))", _TOUCH)
_resample("min", "min(p.elev)", _TOUCH)
_resample("max", "max(p.elev)", _TOUCH)
_resample("med", "median(p.elev)", _TOUCH)
_resample("q1", "quantile_cont(p.elev, 0.25)", _TOUCH)
_resample("q3", "quantile_cont(p.elev, 0.75)", _TOUCH)
_resample("bilinear", f"sum(p.elev * {_TENT}) / sum({_TENT})", f"{_TENT} > 0")
for _m, _f in (("cubic", _cubic_sql), ("cubicspline", _spline_sql), ("lanczos", _lanczos_sql)):
    _k = f"({_f(_DX)} * {_f(_DY)})"
    _resample(_m, f"sum(p.elev * {_k}) / sum({_k})", f"{_DX} < 3 AND {_DY} < 3 AND {_k} <> 0")


@query("resample_spatial_mode", f"""SELECT x, y, arg_max(elev, n * 1000 - elev) AS elev FROM (
SELECT c.cx AS x, c.cy AS y, floor(p.elev / 2000) AS elev, count(*) AS n FROM {_CELLS} JOIN cube_static p ON {_TOUCH} GROUP BY 1, 2, 3) m GROUP BY x, y""", "x y elev")
def _(t):
    return t.static.apply(lambda v: F.floor(v / 2000)).resample_spatial(2.5, method="mode")


@query("resample_spatial_reproject", """SELECT count(*) AS n, count(DISTINCT elev) AS distinct_values, min(elev) AS low, max(elev) AS high FROM cube_static""", "low high")
def _(t):
    # half the pixel size near the equator: every source pixel is taken by a target cell at least once
    df = t.static._new(t.static.df.withColumns({"x": F.col("x").cast("double"), "y": (F.col("y") % 80).cast("double")}))
    warped = Cube.of(df.df, temporal=(), bands=["elev"], band_dim=None, crs=4326).resample_spatial(50000.0, projection=3857)
    seen = warped.df.select("elev").distinct()
    return t.static.df.agg(F.count(F.lit(1)).alias("n")).withColumns(
        {n: seen.agg(f("elev").alias("v")).scalar() for n, f in (("distinct_values", F.count), ("low", F.min), ("high", F.max))})


# The static cube read as degrees: pixel p covers lon x +- 0.5, lat y +- 0.5; its outline in Mercator metres is a rectangle.
_RADIUS = "6378137.0"
_DEGREES = f"""(SELECT x, y, elev, radians(x - 0.5) * {_RADIUS} AS w, radians(x + 0.5) * {_RADIUS} AS e,
ln(tan(pi() / 4 + radians(y - 0.5) / 2)) * {_RADIUS} AS s, ln(tan(pi() / 4 + radians(y + 0.5) / 2)) * {_RADIUS} AS n
FROM (SELECT x, y % 80 AS y, elev FROM cube_static) m)"""
# target cells of 150 km by 90 km, counted from the upper-left corner of the extent
_METRE_CELLS = f"""(SELECT g.w + 150000.0 * k.i AS cw, g.w + 150000.0 * (k.i + 1) AS ce, g.o + 90000.0 * l.i AS cs, g.o + 90000.0 * (l.i + 1) AS cn FROM (
SELECT min(w) AS w, max(e) AS e, max(n) AS n, max(n) - ceil((max(n) - min(s)) / 90000.0 - 1e-9) * 90000.0 AS o FROM {_DEGREES} d) g,
(SELECT unnest(range(0, 200)) AS i) k, (SELECT unnest(range(0, 400)) AS i) l
WHERE k.i < ceil((g.e - g.w) / 150000.0 - 1e-9) AND l.i < ceil((g.n - g.o) / 90000.0 - 1e-9)) c"""
_SHARED = "(least(p.e, c.ce) - greatest(p.w, c.cw)) * (least(p.n, c.cn) - greatest(p.s, c.cs))"


def _degrees(t):
    df = t.static.df.withColumns({"x": F.col("x").cast("double"), "y": (F.col("y") % 80).cast("double")})
    return Cube.of(df, temporal=(), bands=["elev"], band_dim=None, crs=4326)


def _resample_metres(method: str, agg: str) -> None:
    @query(f"resample_spatial_reproject_{method}", f"""SELECT (c.cw + c.ce) / 2 AS x, (c.cs + c.cn) / 2 AS y, {agg} AS elev FROM {_METRE_CELLS} JOIN {_DEGREES} p
ON p.e > c.cw + 1e-3 AND p.w < c.ce - 1e-3 AND p.n > c.cs + 1e-3 AND p.s < c.cn - 1e-3 GROUP BY c.cw, c.ce, c.cs, c.cn""", "x:3 y:3 elev:5")
    def _(t):
        return _degrees(t).resample_spatial([150000.0, 90000.0], projection=3857, method=method)


_resample_metres("average", f"sum(p.elev * {_SHARED}) / sum({_SHARED})")
_resample_metres("sum", f"sum(p.elev * {_SHARED} / ((p.e - p.w) * (p.n - p.s)))")
_resample_metres("rms", f"sqrt(sum(p.elev * p.elev * {_SHARED}) / sum({_SHARED}))")
_resample_metres("max", "max(p.elev)")
_resample_metres("med", "median(p.elev)")


@query("resample_spatial_reproject_near", f"""SELECT (c.cw + c.ce) / 2 AS x, (c.cs + c.cn) / 2 AS y, p.elev FROM {_METRE_CELLS} JOIN {_DEGREES} p
ON (c.cw + c.ce) / 2 >= p.w AND (c.cw + c.ce) / 2 < p.e AND (c.cs + c.cn) / 2 >= p.s AND (c.cs + c.cn) / 2 < p.n""", "x:3 y:3 elev")
def _(t):
    return _degrees(t).resample_spatial([150000.0, 90000.0], projection=3857, method="near")


@query("resample_cube_spatial", """SELECT c.cx AS x, c.cy AS y, avg(p.elev) AS elev FROM (
SELECT DISTINCT x + 0.25 AS cx, y + 0.25 AS cy FROM cube_wide) c JOIN cube_static p ON p.x = c.cx - 0.25 AND p.y = c.cy - 0.25 GROUP BY 1, 2""", "x y elev")
def _(t):
    return t.static.resample_cube_spatial(t.shifted)


# -- 2.11 band math and indices


@query("band_arithmetic", """SELECT x, y, t, CASE WHEN ((B08 - B04) / 2 + 3 * B04 ** 2 - (-B08)) > 100 AND NOT B04 < 5 THEN true
WHEN ((B08 - B04) / 2 + 3 * B04 ** 2 - (-B08)) > 100 THEN false ELSE false END AS value FROM cube_wide""")
def _(t):
    c = t.wide
    n, r = c.b("nir"), c.b("red")
    return ((((n - r) / 2 + 3 * r**2 - (-n)) > 100) & ~(r < 5)).cube()


@query("ndvi", "SELECT x, y, t, (B08 - B04) / (B08 + B04) AS value FROM cube_wide", "value")
def _(t):
    return t.wide.ndvi()


@query("ndvi_target_band", "SELECT x, y, t, B02, B04, B08, (B08 - B04) / (B08 + B04) AS ndvi FROM cube_wide", "B02 B04 B08 ndvi")
def _(t):
    return t.optical.ndvi(target_band="ndvi")


@query("compute_index", "SELECT x, y, t, 2.5 * (B08 - B04) / NULLIF(B08 + 6.0 * B04 - 7.5 * B02 + 1.0, 0) AS EVI FROM cube_wide", "EVI")
def _(t):
    return t.wide.compute_index("EVI")


@query("append_index", "SELECT x, y, t, B02, B04, B08, (B08 - B04) / (B08 + B04) AS NDVI FROM cube_wide", "B02 B04 B08 NDVI")
def _(t):
    return t.optical.append_index("NDVI")


_MAP = {"N": "B08", "R": "B04", "G": "B02", "S1": "B02", "S2": "B04", "RE1": "B02", "RE2": "B04", "RE3": "B08", "B": "B02"}


@query("compute_indices", """SELECT x, y, t, (B08 - B04) / (B08 + B04) AS NDVI, sqrt(B04 * B04 + B08 * B08) AS BI_B08, sqrt(B04 * B04 + B08 * B08 + B02 * B02) / 3 AS BI2,
(B08 - B02) / (B08 + B02) AS NDRE1, (B08 - B04) / (B08 + B04) AS NDRE2, (B08 - B02) / (B08 + B02) AS NDRE5, (B08 - B04) / (B08 + B04) AS LSWI_B12,
B08 * atan((B08 - B02) / (1.610 - 0.842)) AS ABDI1, B08 * atan((B08 - B04) / (2.190 - 0.842)) AS ABDI2,
acos(greatest(-1.0, least(1.0, (a + b - c) / (2 * sqrt(a) * sqrt(b))))) / pi() AS ANIR
FROM (SELECT *, 0.1682 ** 2 + (B08 - B04) ** 2 AS a, 0.7772 ** 2 + (B02 - B08) ** 2 AS b, 0.9454 ** 2 + (B02 - B04) ** 2 AS c FROM cube_wide) q""",
       "NDVI BI_B08 BI2 NDRE1 NDRE2 NDRE5 LSWI_B12 ABDI1 ABDI2 ANIR:5")
def _(t):
    return t.wide.compute_indices(["NDVI", "BI_B08", "BI2", "NDRE1", "NDRE2", "NDRE5", "LSWI_B12", "ABDI1", "ABDI2", "ANIR"], variable_map=_MAP)


@query("append_indices", "SELECT x, y, t, B02, B04, B08, (B08 - B04) / (B08 + B04) AS NDVI, sqrt(B04 * B04 + B08 * B08) AS BI_B08 FROM cube_wide", "B02 B04 B08 NDVI BI_B08")
def _(t):
    return t.optical.append_indices(["NDVI", "BI_B08"])


@query("compute_and_rescale_indices", "SELECT x, y, t, (greatest(-1.0, least(1.0, (B08 - B04) / (B08 + B04))) + 1) / 2.0 * 250 AS NDVI, sqrt(B04 * B04 + B08 * B08) AS BI_B08 FROM cube_wide", "NDVI BI_B08")
def _(t):
    return t.wide.compute_and_rescale_indices({"collection": {"input_range": None, "output_range": None}, "indices": {
        "NDVI": {"input_range": [-1, 1], "output_range": [0, 250]}, "BI_B08": {"input_range": None, "output_range": None}}})


@query("append_and_rescale_indices", """SELECT x, y, t, greatest(0.0, least(80.0, B04)) / 80 * 250 AS B04, greatest(0.0, least(80.0, B08)) / 80 * 250 AS B08,
(greatest(-1.0, least(1.0, (B08 - B04) / (B08 + B04))) + 1) / 2.0 * 250 AS NDVI FROM cube_wide""", "B04 B08 NDVI")
def _(t):
    return t.wide.filter_bands(["B04", "B08"]).append_and_rescale_indices({"collection": {"input_range": [0, 80], "output_range": [0, 250]},
                                                                          "indices": {"NDVI": {"input_range": [-1, 1], "output_range": [0, 250]}}})


_EACH = {
    "NDVI": ("Normalized Difference Vegetation Index", "vegetation", "(B08 - B04) / (B08 + B04)"),
    "EVI": ("Enhanced Vegetation Index", "vegetation", "2.5 * (B08 - B04) / NULLIF(B08 + 6.0 * B04 - 7.5 * B02 + 1.0, 0)"),
    "ANIR": ("Angle at Near InfraRed", "vegetation", "acos(greatest(-1.0, least(1.0, (a + b - c) / (2 * sqrt(a) * sqrt(b))))) / pi()"),
    "NDRE1": ("Normalized Difference Red Edge 1", "vegetation", "(B08 - B02) / (B08 + B02)"),
    "NDRE2": ("Normalized Difference Red Edge 2", "vegetation", "(B08 - B04) / (B08 + B04)"),
    "NDRE5": ("Normalized Difference Red Edge 5", "vegetation", "(B08 - B02) / (B08 + B02)"),
    "BI2": ("Brightness index 2", "soil", "sqrt(B04 * B04 + B08 * B08 + B02 * B02) / 3"),
    "BI_B08": ("Brightness index B08", "soil", "sqrt(B04 * B04 + B08 * B08)"),
    "LSWI_B12": ("Sentinel-2 land surface water index", "water", "(B08 - B04) / (B08 + B04)"),
    "ABDI1": ("Angle based drought index 1", "water", "B08 * atan((B08 - B02) / (1.610 - 0.842))"),
    "ABDI2": ("Angle based drought index 2", "water", "B08 * atan((B08 - B04) / (2.190 - 0.842))"),
    "NDWI": ("Normalized Difference Water Index", "water", "(B02 - B08) / (B02 + B08)"),
    "MNDWI": ("Modified Normalized Difference Water Index", "water", "(B02 - B02) / (B02 + B02)"),
    "NDMI": ("Normalized Difference Moisture Index", "vegetation", "(B08 - B02) / (B08 + B02)"),
    "NBR": ("Normalized Burn Ratio", "burn", "(B08 - B04) / (B08 + B04)"),
    "GNDVI": ("Green Normalized Difference Vegetation Index", "vegetation", "(B08 - B02) / (B08 + B02)"),
    "NDBI": ("Normalized Difference Built-Up Index", "urban", "(B02 - B08) / (B02 + B08)"),
    "NDSI": ("Normalized Difference Snow Index", "snow", "(B02 - B02) / (B02 + B02)"),
    "SAVI": ("Soil-Adjusted Vegetation Index", "vegetation", "1.5 * (B08 - B04) / (B08 + B04 + 0.5)"),
    "EVI2": ("Two-Band Enhanced Vegetation Index", "vegetation", "2.5 * (B08 - B04) / (B08 + 2.4 * B04 + 1.0)"),
}
_TRIANGLE_SIDES = "(SELECT *, 0.1682 ** 2 + (B08 - B04) ** 2 AS a, 0.7772 ** 2 + (B02 - B08) ** 2 AS b, 0.9454 ** 2 + (B02 - B04) ** 2 AS c FROM cube_wide) q"


@query("index_catalogue", " UNION ALL ".join(
    f"SELECT '{n}' AS name, '{long}' AS long_name, '{kind}' AS kind, avg({f}) AS mean_value FROM {_TRIANGLE_SIDES}" for n, (long, kind, f) in _EACH.items()), "mean_value:5")
def _(t):
    """Mean of every catalogued index over the cube, next to its catalogue row."""
    from ..functions import indices as ix

    means = t.wide.compute_indices(ix.list_indices(), variable_map=_MAP).to_long().df.groupBy("bands").agg(F.avg("value").alias("mean_value"))
    return index_table(t.spark).join(means.withColumnRenamed("bands", "name"), "name").select("name", "long_name", "kind", "mean_value")


# -- 2.15 comparison and run tables


@query("cube_differences", """SELECT t, bands, count(*) FILTER (WHERE bad) AS diff_count, count(e) AS total_count, min(d) AS diff_min, max(d) AS diff_max, avg(d) AS diff_mean, var_pop(d) AS diff_var,
min(x) FILTER (WHERE bad) AS min_x, min(y) FILTER (WHERE bad) AS min_y, max(x) FILTER (WHERE bad) AS max_x, max(y) FILTER (WHERE bad) AS max_y, 100.0 * count(*) FILTER (WHERE bad) / NULLIF(count(e), 0) AS diff_share
FROM (SELECT *, CASE WHEN bad THEN abs(a - e) END AS d FROM (SELECT *, coalesce(abs(a - e) > 1e-6 + 1e-6 * abs(e), (a IS NULL) <> (e IS NULL)) AS bad FROM (
SELECT x, y, t, 'B02' AS bands, B02 AS e, CASE WHEN x < 3 THEN B02 + 1 ELSE B02 END AS a FROM cube_wide
UNION ALL SELECT x, y, t, 'B04' AS bands, B04 AS e, CASE WHEN x < 3 THEN B04 + 0.5 WHEN x = 9 THEN NULL ELSE B04 END AS a FROM cube_wide) u) v) w
GROUP BY t, bands HAVING count(*) FILTER (WHERE bad) > 0""", "diff_min diff_max diff_mean diff_var diff_share")
def _(t):
    c = t.wide.filter_bands(["B02", "B04"])
    changed = c._new(c.df.withColumns({
        "B02": F.when(F.col("x") < 3, F.col("B02") + 1).otherwise(F.col("B02")),
        "B04": F.when(F.col("x") < 3, F.col("B04") + 0.5).when(F.col("x") == 9, None).otherwise(F.col("B04"))}))
    return compare.cube_differences(changed, c)


@query("run_table_counts", "SELECT status, count(*) AS n FROM runs GROUP BY status")
def _(t):
    return runs.count_by_status(runs.normalize_runs(t.view("runs")))


@query("run_table_counts_some", "SELECT status, count(*) AS n FROM runs WHERE status IN ('finished', 'running') GROUP BY status")
def _(t):
    return runs.count_by_status(t.view("runs"), ["finished", "running"])


@query("run_table_select", "SELECT id, status, costs FROM runs WHERE status IN ('running', 'not_started') ORDER BY id LIMIT 100", "costs")
def _(t):
    return runs.get_by_status(t.view("runs").drop("start_time"), ["running", "not_started"], max=100)


@query("run_table_update", """SELECT r.id, CASE WHEN r.id % 7 = 0 THEN 'canceled' ELSE r.status END AS status, CASE WHEN r.id % 7 = 0 AND r.id % 2 = 0 THEN r.costs + 1 ELSE r.costs END AS costs FROM runs r""", "costs")
def _(t):
    rows = t.view("runs").drop("start_time")
    changes = rows.where("id % 7 = 0").select("id", F.lit("canceled").alias("status"), F.when(F.col("id") % 2 == 0, F.col("costs") + 1).alias("costs"))
    unknown = rows.select((-F.col("id") - 1).alias("id"), F.lit("lost").alias("status"), F.lit(0.0).alias("costs"))
    return runs.update_runs(rows, changes.unionByName(unknown))


@query("run_table_get_by_indices", "SELECT id, status, costs FROM runs WHERE id IN (1, 5, 8, 13, 999999999)", "costs")
def _(t):
    return runs.get_by_ids(t.view("runs").drop("start_time"), [1, 5, 8, 13, 999999999])


@query("parameter_rows", """SELECT o_orderkey AS id, coalesce(o_orderpriority, '5-LOW') AS priority, 10 AS tile, CAST(CASE WHEN o_orderkey % 3 = 0 THEN 0.5 ELSE o_totalprice / 1000 END AS DOUBLE) AS scale FROM orders""", "scale")
def _(t):
    rows = t.table("orders").select(F.col("o_orderkey").alias("id"), F.col("o_orderpriority").alias("priority"),
                                    F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice") / 1000).alias("scale"))
    return runs.with_parameters(rows, {"priority": "string", "tile": "int", "scale": "double"}, {"priority": "5-LOW", "tile": 10, "scale": 0.5})


# -- 2.14 user functions


@query("apply_timeseries", "SELECT x, y, t, B04 - avg(B04) OVER (PARTITION BY x, y) AS B04, B08 - avg(B08) OVER (PARTITION BY x, y) AS B08 FROM cube_wide", "B04 B08")
def _(t):
    return t.wide.filter_bands(["B04", "B08"]).apply_timeseries(lambda series, context: series - series.mean())


@query("run_udf", "SELECT x, y, t, B04 * 3 + 1 AS B04, B08 * 3 + 1 AS B08 FROM cube_wide", "B04 B08")
def _(t):
    def apply_datacube(cube, context):
        return cube * context["factor"] + 1

    return t.wide.filter_bands(["B04", "B08"]).run_udf({"apply_datacube": apply_datacube}, {"factor": 3}, size={"x": 4, "y": 4})


@query("apply_datacube", "SELECT x, y, t, B04 - B08 AS B04, B04 + B08 AS B08 FROM cube_wide", "B04 B08")
def _(t):
    import numpy as np

    def mix(cube, context):  # dims t, bands, y, x
        return np.stack([cube[:, 0] - cube[:, 1], cube[:, 0] + cube[:, 1]], axis=1)

    return t.wide.filter_bands(["B04", "B08"]).apply_datacube(mix, {"x": 5, "y": 5})


@query("apply_metadata", "SELECT x, y, t, B04 + B08 AS total FROM cube_wide", "total")
def _(t):
    def apply_metadata(schema, context):
        return schema.with_bands([context["name"]])

    def apply_datacube(cube, context):
        return cube.sum(axis=1, keepdims=True)

    return t.wide.filter_bands(["B04", "B08"]).run_udf({"apply_metadata": apply_metadata, "apply_datacube": apply_datacube}, {"name": "total"}, size={"x": 5, "y": 5})


@query("apply_vectorcube", f"""SELECT geom_id, avg(m) AS level, count(*) AS dates FROM ({_zonal("avg(z.B04) AS m")}) a WHERE t IS NOT NULL GROUP BY geom_id""", "level")
def _(t):
    def apply_vectorcube(geometries, values, context):
        out = values.dropna(subset=["t"]).groupby("geom_id").agg(level=("B04", "mean"), dates=("B04", "size")).reset_index()
        return geometries, out

    zonal = t.shifted.filter_bands(["B04"]).aggregate_spatial(t.zones(), "mean")
    return udf.apply_vectorcube(zonal, apply_vectorcube, "geom_id long, level double, dates long")


@query("reduce_bands_udf", "SELECT x, y, t, B04 * 2 - B08 AS value FROM cube_wide", "value")
def _(t):
    import pandas as pd

    def combine(r: pd.Series, n: pd.Series) -> pd.Series:
        return r * 2 - n

    return t.wide.filter_bands(["B04", "B08"]).reduce_bands_udf(combine)


@query("reduce_temporal_udf", "SELECT x, y, max(B04) - min(B04) AS B04, max(B08) - min(B08) AS B08 FROM cube_wide GROUP BY x, y", "B04 B08")
def _(t):
    return t.wide.filter_bands(["B04", "B08"]).reduce_temporal_udf(lambda v: v.max() - v.min())


@query("user_defined_process", "SELECT x, y, max((B08 - B04) / (B08 + B04)) AS value FROM cube_wide WHERE t >= TIMESTAMP '1997-01-01' AND t < TIMESTAMP '1999-01-01' GROUP BY x, y", "value")
def _(t):
    def greenest(cube, start, end="1999"):
        return cube.filter_temporal(start, end).ndvi().max_time()

    udf.processes.save("greenest", greenest, defaults={"start": "1996"})
    return udf.processes.run("greenest", t.wide, start="1997")


@query("inspect", "SELECT x, y, t, B02, B04, B08 FROM cube_wide", OPT)
def _(t):
    cube, _ = udf.inspect_cube(t.optical, "after load", code="Check")
    return cube

