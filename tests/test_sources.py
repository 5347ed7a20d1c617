import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cubeloom import Cube
from cubeloom import errors as err
from cubeloom.operators import learn, runs, udf
from cubeloom.operators.vector import Geometries, VectorCube
from cubeloom.schema import Band, CubeSchema, Dim
from cubeloom.sources import files, stac
from cubeloom.sources.geojson import load_geojson


def square(x, y, **props):
    ring = [[x, y], [x + 1, y], [x + 1, y + 1], [x, y + 1], [x, y]]
    return {"type": "Feature", "geometry": {"type": "Polygon", "coordinates": [ring]}, "properties": props}


def write(tmp_path, doc):
    path = tmp_path / "doc.geojson"
    path.write_text(json.dumps(doc))
    return str(path)


def table(cube):
    return sorted((r.properties, r.value) for r in cube.df.collect())


def test_geojson_properties(spark, tmp_path):
    doc = {"type": "FeatureCollection", "features": [square(0, 0, a=1, v=[1, 2, 3]), square(2, 0, a=2.5, b=7, v=[4])]}
    path = write(tmp_path, doc)
    assert load_geojson(spark, path).df.count() == 2
    assert table(load_geojson(spark, path, ["a"])) == [("a", 1.0), ("a", 2.5)]
    many = load_geojson(spark, path, ["a", "b"]).df.collect()
    assert sorted((r.properties, str(r.value)) for r in many) == [("a", "1.0"), ("a", "2.5"), ("b", "7.0"), ("b", "None")]
    arrays = load_geojson(spark, path, ["v"]).df.collect()
    assert sorted((r.properties, str(r.value)) for r in arrays) == [("0", "1.0"), ("0", "4.0"), ("1", "2.0"), ("1", "None"), ("2", "3.0"), ("2", "None")]


@pytest.mark.parametrize("geometry, n", [
    ({"type": "Point", "coordinates": [1, 2]}, 1), ({"type": "MultiPoint", "coordinates": [[1, 2], [3, 4]]}, 2),
    ({"type": "LineString", "coordinates": [[1, 2], [3, 4]]}, 2), ({"type": "MultiLineString", "coordinates": [[[1, 2], [3, 4]], [[5, 6], [7, 8]]]}, 4),
    ({"type": "MultiPolygon", "coordinates": [[[[0, 0], [1, 0], [1, 1], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]]}, 8), ({"type": "Polygon", "coordinates": []}, 0)])
def test_geometry_types(spark, tmp_path, geometry, n):
    row = load_geojson(spark, write(tmp_path, geometry)).df.select(F.size(F.flatten("parts")).alias("n"), "geom_type").first()
    assert (row.n, row.geom_type) == (n, geometry["type"])


def test_geometry_collection_is_refused(spark, tmp_path):
    path = write(tmp_path, {"type": "GeometryCollection", "geometries": []})
    with pytest.raises(Exception, match="UnsupportedGeometry"):
        load_geojson(spark, path).df.collect()


def test_stac_bands_and_selection(spark, tmp_path):
    def item(name, year, cloud, bbox):
        bands = [{"name": "B02", "common_name": "blue", "center_wavelength": 0.49}, {"name": name}]
        return {"type": "Feature", "id": f"i{year}", "bbox": bbox, "properties": {"datetime": f"{year}-05-01T00:00:00Z", "eo:cloud_cover": cloud, "eo:bands": bands},
                "assets": {"data": {"href": f"/nowhere/{year}.parquet", "type": "application/x-parquet"}, "thumb": {"href": "/nowhere/t.png", "type": "image/png"}}}

    lines = [item("B03", 2019, 10, [0, 0, 1, 1]), item("B04", 2020, 50, [5, 5, 6, 6]), item("B02", 2021, 90, [0, 0, 0, 1, 1, 9])]
    (tmp_path / "items.json").write_text("\n".join(json.dumps(i) for i in lines))
    items = stac.read_items(spark, str(tmp_path / "items.json"))
    assert [b.name for b in stac.bands_of(items)] == ["B02", "B03", "B04"]
    assert stac.bands_of(items)[0] == Band("B02", "blue", 0.49)
    ids = lambda df: sorted(r.id for r in df.select("id").collect())
    assert ids(stac.select_items(items, [0, 0, 2, 2])) == ["i2019", "i2021"]
    assert ids(stac.select_items(items, temporal_extent=("2019-06", "2021"))) == ["i2020"]
    cloudy = F.col("properties.`eo:cloud_cover`") <= 50
    assert [r.href for r in stac.asset_paths(stac.select_items(items, [0, 0, 2, 2], properties=[cloudy])).collect()] == ["/nowhere/2019.parquet"]
    with pytest.raises(FileNotFoundError):
        stac.load_stac(spark, str(tmp_path / "items.json"), [80, 80, 81, 81])


def test_collection_item_assets(spark, tmp_path):
    doc = {"type": "Collection", "id": "c", "item_assets": {n: {"bands": [{"name": n}]} for n in ("dew", "precip", "rad", "wind")}}
    (tmp_path / "c.json").write_text(json.dumps(doc))
    assert [b.name for b in stac.bands_of(stac.read_items(spark, str(tmp_path / "c.json"), multiline=True))] == ["dew", "precip", "rad", "wind"]


def test_formats(spark, tmp_path, txy):
    cube = txy()
    for name in ("Parquet", "CSV", "json", "ORC"):
        path = str(tmp_path / name)
        assert files.save_result(cube, path, name)
        assert files.load_uploaded_files(spark, [path], name).count() == cube.df.count()
    with pytest.raises(err.FormatUnsuitable):
        files.save_result(cube, str(tmp_path / "x"), "gtiff")
    with pytest.raises(err.FormatUnsuitable):
        files.save_result(cube, str(tmp_path / "x"), "geojson")
    with pytest.raises(Exception):
        files.load_uploaded_files(spark, [str(tmp_path / "missing")], "parquet").collect()


def test_layout_prunes(spark, tmp_path, txy):
    path = str(tmp_path / "cube")
    files.save_cube_layout(txy(), path)
    back = spark.read.parquet(path)
    assert back.count() == txy().df.count() and back.select("month").distinct().count() == 4


# -- zonal series to tables


def series(spark, rows, bands=("a", "b", "c")):
    df = spark.createDataFrame(rows, "geom_id long, t string, " + ", ".join(f"{b} double" for b in bands))
    schema = CubeSchema((Dim("geom_id", "geometry"), Dim("t", "temporal")), tuple(Band(b) for b in bands), "bands")
    geoms = Geometries.from_shapes(spark, [{"type": "Point", "id": i, "coordinates": (0, 0)} for i in (0, 1)])
    return VectorCube(df, schema, geoms)


def test_timeseries_tables(spark):
    z = series(spark, [(0, "2019-01", 1.0, 2.0, 3.0), (1, "2019-01", 4.0, 5.0, 6.0), (0, "2019-02", None, None, None), (1, "2019-02", 7.0, 8.0, 9.0)])
    by_date = {r.t: r for r in z.timeseries_table([0, 1]).collect()}
    assert by_date["2019-01"]["1_c"] == 6.0 and by_date["2019-02"]["0_a"] is None
    by_polygon = {r.geom_id: r for r in z.timeseries_table(["2019-01", "2019-02"], index="polygon").collect()}
    assert by_polygon[1]["2019-02_b"] == 8.0
    single = series(spark, [(0, "2019-01", 1.0)], ("a",))
    assert single.timeseries_table([0]).columns == ["t", "0"]
    assert single.timeseries_table([0], auto_collapse=False).columns == ["t", "0_a"]
    with pytest.raises(err.InvalidTimeSeries):
        z.timeseries_table([])
    with pytest.raises(ValueError):
        z.timeseries_table([0], index="band")


def test_timeseries_tables_find_their_labels(spark):
    two = series(spark, [(0, "2019-02", 1.0, 2.0, 3.0), (1, "2019-01", 4.0, 5.0, 6.0), (1, "2019-02", None, 8.0, 9.0)])
    assert two.timeseries_table().columns == ["t", *[f"{i}_{b}" for i in (0, 1) for b in "abc"]]
    got = {r.geom_id: r for r in two.timeseries_table(index="polygon").collect()}
    assert two.timeseries_table(index="polygon").columns == ["geom_id", *[f"{d}_{b}" for d in ("2019-01", "2019-02") for b in "abc"]]
    assert got[1]["2019-02_c"] == 9.0 and got[0]["2019-01_a"] is None and got[1]["2019-02_a"] is None
    one = series(spark, [(1, "2019-01", 1.0, 2.0, 3.0), (1, "2019-02", None, None, None)])
    assert one.timeseries_table().columns == ["t", "a", "b", "c"]
    assert sorted(map(tuple, one.timeseries_table().collect())) == [("2019-01", 1.0, 2.0, 3.0), ("2019-02", None, None, None)]
    assert one.timeseries_table(auto_collapse=False).columns == ["t", "1_a", "1_b", "1_c"]
    assert one.timeseries_table(index="polygon").columns == ["geom_id", *[f"{d}_{b}" for d in ("2019-01", "2019-02") for b in "abc"]]
    lone = series(spark, [(1, "2019-01", 1.0)], ("a",))
    assert lone.timeseries_table().columns == ["t", "a"] and lone.timeseries_table(index="polygon").columns == ["geom_id", "2019-01"]
    assert one.timeseries_table(strict=True).count() == 2


@pytest.mark.parametrize("rows, says", [
    ([], "empty"), ([(None, "2019-01", None), (None, "2019-02", None)], "any date"), ([(None, "2019-01", None), (1, "2019-02", 1.0)], "some dates"),
    ([(0, "2019-01", 1.0), (0, "2019-02", 1.0), (1, "2019-02", 1.0)], "between 1 and 2"), ([(0, "2019-01", None), (0, "2019-02", None)], "no value")])
def test_strict_timeseries(spark, rows, says):
    with pytest.raises(err.InvalidTimeSeries, match=says):
        series(spark, rows, ("a",)).timeseries_table(strict=True)


def test_timeseries_labels_are_bounded_by_the_session(spark):
    z = series(spark, [(i, "2019-01", 1.0) for i in range(5)], ("a",))
    spark.conf.set("spark.sql.pivotMaxValues", 4)
    try:
        with pytest.raises(err.InvalidTimeSeries, match="name the wanted"):
            z.timeseries_table()
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")
    assert z.timeseries_table().columns == ["t", "0", "1", "2", "3", "4"]


# -- run tables


def test_runs(spark, values):
    df = runs.normalize_runs(spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], "id string, year int"))
    assert values(runs.count_by_status(df)) == [("not_started", 3)]
    changes = spark.createDataFrame([("a", "running", 2.5), ("zz", "error", 1.0)], "id string, status string, costs double")
    after = runs.update_runs(df, changes)
    assert values(after, "id", "status") == [("a", "running"), ("b", "not_started"), ("c", "not_started")]
    assert values(runs.count_by_status(after, ["running"])) == [("running", 1)]
    assert runs.get_by_status(after, ["not_started"], max=1).first().id == "b"
    assert {r.id for r in runs.get_by_ids(after, ["a", "nope"]).collect()} == {"a"}


def test_parameters(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, n int")
    assert [r.n for r in runs.with_parameters(df, {"n": T.IntegerType(), "k": "string"}, {"n": 9, "k": "z"}).orderBy("id").collect()] == [9, 5]
    with pytest.raises(err.MissingParameter):
        runs.with_parameters(df, {"other": "int"})
    with pytest.raises(Exception, match="MissingParameter"):
        runs.with_parameters(df, {"n": "int"}).collect()


# -- user functions, indices, learning


def test_udf_lookup(txy):
    with pytest.raises(err.NoUserFunction):
        txy().run_udf({"something": len})
    with pytest.raises(Exception, match="keep the length"):
        txy().apply_timeseries(lambda s, c: s[:1]).df.collect()

    def apply_timeseries(series, context):
        return series + context["plus"]

    assert txy().run_udf(apply_timeseries, {"plus": 5}).df.agg(F.min("value")).first()[0] == 5.0


def test_block_udf_dims(spark, txy):
    seen = {}

    def apply_datacube(cube, context):
        assert cube.ndim == 4
        return cube - cube.mean(axis=0, keepdims=True)  # along time

    rows = txy(tf=10.0).apply_datacube(apply_datacube, {"x": 1, "y": 2}).df.orderBy("x", "y", "t").collect()
    assert [r.value for r in rows[:4]] == [-15.0, -5.0, 5.0, 15.0] and not seen


def test_processes(txy):
    book = udf.Processes()
    book.save("scale", lambda cube, factor: cube * factor, defaults={})
    assert book.run("scale", txy(), factor=2).df.agg(F.max("value")).first()[0] == 624.0
    with pytest.raises(err.MissingParameter):
        book.run("scale", txy())


def test_inspect(txy):
    cube, seen = udf.inspect_cube(txy(), "look")
    cube.df.collect()
    assert seen.get["rows"] == 24 and seen.get["max_value"] == 312.0


def test_index_mapping(spark):
    from cubeloom.functions import indices as ix

    assert ix.guess_platform("SENTINEL2_L2A_SENTINELHUB") == "sentinel2" and ix.guess_platform("my-landsat-8 set") == "landsat8"
    assert ix.variables(["B02", "B8", "VV"], "Sentinel-2A") == {"B": "B02", "N": "B8"}
    with pytest.raises(err.BandMappingError):
        ix.guess_platform("dem")
    df = spark.createDataFrame([(0, 0, 2.0, 6.0)], "x long, y long, B04 double, B08 double")
    cube = Cube.of(df, temporal=(), bands=["B04", "B08"], collection_id="SENTINEL2")
    assert cube.compute_index("NDVI").df.first().NDVI == 0.5
    with pytest.raises(err.BandMappingError):
        cube.compute_index("EVI")
    with pytest.raises(err.UnknownIndex):
        cube.compute_index("NOPE")
    with pytest.raises(ValueError):
        cube.compute_and_rescale_indices({"collection": {"input_range": [0, 1], "output_range": None}, "indices": {}})
    ix.register_index("DIFF", ("N", "R"), lambda v: v["N"] - v["R"])
    assert cube.compute_index("DIFF").df.first().DIFF == 4.0


def test_curves(spark):
    import math

    rows = [(x, 0, float(k), 3.0 + x * math.exp(-0.4 * k), 1 + 2 * k + 3 * math.sin(k) + 4 * math.cos(k) + x) for x in (1, 2) for k in range(20)]
    df = spark.createDataFrame(rows, "x long, y long, k double, v double, w double")
    cube = Cube.of(df, temporal=(), other=("k",), bands=["v", "w"])
    decay = cube.filter_bands(["v"]).fit_curve([2.5, 1.2, 0.3], lambda k, p: p[0] + p[1] * F.exp(-p[2] * k), "k")
    for r in decay.df.collect():
        assert (r.v_p0, r.v_p1, r.v_p2) == (pytest.approx(3.0, abs=1e-5), pytest.approx(float(r.x), abs=1e-5), pytest.approx(0.4, abs=1e-5))
    linear = lambda k, p: p[0] + p[1] * k + p[2] * F.sin(k) + p[3] * F.cos(k)
    four = cube.filter_bands(["w"]).fit_curve([0.0] * 4, linear, "k")
    got = {r.x: [r.w_p0, r.w_p1, r.w_p2, r.w_p3] for r in four.df.collect()}
    assert got[2] == pytest.approx([3.0, 2.0, 3.0, 4.0])
    grown = cube.filter_bands(["v"]).fit_curve([4.0, 0.2], lambda k, p: p[0] * F.exp(p[1] * k / 10), "k").df.collect()
    assert all(r.v_p0 is not None and r.v_p1 < 0 for r in grown)
    flat = cube.filter_bands(["v"]).fit_curve([0.0, 0.0], lambda k, p: p[0] + p[1], "k").df.collect()
    assert all(r.v_p0 is None and r.v_p1 is None for r in flat)
    holes = cube._new(df.withColumn("w", F.when(F.col("x") + F.col("k") > 1, F.col("w")))).filter_bands(["w"])
    assert {r.x: r.w_p0 is None for r in holes.fit_curve([0.0] * 4, linear, "k", ignore_nodata=False).df.collect()} == {1: True, 2: False}
    assert not any(r.w_p0 is None for r in holes.fit_curve([0.0] * 4, linear, "k").df.collect())
    ahead = cube.filter_bands(["w"]).predict_curve(four, linear, "k", labels=[100.0])
    assert {r.x: r.w for r in ahead.df.collect()}[1] == pytest.approx(2 + 200 + 3 * math.sin(100) + 4 * math.cos(100))


def test_forest(spark, tmp_path):
    rows = [(i % 10, i // 10, float(i % 10), float(i % 7), 1 if i % 10 > 4 else 5) for i in range(200)]
    df = spark.createDataFrame(rows, "x long, y long, a double, b double, cls int")
    model = learn.fit_class_random_forest(df, ["a", "b"], "cls", max_variables="all", num_trees=5, seed=1)
    path = model.save(str(tmp_path / "forest"))
    cube = Cube.of(df.withColumn("a", F.when(F.col("x") != 9, F.col("a"))).drop("cls"), temporal=(), bands=["a", "b"])
    got = {(r.x, r.y): r.value for r in cube.predict_random_forest(learn.RandomForest.load(path)).df.collect()}
    assert len(got) == 200 and all((v is None) if x == 9 else v == (1.0 if x > 4 else 5.0) for (x, _), v in got.items())
    regr = learn.fit_regr_random_forest(df, ["a", "b"], "x", num_trees=5, seed=1)
    assert regr.model.transform(df).where("abs(prediction - x) > 3").count() == 0


def test_geojson_ids_are_kept_and_do_not_change(spark, tmp_path):
    point = '{"type":"Feature",%s"geometry":{"type":"Point","coordinates":[%d,2]},"properties":{"n":%d}}'
    lines = [point % ('"id":"field-a",', 1, 1), point % ('"id":"17",', 2, 2), point % ("", 3, 3), point % ("", 3, 3), point % ("", 4, 4)]
    (tmp_path / "a.geojsonl").write_text("\n".join(lines))
    read = lambda n: {r.geom_id: (r.feature_id, r.minx) for r in load_geojson(spark.newSession() if n else spark, str(tmp_path / "a.geojsonl"), multiline=False).df.repartition(n + 1).collect()}
    first = read(0)
    assert first == read(1) == read(4)
    assert first[17] == ("17", 2.0) and sorted(k for k in first if k >= 0) == [17]
    assert sorted((v[0] or "", v[1]) for v in first.values()) in ([("", 3.0), ("", 4.0), ("17", 2.0), ("field-a", 1.0)], [("", 3.0), ("", 3.0), ("", 4.0), ("17", 2.0), ("field-a", 1.0)])
    body = ",".join(lines)
    (tmp_path / "b.geojson").write_text('{"type":"FeatureCollection","features":[%s]}' % body)
    whole = load_geojson(spark, str(tmp_path / "b.geojson")).df
    assert whole.select("geom_id").distinct().count() == 5  # equal features differ by their place in the document
