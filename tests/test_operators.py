import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cubeloom import Band, Cube
from cubeloom import errors as err
from cubeloom.operators import compare, focal
from cubeloom.operators.filters import bbox_dict, normalize_longitudes
from cubeloom.operators.resample import _clipped_area
from cubeloom.operators.vector import Geometries, _trapezoids, box_geometry, split_area


# -- series of the small label cube


def test_mean_over_time(txy, values):
    got = values(txy(offset=2.0).mean_time())
    assert [v for *_, v in got] == [152.0, 153.0, 154.0, 162.0, 163.0, 164.0]


def test_apply_absolute(txy, values):
    cube = txy(ts=(2020,), tf=0.0, xf=-10.0).apply(lambda v: F.abs(v))
    assert [v for *_, v in values(cube, "x", "y", "value")] == [0.0, 1.0, 2.0, 10.0, 9.0, 8.0]


@pytest.mark.parametrize("tf, want", [(2.0, [-3.0, -1.0, 1.0, 3.0]), (10.0, [-15.0, -5.0, 5.0, 15.0])])
def test_demeaned_series(txy, tf, want):
    cube = txy(tf=tf).apply_timeseries(lambda s, context: s - s.mean())
    rows = cube.df.orderBy("x", "y", "t").collect()
    for i in range(0, len(rows), 4):
        assert [r.value for r in rows[i:i + 4]] == want


def test_statistics(txy):
    df = txy(ts=(2018, 2019, 2020), xs=(0, 1), ys=(0, 1), offset=2.0, tf=50.0, xf=10.0, yf=2.0)
    row = df.reduce_spatial("sum").reduce_temporal("sum").df.first()
    assert row.value == 696.0


# -- dimensions


def test_dimension_errors(txy):
    cube = txy()
    with pytest.raises(err.DimensionExists):
        cube.add_dimension("x", 1)
    with pytest.raises(err.DimensionNotAvailable):
        cube.rename_dimension("z", "q")
    with pytest.raises(err.DimensionExists):
        cube.rename_dimension("x", "y")
    with pytest.raises(err.TargetDimensionExists):
        cube.flatten_dimensions(["x", "t"], "y")
    with pytest.raises(Exception, match="DimensionMismatch"):
        cube.drop_dimension("x").df.collect()
    with pytest.raises(Exception, match="LabelExists"):
        cube.rename_labels("x", [3], [2]).df.collect()
    with pytest.raises(Exception, match="LabelNotAvailable"):
        cube.rename_labels("x", [30], [99]).df.collect()
    with pytest.raises(Exception, match="LabelsNotEnumerated"):
        cube.rename_labels("x", ["a", "b"]).df.collect()


def test_enumerated_labels(txy, values):
    cube = txy(xs=(0, 1), ts=(2020,), ys=(0,)).rename_labels("x", ["a", "b"])
    assert [r[0] for r in values(cube, "x")] == ["a", "b"]


def test_band_lookup(spark):
    df = spark.createDataFrame([(0, 0, 1.0, 2.0, float("nan"))], "x long, y long, a double, red double, c double")
    cube = Cube.of(df, temporal=(), bands=[Band("a", "red", 0.6, ("first",)), Band("red", "nir", 0.8), Band("c", "nir", 0.9)])
    assert cube.band("red").df.first().value == 2.0  # the unique name wins over the common name
    assert cube.band("first").df.first().value == 1.0 and cube.band(0).df.first().value == 1.0
    assert cube.filter_bands(["nir"]).schema.values == ["red", "c"]
    assert cube.filter_bands(wavelengths=[[0.85, 1.0], [0.5, 0.7]]).schema.values == ["c", "a"]
    assert cube.band("c").df.first().value is None  # NaN became no-data
    with pytest.raises(err.BandNotFound):
        cube.band("blue")


def test_apply_dimension_lengths(txy, values):
    same = txy(xs=(1,), ys=(1,)).apply_dimension(lambda a: F.reverse(a), "t")
    assert [r.value for r in same.df.orderBy("t").collect()] == [300.0, 200.0, 100.0, 0.0]
    short = txy(xs=(1,), ys=(1,)).apply_dimension(lambda a: F.slice(a, 1, 2), "t", "first")
    assert values(short, "first", "value") == [(0, 0.0), (1, 100.0)]
    with pytest.raises(Exception, match="target dimension"):
        txy().apply_dimension(lambda a: F.concat(a, a), "t").df.collect()


def test_wide_and_long(txy, values):
    cube = txy(xs=(0,), ys=(0,), name="a")
    two = cube._new(cube.df.withColumn("b", F.col("a") + 1), cube.schema.with_bands(["a", "b"], "bands"))
    assert values(two.to_long().to_wide("bands", ["a", "b"])) == values(two)


# -- merging


def test_merge_cases(txy, values):
    a, b = txy(xs=(1, 2), ts=(2018,), ys=(1,)), txy(xs=(2, 3), ts=(2018,), ys=(1,), offset=1000.0)
    merged = a.merge_cubes(b, lambda x, y: x + y)
    assert values(merged, "x", "value") == [(1, 0.0), (2, 1010.0), (3, 1010.0)]
    with pytest.raises(Exception, match="OverlapResolverMissing"):
        a.merge_cubes(b).df.collect()
    apart = a.merge_cubes(txy(xs=(5,), ts=(2018,), ys=(1,)))
    assert [r[0] for r in values(apart, "x")] == [1, 2, 5]
    flat = a.reduce_temporal("mean")
    low = flat.merge_cubes(a, lambda x, y: x * 10 + y)  # the lower-dimensional cube comes first
    assert values(low, "x", "value") == [(1, 0.0), (2, 110.0)]
    p, q = a.add_dimension("bands", "p", "bands"), a.add_dimension("bands", "q", "bands")
    assert p.merge_cubes(q).schema.values == ["p", "q"]
    renamed = a._new(a.df.withColumnRenamed("value", "other"), a.schema.single("other"))
    assert values(a.merge_cubes(renamed, lambda x, y: x + y), "x", "value") == [(1, 0.0), (2, 20.0)]
    with pytest.raises(err.DimensionMismatch):
        a.reduce_dimension("max", "x").merge_cubes(a.reduce_dimension("max", "y"))


def test_operators_between_cubes(txy, values):
    a = txy(ts=(2018,), xs=(1, 2), ys=(1,))
    assert [v for v, in values(2 * a + 1 - a, "value")] == [1.0, 11.0]
    assert [v for v, in values((a > 5) | (a == 0), "value")] == [True, True]
    assert [v for v, in values(1 / a, "value")] == [0.1, None]


# -- time


def test_nearest_time_prefers_earlier(spark):
    day = lambda d: dt.datetime(2020, 1, d)
    df = spark.createDataFrame([(0, 0, day(1), 1.0), (0, 0, day(5), None), (0, 0, day(9), 9.0)], "x long, y long, t timestamp_ntz, v double")
    goal = spark.createDataFrame([(0, 0, day(d), 0.0) for d in (3, 5, 7, 30)], "x long, y long, t timestamp_ntz, v double")
    make = lambda f: Cube.of(f, bands=["v"], band_dim=None)
    got = {r.t.day: r.v for r in make(df).resample_cube_temporal(make(goal)).df.collect()}
    assert got == {3: 1.0, 5: None, 7: None, 30: 9.0}
    got = {r.t.day: r.v for r in make(df).resample_cube_temporal(make(goal), valid_within=4).df.collect()}
    assert got == {3: 1.0, 5: 1.0, 7: 9.0, 30: None}


def test_complete_period_labels(spark):
    df = spark.createDataFrame([(0, 0, dt.datetime(2020, 1, 1), 1.0), (0, 0, dt.datetime(2020, 12, 31), 2.0)], "x long, y long, t timestamp_ntz, v double")
    cube = Cube.of(df, bands=["v"], band_dim=None)
    rows = cube.aggregate_temporal_period("day", "mean").df.orderBy("t").collect()
    assert len(rows) == 366 and rows[0].t == "2020-001" and rows[0].v == 1.0 and rows[1].v is None and rows[-1].v == 2.0
    assert [r.t for r in cube.filter_temporal("2020-01").aggregate_temporal_period("day", "mean").df.collect()] == ["2020-001"]
    counts = {r.t: r.v for r in cube.aggregate_temporal_period("month", "count").df.collect()}
    assert len(counts) == 12 and counts["2020-05"] == 0
    assert cube.aggregate_temporal_period("dekad", "max").df.count() == 36
    assert cube.aggregate_temporal_period("season", "max").df.count() == 5


def test_interval_errors(txy):
    cube = txy()
    with pytest.raises(err.TemporalExtentEmpty):
        cube.aggregate_temporal([("2020", "2019")], "mean")
    with pytest.raises(err.LabelExists):
        cube.aggregate_temporal([("2018", "2019"), ("2018", "2020")], "mean")


def test_seasons_before_the_range(spark):
    def cube(first):
        months = [(y, m) for y in range(2000, 2003) for m in range(1, 13) if (y, m) >= first]
        df = spark.createDataFrame([(0, 0, dt.datetime(y, m, 1), float(y)) for y, m in months], "x long, y long, t timestamp_ntz, v double")
        return Cube.of(df, bands=["v"], band_dim=None)

    with_december = {r.t: r.v for r in cube((2000, 12)).climatological_normal("season", (2001, 2002)).df.collect()}
    without = {r.t: r.v for r in cube((2001, 1)).climatological_normal("season", (2001, 2002)).df.collect()}
    assert with_december["djf"] == pytest.approx((2000 + 2001 * 3 + 2002 * 2) / 6)
    assert without["djf"] == pytest.approx((2001 + 2002 * 2) / 3) and without["mam"] == 2001.5


# -- space


def test_bbox(txy, values):
    assert bbox_dict([3, 50, 4, 51]) == {"west": 3, "south": 50, "east": 4, "north": 51}
    assert normalize_longitudes(190, 200) == (-170, -160)
    with pytest.raises(err.InvalidBBox):
        bbox_dict({"west": 1})
    with pytest.raises(err.InvalidBBox):
        bbox_dict({"west": "a", "south": 1, "east": 2, "north": 3})
    assert {r[0] for r in values(txy().filter_bbox([2.5, 0, 9, 25]), "x")} == {3}


def grid(spark, array, **kw):
    rows = [(x, y, float(v)) for y, row in enumerate(array) for x, v in enumerate(row)]
    return Cube.of(spark.createDataFrame(rows, "x long, y long, v double"), temporal=(), bands=["v"], band_dim=None, **kw)


def as_array(cube, name="v"):
    rows = cube.df.collect()
    out = np.full((1 + max(r.y for r in rows), 1 + max(r.x for r in rows)), np.nan)
    for r in rows:
        out[r.y, r.x] = r[name]
    return out


PAD = {"replicate": "edge", "reflect": "symmetric", "reflect_pixel": "reflect", "wrap": "wrap"}


@pytest.mark.parametrize("border", ["replicate", "reflect", "reflect_pixel", "wrap", 0, 7])
@pytest.mark.parametrize("tile", [3, 256])
def test_kernel_borders(spark, monkeypatch, border, tile):
    """Against numpy padding; a tile of three cells sends every sum across tile borders."""
    monkeypatch.setattr(focal, "TILE", tile)
    rng = np.random.default_rng(1)
    data, kernel = rng.integers(0, 9, (7, 8)), rng.integers(-2, 3, (3, 5))
    got = as_array(grid(spark, data).apply_kernel(kernel.tolist(), factor=2.0, border=border))
    pad = np.pad(data, ((1, 1), (2, 2)), **({"mode": PAD[border]} if isinstance(border, str) else {"mode": "constant", "constant_values": border}))
    want = np.array([[2.0 * (pad[y:y + 3, x:x + 5] * kernel).sum() for x in range(8)] for y in range(7)])
    assert np.allclose(got, want)


def test_border_index_strings():
    def line(border):
        return "".join("abcdefgh"[focal.source_index(u, 8, border)] for u in range(-6, 14))

    assert line("replicate") == "aaaaaa" + "abcdefgh" + "hhhhhh"
    assert line("reflect") == "fedcba" + "abcdefgh" + "hgfedc"
    assert line("reflect_pixel") == "gfedcb" + "abcdefgh" + "gfedcb"
    assert line("wrap") == "cdefgh" + "abcdefgh" + "abcdef"


@pytest.mark.parametrize("separable", [True, False])
def test_kernel_of_51_cells(spark, separable):
    rng = np.random.default_rng(5)
    data = rng.integers(0, 9, (60, 70))
    kernel = np.outer(rng.random(51), rng.random(51)) if separable else rng.random((51, 51))
    out = grid(spark, data).apply_kernel(kernel.tolist(), border="reflect")
    assert "Generate explode" not in out.df._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]  # no row per weight
    pad = np.pad(data, 25, mode="symmetric")
    want = np.lib.stride_tricks.sliding_window_view(pad, (51, 51))
    assert np.allclose(as_array(out), (want * kernel).sum(axis=(2, 3)), rtol=1e-10)


def test_flat_ground_has_no_aspect(spark):
    cube = grid(spark, np.full((5, 6), 7.3))
    assert all(np.isnan(r[0]) for r in cube.aspect().df.select(cube.aspect().schema.values[0]).collect())
    assert {r[0] for r in cube.slope().df.select(cube.slope().schema.values[0]).collect()} == {0.0}


def test_kernel_missing_cells_and_errors(spark):
    cube = grid(spark, [[1, 2], [3, 4]])
    holed = cube._new(cube.df.withColumn("v", F.when(F.col("v") != 4, F.col("v"))))
    got = as_array(holed.apply_kernel([[1, 1, 1]] * 3, replace_invalid=10))
    assert np.allclose(got, 16)
    with pytest.raises(err.KernelDimensionsUneven):
        cube.apply_kernel([[1, 1]])


def test_terrain(spark):
    plane = grid(spark, [[x * 10.0 for x in range(5)] for _ in range(5)], step=10.0)
    plane = Cube.of(plane.df.withColumns({"x": F.col("x") * 10, "y": F.col("y") * 10}), temporal=(), bands=["v"], band_dim=None, step=10.0)
    s = {(r.x, r.y): r.v_slope for r in plane.slope().df.collect()}
    assert s[20, 20] == pytest.approx(math.pi / 4)
    a = {(r.x, r.y): r.v_aspect for r in plane.aspect().df.collect()}
    assert a[20, 20] == pytest.approx(1.5 * math.pi)  # rises to the east, so it faces west
    flat = grid(spark, [[1.0] * 3] * 3)
    assert all(math.isnan(r.v_aspect) for r in flat.aspect().df.collect())


def test_windows(spark, values):
    cube = grid(spark, np.arange(15).reshape(3, 5))
    assert {r[0] for r in values(cube.aggregate_spatial_window("max", (2, 2)), "x")} == {0.5, 2.5, 4.5}
    trimmed = cube.aggregate_spatial_window("max", (2, 2), boundary="trim")
    assert values(trimmed, "x", "y", "v") == [(0.5, 1.5, 11.0), (2.5, 1.5, 13.0)]
    right = cube.aggregate_spatial_window("min", (2, 3), boundary="trim", align="upper-right")
    assert values(right, "x", "v") == [(1.5, 1.0), (3.5, 3.0)]


def test_resample_identity_and_totals(spark):
    data = np.random.default_rng(3).random((6, 6))
    cube = grid(spark, data)
    for method in ("near", "bilinear", "cubic", "lanczos", "average"):
        rows = cube.resample_spatial(0, method=method).df.collect()
        got = np.full((6, 6), np.nan)
        for r in rows:
            got[int(r.y), int(r.x)] = r.v
        assert np.allclose(got, data), method
    total = cube.resample_spatial(1.7, method="sum", align="lower-right").df.agg(F.sum("v")).first()[0]
    assert total == pytest.approx(data.sum())
    assert cube.resample_spatial(0.5).df.count() == 144


# -- polygons


RING = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
HOLE = [(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]


def hits(cube, shape, **kw):
    from cubeloom.operators.geometry import pixel_hits

    g = Geometries.from_shapes(cube.spark, [shape])
    g = g.vector_buffer(kw["buffer"]) if "buffer" in kw else g
    return {(r.x, r.y) for r in pixel_hits(cube, g).collect()}


def test_point_rules(spark, monkeypatch):
    from cubeloom.operators import geometry

    cube = grid(spark, np.zeros((6, 6)))
    for tile in (2, 256):
        monkeypatch.setattr(geometry, "TILE", tile)
        full = hits(cube, {"type": "Polygon", "coordinates": [RING]})
        assert full == {(x, y) for x in range(5) for y in range(5)}  # the edge counts
        ringed = hits(cube, {"type": "Polygon", "coordinates": [RING, HOLE]})
        assert full - ringed == {(2, 2)}  # the hole's own edge still touches
        assert hits(cube, {"type": "Point", "coordinates": (1.4, 2.6)}) == {(1, 3)}
        assert hits(cube, {"type": "LineString", "coordinates": [(0, 0), (3, 0), (3, 2)]}) == {(0, 0), (1, 0), (2, 0), (3, 0), (3, 1), (3, 2)}
        assert hits(cube, {"type": "MultiPolygon", "coordinates": [[[(0, 0), (1, 0), (1, 1), (0, 0)]], [[(4, 4), (5, 4), (5, 5), (4, 4)]]]}) == {
            (0, 0), (1, 0), (1, 1), (4, 4), (5, 4), (5, 5)}
        assert hits(cube, {"type": "Polygon", "coordinates": [RING]}, buffer=-1.0) == {(x, y) for x in (1, 2, 3) for y in (1, 2, 3)}
        assert len(hits(cube, {"type": "Point", "coordinates": (2, 2)}, buffer=1.0)) == 5
        assert hits(cube, {"type": "Polygon", "coordinates": []}) == set()


def test_overlapping_segments_fail(spark):
    cube = grid(spark, np.zeros((4, 4)))
    zones = Geometries.from_shapes(spark, [{"type": "Polygon", "coordinates": [RING]}, {"type": "Polygon", "coordinates": [HOLE]}])
    with pytest.raises(Exception, match="GeometriesOverlap"):
        cube.apply_polygon(zones, lambda c: c).df.collect()


def test_buffer_needs_metres(spark):
    with pytest.raises(err.UnitMismatch):
        Geometries.from_shapes(spark, [{"type": "Point", "coordinates": (0, 0)}], 4326).vector_buffer(1)
    with pytest.raises(err.UnsupportedGeometry):
        Geometries.from_shapes(spark, [{"type": "GeometryCollection", "geometries": []}])


def test_reference_systems_are_aligned(spark):
    rows = [(500000.0 + 10 * i, 100.0 + 10 * j, 1.0) for i in range(20) for j in range(10)]
    cube = Cube.of(spark.createDataFrame(rows, "x double, y double, v double"), temporal=(), bands=["v"], step=10.0, crs=32631)
    box = [(499900.0, 0.0), (500095.0, 0.0), (500095.0, 300.0), (499900.0, 300.0), (499900.0, 0.0)]
    metres = Geometries.from_shapes(spark, [{"type": "Polygon", "id": 1, "coordinates": [box]}], 32631)
    for zone in (metres, metres.vector_reproject(4326)):
        assert cube.aggregate_spatial(zone, "count").df.first().v == 100
        assert cube.filter_spatial(zone).df.count() == 100
        assert cube.mask_polygon(zone).df.where("v is not null").count() == 100
    bare = Cube.of(cube.df, temporal=(), bands=["v"], step=10.0)
    for use in (lambda: bare.aggregate_spatial(metres, "count"), lambda: bare.filter_spatial(metres), lambda: bare.mask_polygon(metres)):
        with pytest.raises(err.CrsUnknown):
            use()


def test_buffers_are_seen_everywhere(spark):
    plot = Geometries.from_shapes(spark, [{"type": "Polygon", "id": 1, "coordinates": [RING]}], 3857)
    near = Geometries.from_shapes(spark, [{"type": "Point", "id": 2, "coordinates": (9, 2)}], 3857)
    assert near.filter_vector(plot).df.count() == 0 and near.filter_vector(plot.vector_buffer(4)).df.count() == 0
    assert near.filter_vector(plot.vector_buffer(5)).df.count() == near.vector_buffer(2).filter_vector(plot.vector_buffer(3)).df.count() == 1
    assert near.vector_buffer(2).filter_vector(plot.vector_buffer(3), "disjoint").df.count() == 0
    assert plot.vector_buffer(1).filter_bbox([0, 0, 4, 4]).df.count() == 0 and plot.vector_buffer(1).filter_bbox([-1, -1, 5, 5]).df.count() == 1
    for refused in (lambda: plot.vector_buffer(5).vector_buffer(-5), lambda: plot.vector_buffer(5).vector_reproject(4326),
                    lambda: near.filter_vector(plot.vector_buffer(1), "within")):
        with pytest.raises(err.UnsupportedGeometry):
            refused()


def test_reprojection_known_points(spark):
    g = Geometries.from_shapes(spark, [{"type": "Point", "coordinates": (3.0, 0.0)}, {"type": "Point", "coordinates": (5.0, 52.0)}], 4326)
    utm = {r.geom_id: r for r in g.vector_reproject("EPSG:32631").df.collect()}
    assert (utm[0].minx, utm[0].miny) == (pytest.approx(500000.0, abs=1e-3), pytest.approx(0.0, abs=1e-3))
    assert (utm[1].minx, utm[1].miny) == (pytest.approx(637294.37, abs=0.5), pytest.approx(5762926.81, abs=0.5))
    back = {r.geom_id: r for r in g.vector_reproject(32631).vector_reproject(4326).df.collect()}
    assert back[1].minx == pytest.approx(5.0, abs=1e-7) and back[1].miny == pytest.approx(52.0, abs=1e-7)
    with pytest.raises(err.UnsupportedProjection):
        g.vector_reproject(31370).df.collect()


def test_area_methods_across_reference_systems(spark):
    rows = [(500000.0 + 1000 * i, 5700000.0 + 1000 * j, float(i * 7 % 5 + j), 3.0) for i in range(12) for j in range(9)]
    cube = Cube.of(spark.createDataFrame(rows, "x double, y double, a double, b double"), temporal=(), bands=["a", "b"], crs=32631, step=1000.0)
    total = sum(r[2] for r in rows)
    for size in (0.002, 0.03, 50.0):  # cells smaller than a pixel, larger, and one for all; outlines are oblique
        summed = cube.resample_spatial(size, projection=4326, method="sum").df
        got = summed.agg(F.sum("a"), F.sum("b")).first()
        assert got[0] == pytest.approx(total, rel=1e-7) and got[1] == pytest.approx(3.0 * len(rows), rel=1e-7)
    mean = {(r.x, r.y): r for r in cube.resample_spatial(0.03, projection=4326, method="average").df.collect()}
    assert all(r.b == pytest.approx(3.0) for r in mean.values())
    low, high = (cube.resample_spatial(0.03, projection=4326, method=m).df.collect() for m in ("min", "max"))
    assert {(r.x, r.y) for r in low} == set(mean) == {(r.x, r.y) for r in high}
    assert all(r.a <= mean[r.x, r.y].a + 1e-9 for r in low) and all(r.a >= mean[r.x, r.y].a - 1e-9 for r in high)


@pytest.mark.parametrize("area", [[(0.2, 0.1), (1.7, 0.4), (1.5, 1.9), (-0.3, 1.2)], [(0, 0), (1, 0), (1, 1), (0, 1)], [(-2, -2), (3, -2), (3, 3), (-2, 3)],
                                  [(0.5, -1), (0.5, 2), (0.7, 2), (0.7, -1)], [(5, 5), (6, 5), (6, 6), (5, 6)], [(0.2, 0.5), (0.8, 0.5 + 1e-13), (0.8, 0.9), (0.2, 0.9)]])
def test_clipped_area_against_sampling(spark, area):
    corners = F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in area])
    got = spark.range(1).select(_clipped_area(corners, F.lit(0.0), F.lit(0.0), 1.0, 1.0)).first()[0]
    n = 400
    xs, ys = np.meshgrid((np.arange(n) + 0.5) / n, (np.arange(n) + 0.5) / n)
    odd = np.zeros_like(xs, bool)
    for (ax, ay), (bx, by) in zip(area, area[1:] + area[:1]):
        with np.errstate(all="ignore"):
            odd ^= ((ay > ys) != (by > ys)) & (xs < ax + (ys - ay) * (bx - ax) / (by - ay))
    assert got == pytest.approx(odd.mean(), abs=3e-3)


@pytest.mark.parametrize("size, tile, n", [(100e3, 20e3, 25), (150e3, 100e3, 4)])
def test_split_area_box(spark, size, tile, n):
    rows = split_area(spark, {"west": 0, "south": 0, "east": size, "north": size, "crs": 3857}, projection="EPSG:3857", tile_size=tile).collect()
    assert len(rows) == n and max(r.east for r in rows) == size and max(r.north for r in rows) == size


def test_split_area_shapes(spark):
    ell = [(0, 0), (2, 0), (2, 0.9), (0.9, 0.9), (0.9, 2), (0, 2), (0, 0)]
    area = Geometries.from_shapes(spark, [{"type": "Polygon", "coordinates": [ell]}], 3857)
    assert split_area(spark, area, projection=3857, tile_size=1.0).count() == 3
    two = box_geometry(spark, {"west": 170, "east": 190, "south": 0, "north": 10, "crs": 4326})
    assert split_area(spark, two, projection=4326, tile_size=5.0).count() == 8
    for bad in ({}, {"tile_size": 1.0}, {"projection": 3857}, {"projection": 3857, "tile_size": -1.0}, {"tile_grid": area, "tile_size": 1.0}):
        with pytest.raises(err.SplitError):
            split_area(spark, area, **bad)


def test_regular_points_fallback(spark):
    thin = Geometries.from_shapes(spark, [{"type": "Polygon", "coordinates": [[(0, 0), (10, 0), (0, 0.1), (0, 0)]]}], 3857)
    assert thin.vector_to_regular_points(50.0).df.first().parts == [[(0.0, 0.0)]]


def test_random_points(spark):
    g = Geometries.from_shapes(spark, [{"type": "Polygon", "id": 7, "coordinates": [RING, HOLE]}, {"type": "LineString", "id": 8, "coordinates": [(0, 0), (5, 5)]}], 3857)
    first = g.vector_to_random_points(geometry_count=20, seed=1).df.collect()
    again = g.vector_to_random_points(geometry_count=20, seed=1).df.collect()
    assert sorted(first) == sorted(again) and {r.geom_id for r in first} == {7, 8}
    points = next(r.parts[0] for r in first if r.geom_id == 7)
    assert len(points) == 20 and not any(1 < p.x < 3 and 1 < p.y < 3 for p in points)
    with pytest.raises(Exception, match="CountMismatch"):
        g.vector_to_random_points(total_count=1, seed=1).df.collect()


@pytest.mark.parametrize("type, labels", [("other", ("a", "b")), ("temporal", ("2020-01-01", "2021-01-01"))])
def test_merge_of_constant_labels_never_tries_all_pairs(spark, type, labels):
    """Different constants on both sides: a join by keys, with nulls and repeated cells as in any outer join."""
    rows = [(0, 0, 1.0), (1, 0, 2.0), (1, 0, 3.0), (None, 0, 4.0)]
    flat = Cube.of(spark.createDataFrame(rows, "x long, y long, value double"), temporal=(), bands=["value"], band_dim=None)
    a, b = (flat.add_dimension("k", label, type) for label in labels)
    for apart in (a.merge_cubes(b), a.filter_bbox([-9, -9, 9, 9]).merge_cubes(b.filter_bbox([-9, -9, 9, 9]))):
        assert "NestedLoop" not in apart.df._jdf.queryExecution().executedPlan().toString()
    merged = a.merge_cubes(b)
    assert merged.schema.dim_names == ["x", "y", "k"] and merged.df.columns == ["x", "y", "k", "value"]
    found = [(r.x, r.value, str(r.k)[:10]) for r in merged.df.collect()]
    assert sorted(found, key=str) == sorted([(x, v, label) for x, _, v in rows for label in labels], key=str)
    same = [(r.x, r.value) for r in a.merge_cubes(a, lambda p, q: p * 10 + q).df.collect()]
    assert sorted(same, key=str) == sorted([(0, 11.0), *[(1, p * 10 + q) for p in (2.0, 3.0) for q in (2.0, 3.0)], (None, 4.0), (None, 4.0)], key=str)
    gaps = compare.cube_differences(a, b)
    assert "NestedLoop" not in gaps._jdf.queryExecution().executedPlan().toString()
    assert {str(r.k)[:10]: r.diff_count for r in gaps.collect()} == {label: 4 for label in labels}


def test_random_points_total_below_the_number_of_geometries(spark, tmp_path):
    from cubeloom.registry import REGISTRY

    boxes = [{"type": "Polygon", "id": i, "coordinates": [[(i, 0), (i + 1, 0), (i + 1, 1), (i, 0)]]} for i in range(5)]
    g = Geometries.from_shapes(spark, boxes, 3857)
    assert g.vector_to_random_points(total_count=4, group=False, seed=1, strict=False).df.count() == 0
    assert g.vector_to_random_points(total_count=11, group=False, seed=1, strict=False).df.count() == 10
    # the registered query, as its twin: even shares of 4,000 points, whatever the number of polygons
    for suppliers, n in ((3000, 4000), (12003, 0)):
        path = str(tmp_path / str(suppliers))
        spark.range(suppliers).select(F.col("id").alias("s_suppkey"), F.lit(1.0).alias("s_acctbal"), F.lit(1).alias("s_nationkey")).write.parquet(path + "/supplier.parquet")
        assert [tuple(r) for r in REGISTRY["vector_to_random_points_total"].run(spark, path).collect()] == [(n,)]


def test_trapezoids_fill_the_polygon():
    rng = np.random.default_rng(5)
    turn = np.linspace(0, 2 * np.pi, 100_000, endpoint=False)
    star = np.stack([np.cos(turn), np.sin(turn)], axis=1) * (2 + np.sin(50 * turn))[:, None]
    for ring in (star, rng.random((40, 2))):  # many corners, and one that crosses itself
        traps = _trapezoids(np.concatenate([ring, np.roll(ring, -1, axis=0)], axis=1))
        area = ((traps[:, 4] - traps[:, 2] + traps[:, 5] - traps[:, 3]) / 2 * (traps[:, 1] - traps[:, 0])).sum()
        if len(ring) > 1000:
            x, y = ring.T
            assert area == pytest.approx(abs(x @ np.roll(y, -1) - y @ np.roll(x, -1)) / 2, rel=1e-9)
        else:
            xs, ys = np.meshgrid((np.arange(500) + 0.5) / 500, (np.arange(500) + 0.5) / 500)
            odd = np.zeros_like(xs, bool)
            for (ax, ay), (bx, by) in zip(ring, np.roll(ring, -1, axis=0)):
                odd ^= ((ay > ys) != (by > ys)) & (xs < ax + (ys - ay) * (bx - ax) / (by - ay))
            assert area == pytest.approx(odd.mean(), abs=4e-3)


def test_a_million_random_points_and_a_polygon_of_many_corners(spark):
    turn = np.linspace(0, 2 * np.pi, 20_001)
    ring = np.stack([100 * np.cos(turn), 50 * np.sin(turn)], axis=1)
    shapes = [{"type": "Polygon", "id": 1, "coordinates": [ring.tolist()]}, {"type": "Polygon", "id": 2, "coordinates": [[(0, 0), (4, 0), (4, 1), (0, 0)]]}]
    got = Geometries.from_shapes(spark, shapes, 3857).vector_to_random_points(geometry_count=1_000_000, group=False, seed=3).df
    p = F.col("parts")[0][0]
    inside = (F.pow(p["x"] / 100, F.lit(2)) + F.pow(p["y"] / 50, F.lit(2)) <= 1.0)
    row = got.agg(F.count("*").alias("n"), F.sum(inside.cast("int")).alias("inside"), F.sum(F.when((p["x"] > 4) & (p["y"] > 0), 1)).alias("quarter")).first()
    assert row.n == row.inside == 2_000_000 and row.quarter == pytest.approx(250_000 * (1 - 0.0509), rel=0.01)


def test_regular_points_along_a_long_line(spark):
    bends = [(float(i), float(i % 2)) for i in range(30_001)]
    line = Geometries.from_shapes(spark, [{"type": "LineString", "id": 1, "coordinates": bends}], 3857)
    points = line.vector_to_regular_points(10.0).df.first().parts[0]
    assert len(points) == math.ceil(30_000 * math.sqrt(2) / 10)
    assert all(p.y == pytest.approx(p.x % 2 if p.x % 2 <= 1 else 2 - p.x % 2, abs=1e-6) for p in points)


def test_random_points_of_thin_and_crossing_polygons(spark):
    thin = [{"type": "Polygon", "id": i, "coordinates": [[(0, 0), (1000, 1000), (1000, 1000.5), (0, 0.5), (0, 0)]]} for i in range(200)]
    bow = {"type": "Polygon", "id": 900, "coordinates": [[(0, 0), (4, 4), (4, 0), (0, 4), (0, 0)]]}
    flat = {"type": "Polygon", "id": 901, "coordinates": [[(0, 0), (4, 4), (0, 0)]]}
    got = Geometries.from_shapes(spark, [*thin, bow, flat], 3857).vector_to_random_points(geometry_count=10, seed=1).df.collect()
    assert len(got) == 202 and all(len(r.parts[0]) == 10 for r in got)
    for r in got:
        for p in r.parts[0]:
            if r.geom_id < 900:
                assert -1e-6 <= p.y - p.x <= 0.5 + 1e-6
            elif r.geom_id == 900:
                assert abs(p.y - 2) <= abs(p.x - 2) + 1e-9


# -- outlines, against union-find


def test_outlines(spark):
    rng = np.random.default_rng(5)
    data = rng.integers(0, 2, (9, 11))
    data[:, 4] = 1  # one area spans the grid
    parent = {(y, x): (y, x) for y in range(9) for x in range(11)}

    def root(c):
        while parent[c] != c:
            c = parent[c]
        return c

    for y, x in list(parent):
        for n in ((y + 1, x), (y, x + 1)):
            if n in parent and data[n] == data[y, x]:
                parent[root(n)] = root((y, x))
    areas = {}
    for c in parent:
        areas.setdefault(root(c), []).append(c)

    def rim(cells):
        inside = set(cells)
        return sum((y + dy, x + dx) not in inside for y, x in cells for dy, dx in ((0, 1), (0, -1), (1, 0), (-1, 0)))

    want = sorted((float(data[r]), rim(cells)) for r, cells in areas.items())
    lines = grid(spark, data).raster_to_vector()
    got = sorted(tuple(r) for r in lines.groupBy("feature_id").agg(F.max("value"), F.count("*")).drop("feature_id").collect())
    assert got == want


# -- comparing


@pytest.mark.parametrize("off, ok", [(3e-8, True), (1e-4, False)])
def test_compare_tolerance(spark, off, ok):
    a, b = grid(spark, [[1.0, 2.0, 3.0]]), grid(spark, [[1.0, 2.0, 3.0 + off]])
    if ok:
        compare.assert_cubes_close(b, a)
    else:
        with pytest.raises(AssertionError):
            compare.assert_cubes_close(b, a)


def test_compare_share_and_missing(spark):
    a = grid(spark, [[1.0, 2.0, 3.0, 4.0, 5.0]])
    b = grid(spark, [[1.5, 2.5, 3.0, 4.0, 5.0]])
    compare.assert_cubes_close(b, a, pixel_tolerance=40.0)
    with pytest.raises(AssertionError):
        compare.assert_cubes_close(b, a, pixel_tolerance=21.0)
    row = compare.cube_differences(a.filter_bbox([0, 0, 3, 9]), a).first()
    assert row.diff_count == 1 and row.min_x == 4
    with pytest.raises(ValueError):
        compare.cube_differences(a, a.rename_dimension("x", "lon"))


def test_outlines_over_blocks_and_planes(spark):
    """Areas that cross the blocks of the grid, by the sides of each pixel and by union of all pixels of a value that touch."""
    rng = np.random.default_rng(8)
    data = rng.integers(0, 2, (2, 67, 131)).astype(float)
    data[0, :, 63:65] = 1
    data[1, 63:65, :] = 0
    cells = [(x * 10, y * 10 - 300, t, float(data[t, y, x])) for t in range(2) for y in range(67) for x in range(131) if (x * y + t) % 11]
    cube = Cube.of(spark.createDataFrame(cells, "x long, y long, t long, value double"), temporal=(), other=("t",), bands=["value"], band_dim=None, step=10.0)
    value = {(t, x, y): v for x, y, t, v in cells}
    area = {c: None for c in value}
    for c in sorted(value, key=lambda c: (c[0], c[2], c[1])):  # the first pixel names the area
        todo = [c] if area[c] is None else []
        while todo:
            t, x, y = p = todo.pop()
            if area[p] is None:
                area[p] = f"{t}:{(c[2] + 300) // 10 * 131 + c[1] // 10}"
                todo += [q for q in ((t, x + 10, y), (t, x - 10, y), (t, x, y + 10), (t, x, y - 10)) if value.get(q) == value[p]]
    want = []
    for (t, x, y), v in value.items():
        for dx, dy, side in ((0, -10, (-5, -5, 5, -5)), (0, 10, (-5, 5, 5, 5)), (-10, 0, (-5, -5, -5, 5)), (10, 0, (5, -5, 5, 5))):
            if value.get((t, x + dx, y + dy)) != v:
                want.append((t, area[t, x, y], v, float(x + side[0]), float(y + side[1]), float(x + side[2]), float(y + side[3])))
    assert sorted(tuple(r) for r in cube.raster_to_vector().collect()) == sorted(want)


def test_sides_of_outlines_are_not_shuffled(spark):
    """Sides are known from the neighbours of a cell; only cells that have a neighbour of their value meet the areas."""
    plan = grid(spark, [[1, 2, 1, 1], [2, 1, 2, 1]]).raster_to_vector()._jdf.queryExecution().optimizedPlan().toString()
    assert "count(1)" not in plan and "near" in plan.split("Join")[1]


def test_cells_that_come_twice_have_no_sides(spark):
    rows = [(0, 0, 1.0), (1, 0, 1.0), (1, 0, 1.0), (2, 0, 2.0), (None, None, 2.0)]
    cube = Cube.of(spark.createDataFrame(rows, "x long, y long, value double"), temporal=(), bands=["value"], band_dim=None)
    got = sorted(tuple(r) for r in cube.raster_to_vector().groupBy("feature_id").count().collect())
    assert got == [(":0", 3), (":2", 4)]


def test_polygons_of_areas_with_holes_and_corners_that_touch(spark):
    from cubeloom.operators.geometry import pixel_hits

    rng = np.random.default_rng(3)
    ring = np.ones((7, 9))
    ring[1:6, 1:8] = 2
    ring[2:5, 2:7] = 1
    ring[3, 4] = 3
    pinch = np.array([[1, 1, 0, 0], [1, 0, 1, 0], [1, 1, 1, 0], [0, 0, 0, 5]])
    for data in (ring, pinch, rng.integers(0, 2, (13, 11)), np.full((1, 1), 4)):
        cube = grid(spark, data)
        shapes = cube.raster_to_polygons()
        rows = shapes.df.collect()
        inside = {}
        for r in pixel_hits(cube, shapes).collect():
            inside.setdefault(r.geom_id, set()).add((r.x, r.y))
        cells = [c for found in inside.values() for c in found]
        assert len(cells) == len(set(cells)) == data.size  # every cell in exactly one polygon
        values = {(r.x, r.y): r.value for r in cube.to_values().df.collect()}
        for r in rows:
            assert {values[c] for c in inside[r.geom_id]} == {r.value}
            areas = [sum(p.x * q.y - q.x * p.y for p, q in zip(part, part[1:])) / 2 for part in r.parts]
            assert areas[0] > 0 and all(a < 0 for a in areas[1:]) and sum(areas) == len(inside[r.geom_id])
            for part in r.parts:
                assert part[0] == part[-1]
                assert all((a.x == b.x) != (b.x == c.x) for a, b, c in zip(part, part[1:], part[2:]))  # corners only
    assert len(grid(spark, pinch).raster_to_polygons().df.where("value = 1").first().parts) == 1  # its hole touches the outside


@pytest.mark.parametrize("given, temporal, want", [
    (8, False, (8, "px")), (3600, True, (3600, "s")), ("128 px", False, (128, "px")), ("100 m", False, (100, "m")), ("0.5 km", False, (500, "m")),
    ("10 days", True, (864000, "s")), ("P10d", True, (864000, "s")), ("PT6H30M", True, (23400, "s")), ("P2W", True, (1209600, "s")), ("P1M", True, (1, "month")),
    ("2 years", True, (24, "month")), ({"value": 16, "unit": "px"}, False, (16, "px")), ({"value": "P1Y2M"}, True, (14, "month"))])
def test_sizes_of_neighbourhoods(given, temporal, want):
    from cubeloom.operators.measures import measure

    found = measure(given, temporal)
    assert (found.amount, found.unit) == want


@pytest.mark.parametrize("given, temporal", [("10 days", False), ("100 m", True), ("P", True), ("P1M3D", True), ("1.5 months", True), ("7 cubits", False), ("", False)])
def test_sizes_that_are_refused(given, temporal):
    from cubeloom.operators.measures import measure

    with pytest.raises(ValueError):
        measure(given, temporal)


def test_metres_in_degrees_and_without_a_system(spark):
    from cubeloom.errors import CrsUnknown

    df = spark.range(40).select((F.col("id") % 8 * 0.001 + 10).alias("x"), (F.floor(F.col("id") / 8) * 0.001 + 60).alias("y"), F.lit(1.0).alias("v"))
    cube = Cube.of(df, temporal=(), bands=["v"], step=0.001, crs=4326)

    def count(block):
        return block._new(block.df.withColumn("v", F.count(F.lit(1)).over(Window.partitionBy("block")).cast("double")))

    # at 60 degrees a pixel is 55.7 m wide and 111.3 m high: four by two of them make a block
    got = {r.v for r in cube.apply_neighborhood(count, {"x": "222 m", "y": "222 m"}).df.collect()}
    assert got == {8.0, 4.0}  # the fifth row is alone
    with pytest.raises(CrsUnknown):
        Cube.of(df, temporal=(), bands=["v"], step=0.001).apply_neighborhood(count, {"x": "223 m"})
