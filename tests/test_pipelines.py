"""Chains of operators as users write them, against brute force."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from cubeloom import Band, Cube
from cubeloom.functions import reducers as R
from cubeloom.operators.vector import Geometries

DAYS, NY, NX = 6, 5, 6


@pytest.fixture(scope="module")
def scene(spark):
    rng = np.random.default_rng(9)
    data = {b: rng.random((DAYS, NY, NX)).round(3) for b in ("blue", "red", "nir")}
    data["scl"] = rng.integers(3, 11, (DAYS, NY, NX)).astype(float)
    rows = [(x, y, dt.datetime(2020, 1 + d // 2, 1 + 10 * (d % 2)), *[float(data[b][d, y, x]) for b in data])
            for d in range(DAYS) for y in range(NY) for x in range(NX)]
    df = spark.createDataFrame(rows, "x long, y long, t timestamp_ntz, blue double, red double, nir double, scl double")
    bands = [Band("blue", "blue"), Band("red", "red"), Band("nir", "nir"), Band("scl")]
    return Cube.of(df, bands=bands, collection_id="SENTINEL2"), data


def stack(cube, name="value"):
    rows = cube.df.orderBy("t", "y", "x").collect() if cube.schema.has("t") else cube.df.orderBy("y", "x").collect()
    flat = np.array([np.nan if r[name] is None else r[name] for r in rows], dtype=float)
    return flat.reshape(-1, NY, NX)


def test_monthly_maximum_of_evi(scene):
    cube, d = scene
    names = {"N": "nir", "R": "red", "B": "blue"}
    got = stack(cube.compute_index("EVI", variable_map=names).aggregate_temporal_period("month", "max"), "EVI")
    evi = 2.5 * (d["nir"] - d["red"]) / (d["nir"] + 6 * d["red"] - 7.5 * d["blue"] + 1)
    assert np.allclose(got, evi.reshape(3, 2, NY, NX).max(axis=1))


def test_fuzzy_mask(scene):
    """Clouds grown by a kernel before they are masked, then a composite."""
    cube, d = scene
    cloud = cube.band("scl").apply(lambda v: (v >= 9).cast("double"))
    kernel = [[1.0] * 3] * 3
    near = cloud.apply_kernel(kernel, factor=1 / 9) > 0.1
    got = stack(cube.filter_bands(["red"]).mask(near).reduce_temporal("mean"), "red")
    pad = np.pad((d["scl"] >= 9).astype(float), ((0, 0), (1, 1), (1, 1)))
    grown = sum(pad[:, j:j + NY, i:i + NX] for i in range(3) for j in range(3)) / 9 > 0.1
    red = np.where(grown, np.nan, d["red"])
    with np.errstate(all="ignore"):
        want = np.nansum(red, axis=0) / (~grown).sum(axis=0)
    assert np.allclose(got[0], want, equal_nan=True)


def test_running_total_of_demeaned_band(scene):
    cube, d = scene
    level = cube.filter_bands(["nir"]).reduce_temporal("mean")
    got = stack((cube.filter_bands(["nir"]) - level).apply_dimension("cumsum", "t"), "nir")
    assert np.allclose(got, np.cumsum(d["nir"] - d["nir"].mean(axis=0), axis=0))


def test_zonal_quantiles_of_ndvi(scene, spark):
    cube, d = scene
    zone = Geometries.from_shapes(spark, [{"type": "Polygon", "id": 4, "coordinates": [[(0.5, 0.5), (3.5, 0.5), (3.5, 2.5), (0.5, 2.5), (0.5, 0.5)]]}])
    rows = cube.ndvi().aggregate_spatial(zone, R.quantiles([0.25, 0.5])).df.orderBy("t").collect()
    ndvi = (d["nir"] - d["red"]) / (d["nir"] + d["red"])
    want = np.quantile(ndvi[:, 1:3, 1:4].reshape(DAYS, -1), [0.25, 0.5], axis=1).T
    assert np.allclose([r.value for r in rows], want)


def test_best_pixel_composite(scene):
    """For each pixel the red value of the date with the highest NDVI, by merging a mask of ranks."""
    cube, d = scene
    ndvi = cube.ndvi()
    best = ndvi.reduce_temporal("max")
    not_best = ndvi < best
    got = stack(cube.filter_bands(["red"]).mask(not_best).reduce_temporal("first"), "red")
    values = (d["nir"] - d["red"]) / (d["nir"] + d["red"])
    at = values.argmax(axis=0)
    assert np.allclose(got[0], np.take_along_axis(d["red"], at[None], axis=0)[0])


def test_seasonal_anomaly_round_trip(scene):
    cube, d = scene
    month = cube.filter_bands(["red"]).aggregate_temporal_period("month", "mean", complete=False)
    normal = cube.filter_bands(["red"]).climatological_normal("month", (2020, 2020))
    assert np.allclose(stack(month.anomaly(normal, "month"), "red"), 0)
    assert month.df.select(F.count_distinct("t")).first()[0] == 3


def test_bands_of_two_cubes(scene):
    cube, d = scene
    other = cube.apply(lambda v: v * 2)
    got = stack(cube.b("nir") - other.b("red"))
    assert np.allclose(got, d["nir"] - 2 * d["red"])
    assert (stack(cube.b("nir") > other.b("red")) == (d["nir"] > 2 * d["red"])).all()
