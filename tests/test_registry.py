"""Registered queries against their SQL twins on the smallest tables.

A spread of them runs by default; set CUBELOOM_ALL=1 for all. ``tools/check.py`` does the
same at any scale.
"""

import importlib.util
import os

import duckdb
import pytest

import __spark_entry__ as entry
from cubeloom.registry.base import TABLES

SF = "/root/testdata/sf0.001"
ALL = bool(os.environ.get("CUBELOOM_ALL"))
SOME = ["load_collection", "ndvi", "aggregate_temporal_period_month", "aggregate_spatial", "merge_cubes", "apply_kernel", "median", "cumsum",
        "resample_cube_temporal", "mask_polygon", "raster_to_vector", "array_modify", "date_shift", "compute_indices", "load_stac", "split_area"]
CHECK = importlib.util.spec_from_file_location("check", os.path.join(os.path.dirname(__file__), "..", "tools", "check.py"))
check = importlib.util.module_from_spec(CHECK)
CHECK.loader.exec_module(check)

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_twin_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(SOME) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if ALL else SOME)
def test_twin(spark, duck, name):
    frame = entry.queries()[name](spark, SF)
    sql = entry.oracle_sql()[name]
    types = {r[0]: r[1] for r in duck.execute("DESCRIBE " + sql).fetchall()}
    assert sorted(types) == sorted(frame.columns)
    assert check.lines(frame.columns, frame.collect()) == check.lines(list(types), duck.execute(sql).fetchall())
    assert [(c, k) for c, k in frame.dtypes if not check.same_type(k, types[c])] == []
