import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cubeloom import Cube, build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
        "spark.sql.adaptive.coalescePartitions.enabled": "true"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def txy(spark):
    """Cube of t, x, y labels with value = offset + tf * i_t + xf * i_x + yf * i_y."""
    import datetime as dt

    def make(ts=(2018, 2019, 2020, 2021), xs=(2, 3), ys=(10, 20, 30), offset=0.0, tf=100.0, xf=10.0, yf=1.0, name="value"):
        rows = [(x, y, dt.datetime(t, 1, 1), offset + tf * it + xf * ix + yf * iy)
                for it, t in enumerate(ts) for ix, x in enumerate(xs) for iy, y in enumerate(ys)]
        df = spark.createDataFrame(rows, f"x long, y long, t timestamp_ntz, {name} double")
        return Cube.of(df, bands=[name], band_dim=None)

    return make


def values(cube_or_df, *cols):
    """Rows as a sorted list of tuples."""
    df = getattr(cube_or_df, "df", cube_or_df)
    rows = [tuple(r) for r in (df.select(*cols) if cols else df).collect()]
    return sorted(rows, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


@pytest.fixture(name="values")
def values_fixture():
    return values
