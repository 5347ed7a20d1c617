"""How a registered query is put together: fixture cubes, rounding, and the SQL twin."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..cube import Cube
from ..operators.vector import Geometries
from ..schema import Band

# The fixture views; each text runs unchanged in Spark and in DuckDB.
VIEWS = {
    "cube_long": "SELECT user_id % 15 AS x, CAST((user_id - user_id % 15) / 15 AS BIGINT) AS y, ts AS t, "
                 "event_type AS bands, value FROM events",
    "cube_daily": "SELECT user_id % 15 AS x, CAST((user_id - user_id % 15) / 15 AS BIGINT) AS y, date_trunc('day', ts) AS t, "
                  "event_type AS bands, AVG(value) AS value FROM events GROUP BY 1, 2, 3, 4",
    "cube_wide": "SELECT l_suppkey % 10 AS x, CAST((l_suppkey - l_suppkey % 10) / 10 AS BIGINT) AS y, l_shipdate AS t, "
                 "AVG(NULLIF(l_tax, 0)) AS B02, AVG(l_quantity) AS B04, AVG(l_extendedprice / 1000) AS B08, "
                 "MAX(l_linenumber) AS SCL FROM lineitem GROUP BY 1, 2, 3",
    "cube_static": "SELECT s_suppkey % 10 AS x, CAST((s_suppkey - s_suppkey % 10) / 10 AS BIGINT) AS y, s_acctbal AS elev "
                   "FROM supplier",
    "scenes": "SELECT o_orderkey AS scene_id, o_orderdate AS t, o_orderpriority AS platform, o_totalprice / 5000 AS cloud_cover "
              "FROM orders",
    "arrays": "SELECT vec_id AS id, embedding AS data, label FROM embeddings",
    "texts": "SELECT doc_id AS id, text AS data, lang, source FROM documents",
    "runs": "SELECT o_orderkey AS id, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'running' ELSE 'not_started' END "
            "AS status, CAST(o_orderdate AS STRING) AS start_time, o_totalprice AS costs FROM orders",
}
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings",
          "pages", "benchmark", "labels", "conversations")

# Zones for the polygon queries: a square, an L, a triangle, one outside the grid and an empty one.
SQUARE = [(0.5, 0.5), (4.5, 0.5), (4.5, 4.5), (0.5, 4.5), (0.5, 0.5)]
ELL = [(0, 0), (8.5, 0), (8.5, 3.5), (3.5, 3.5), (3.5, 8.5), (0, 8.5), (0, 0)]
TRIANGLE = [(0, 0), (6, 0), (0, 6), (0, 0)]
FAR = [(50, 50), (51, 50), (51, 51), (50, 51), (50, 50)]
IN_SQUARE = "(px > 0.5 AND px < 4.5 AND py > 0.5 AND py < 4.5)"
IN_ELL = "((px > 0 AND px < 8.5 AND py > 0 AND py < 3.5) OR (px > 0 AND px < 3.5 AND py > 0 AND py < 8.5))"
IN_TRIANGLE = "(px > 0 AND py > 0 AND px + py < 6)"


class Tables:
    """The given tables and the fixture cubes over them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def view(self, name: str) -> DataFrame:
        text = VIEWS[name]
        used = {t: self.table(t) for t in TABLES if re.search(rf"\b{t}\b", text)}
        for t in used:
            text = re.sub(rf"\bFROM {t}\b", f"FROM {{{t}}}", text)
        return self.spark.sql(text, **used)

    @cached_property
    def long(self) -> Cube:
        return Cube.of(self.view("cube_long"), other=("bands",), bands=["value"], band_dim=None, crs=3857)

    @cached_property
    def daily(self) -> Cube:
        df = self.view("cube_daily").withColumn("t", F.col("t").cast("timestamp_ntz"))
        return Cube.of(df, other=("bands",), bands=["value"], band_dim=None, crs=3857)

    @cached_property
    def wide(self) -> Cube:
        bands = [Band("B02", "blue", 0.4966, ("blau",)), Band("B04", "red", 0.6645), Band("B08", "nir", 0.8351), Band("SCL")]
        return Cube.of(self.view("cube_wide"), bands=bands, collection_id="SENTINEL2_L2A", crs=3857)

    @cached_property
    def optical(self) -> Cube:
        return self.wide.filter_bands(["B02", "B04", "B08"])

    @cached_property
    def shifted(self) -> Cube:
        """Pixel centres off the polygon edges."""
        c = self.optical
        return Cube(c.df.withColumns({"x": F.col("x") + F.lit(0.25), "y": F.col("y") + F.lit(0.25)}), c.schema)

    @cached_property
    def static(self) -> Cube:
        return Cube.of(self.view("cube_static"), temporal=(), bands=["elev"], band_dim=None, crs=3857)

    def zones(self, *names: str, crs: int = 3857) -> Geometries:
        shapes = {"square": (1, SQUARE), "ell": (2, ELL), "triangle": (3, TRIANGLE), "far": (4, FAR), "empty": (5, None)}
        picked = [shapes[n] for n in (names or shapes)]
        return Geometries.from_shapes(
            self.spark, [{"type": "Polygon", "id": i, "coordinates": [p] if p else []} for i, p in picked], crs)


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def _digits(spec: str) -> tuple[str, str, bool]:
    """``name``, ``name:digits`` or ``name[]`` for an array of numbers."""
    name, _, digits = spec.partition(":")
    return name.removesuffix("[]"), f"{10 ** int(digits or 6)}.0", name.endswith("[]")


def _round_column(c, scale: float):
    # values at a tie of the last digit move up on both sides, whatever the last bit is
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), c).otherwise(F.floor(c * scale + 0.5001) / scale)


def rounded(df: DataFrame, specs: list[str]) -> DataFrame:
    """Round doubles for comparison with the SQL twin: the order of summation differs between engines.

    Arrays become text, as whole numbers of the last digit kept; both engines write those alike.
    """
    out = {}
    for spec in specs:
        name, scale, is_array = _digits(spec)
        s = float(scale)
        if is_array:
            out[name] = F.array_join(F.transform(F.col(name), _element(s)), ",")
        else:
            out[name] = _round_column(F.col(name).cast("double"), s)
    return df.withColumns(out) if out else df


def _element(scale: float):
    def one(v):
        return F.coalesce(F.floor(v.cast("double") * scale + 0.5001).cast("string"), F.lit("null"))

    return one


def _sql_rounded(sql: str, specs: list[str]) -> str:
    parts = []
    for spec in specs:
        name, scale, is_array = _digits(spec)
        if is_array:
            text = f"coalesce(CAST(CAST(floor(CAST(v AS DOUBLE) * {scale} + 0.5001) AS BIGINT) AS VARCHAR), 'null')"
            parts.append(f"CASE WHEN {name} IS NOT NULL THEN coalesce(array_to_string(list_transform({name}, lambda v: {text}), ','), '') END AS {name}")
        else:
            parts.append(f"floor(CAST({name} AS DOUBLE) * {scale} + 0.5001) / {scale} AS {name}")
    return f"SELECT * REPLACE ({', '.join(parts)}) FROM (\n{sql}\n) q" if parts else sql


def with_views(sql: str) -> str:
    """Prefix the fixture views a text uses; ``STRING`` is spelled VARCHAR-compatible in both engines."""
    used = [n for n in VIEWS if re.search(rf"\b{n}\b", sql)]
    if not used:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in used) + "\n" + sql


def query(name: str, sql: str | None = None, r: list[str] | str = ()):
    """Register a query; ``r`` lists the number columns that are rounded (and made double) on both sides."""
    specs = r.split() if isinstance(r, str) else list(r)

    def add(fn: Callable[[Tables], DataFrame | Cube]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            out = fn(Tables(spark, sf_dir))
            return rounded(out if isinstance(out, DataFrame) else out.df, specs)

        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(run, with_views(_sql_rounded(sql, specs)) if sql else None)
        return fn

    return add
