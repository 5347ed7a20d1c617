"""Vector cubes: geometries with values, and the operators on them."""

from __future__ import annotations

import os
from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import errors as err
from ..schema import Band, CubeSchema
from . import geometry as geo
from .filters import bbox_condition, bbox_dict
from .projection import bbox_to, epsg, is_metric, project_point

POINT = "struct<x:double,y:double>"
PARTS = f"array<array<{POINT}>>"


def with_bounds(df: DataFrame) -> DataFrame:
    """Complete a geometry row: bounding box (null where empty) and buffer distance."""
    xs, ys = F.flatten("parts")["x"], F.flatten("parts")["y"]
    return df.withColumns({
        "minx": F.array_min(xs), "maxx": F.array_max(xs), "miny": F.array_min(ys), "maxy": F.array_max(ys),
        **({} if "buffer" in df.columns else {"buffer": F.lit(0.0)}),
    })


class Geometries:
    """A table of geometries: ``geom_id, geom_type, parts``, bounds, buffer, then properties.

    ``crs`` may be unknown; ``grown`` is the sum of the buffers so far; ``areas`` says that
    all are known to be polygons.
    """

    def __init__(self, df: DataFrame, crs: int | None = 4326, grown: float = 0.0, areas: bool = False):
        self.df = df if "minx" in df.columns else with_bounds(df)
        self.crs, self.grown, self.areas = crs, grown, areas

    @classmethod
    def from_shapes(cls, spark, shapes: list[dict], crs: int | None = None) -> "Geometries":
        """From a handful of GeoJSON-like dicts with ``type``, ``coordinates`` and an optional ``id``.

        Without a reference system they are in that of the data they meet.
        """
        depth = {"Point": 0, "MultiPoint": 1, "LineString": 1, "MultiLineString": 2, "Polygon": 2, "MultiPolygon": 3}
        rows = []
        for i, s in enumerate(shapes):
            if s["type"] not in depth:
                raise err.UnsupportedGeometry(s["type"])
            c, d = s["coordinates"], depth[s["type"]]
            parts = [[c]] if d == 0 and c else [] if d == 0 else [c] if d == 1 else c if d == 2 else [r for p in c for r in p]
            rows.append({"geom_id": s.get("id", i), "geom_type": s["type"],
                         "parts": [[{"x": float(p[0]), "y": float(p[1])} for p in ring] for ring in parts]})
        # an Arrow table becomes a local relation of known size, which Spark may broadcast by itself
        point = pa.struct([("x", pa.float64()), ("y", pa.float64())])
        table = pa.Table.from_pylist(rows, pa.schema([
            ("geom_id", pa.int64()), ("geom_type", pa.string()), ("parts", pa.list_(pa.list_(point)))]))
        return cls(spark.createDataFrame(table), crs, areas=all(r["geom_type"] in ("Polygon", "MultiPolygon") for r in rows))

    @property
    def properties(self) -> list[str]:
        return [c for c in self.df.columns if c not in geo.GEOM_FIELDS]

    def _new(self, df: DataFrame, crs: int | None = None) -> "Geometries":
        return Geometries(df, crs or self.crs, self.grown, self.areas)

    def filter_bbox(self, extent, crs: int | None = None) -> "Geometries":
        """Keep geometries whose bounding box, buffer included, lies inside the box."""
        box = bbox_dict(extent, crs)
        if box.get("crs") and self.crs and box["crs"] != self.crs:
            box = bbox_to(box, self.crs)
        ends = dict(zip(("__w", "__e"), geo.bounds("minx", "maxx"))) | dict(zip(("__s", "__n"), geo.bounds("miny", "maxy")))
        inside = self.df.withColumns(ends).where(bbox_condition(box, "__w", "__s") & bbox_condition(box, "__e", "__n"))
        return self._new(inside.drop(*ends))

    def filter_vector(self, geometries: "Geometries", relation: str = "intersects") -> "Geometries":
        """Keep geometries by their relation to the base geometries.

        ``intersects`` and ``disjoint`` look at the union of the base; ``within`` asks for
        one base polygon that holds every vertex without an edge crossing. The base is
        brought to the reference system of these geometries. Grown geometries meet where
        the outlines are no further apart than their buffers; ``within`` and shrunk areas
        would need the outline itself and are refused.
        """
        geometries = geo.aligned(geometries, self.crs)
        grown = self.grown or geometries.grown
        if grown and (relation == "within" or min(self.grown, geometries.grown) < 0):
            raise err.UnsupportedGeometry("a buffered outline is not rebuilt")
        if relation not in ("intersects", "within", "disjoint"):
            raise ValueError(f"unknown relation {relation!r}")
        fields = ("geom_id", *geo.GEOM_FIELDS[1:])
        pairs = geo.box_pairs(self.df.select(*fields).withColumn("edges", geo.edges_or_points()),
                              geometries.df.select(*fields).withColumn("edges", geo.edges_or_points()))
        a_area, b_area = F.col("geom_type").endswith("Polygon"), F.col("b_geom_type").endswith("Polygon")
        crossing = F.exists("edges", lambda s: F.exists(F.col("b_edges"), lambda q: geo.segments_cross(s, q)))
        a_first, b_first = F.flatten("parts")[0], F.flatten("b_parts")[0]
        a_in_b = b_area & geo.covers(a_first["x"], a_first["y"], F.col("b_edges"))
        b_in_a = a_area & geo.covers(b_first["x"], b_first["y"], F.col("edges"))
        reach = F.col("buffer") + F.col("b_buffer")
        if relation == "within":
            proper = F.exists("edges", lambda s: F.exists(F.col("b_edges"), lambda q: _cross_properly(s, q)))
            test = b_area & F.forall(F.flatten("parts"), lambda p: geo.covers(p["x"], p["y"], F.col("b_edges"))) & ~proper
        else:
            test = crossing | a_in_b | b_in_a
            if grown:  # outlines that don't cross are nearest at a vertex of one of them
                near = F.exists(F.flatten("parts"), lambda p: geo.distance(p["x"], p["y"], F.col("b_edges")) <= reach)
                test = test | near | F.exists(F.flatten("b_parts"), lambda p: geo.distance(p["x"], p["y"], F.col("edges")) <= reach)
        ids = pairs.where(test).select("geom_id").distinct()
        how = "left_anti" if relation == "disjoint" else "left_semi"
        return self._new(self.df.join(ids, "geom_id", how))

    def vector_buffer(self, distance: float) -> "Geometries":
        """Grow (or with a negative distance shrink) the area the geometries cover.

        The outline is not rebuilt: the distance is kept with the geometry, and bounds,
        filters and all pixel tests (zonal statistics, masks, burning) honour it exactly.
        Buffers of one sign add up; growing after shrinking (or the other way round) and
        reprojecting a buffered geometry would need the outline and are refused.
        """
        if self.crs is not None and not is_metric(self.crs):
            raise err.UnitMismatch(f"EPSG:{self.crs} is not in metres")
        if self.grown * distance < 0:
            raise err.UnsupportedGeometry("growing and shrinking in turn needs the outline")
        return Geometries(self.df.withColumn("buffer", F.col("buffer") + float(distance)), self.crs, self.grown + float(distance))

    def vector_reproject(self, projection) -> "Geometries":
        """Project all vertices; buffer afterwards, a distance has no meaning in another system."""
        target = epsg(projection)
        if self.crs is None:
            raise err.CrsUnknown("geometries without a reference system")
        if self.grown and target != self.crs:
            raise err.UnsupportedGeometry("reproject first, then buffer")
        df = self.df.withColumn("parts", F.transform("parts", lambda ring: F.transform(
            ring, lambda p: project_point(p, self.crs, target))))
        return self._new(with_bounds(df), target)

    def vector_to_regular_points(self, distance: float, group: bool = True) -> "Geometries":
        """Regular sample points: cell centres in polygons, steps along lines, points as they are."""
        if not is_metric(self.crs):
            raise err.UnitMismatch(f"EPSG:{self.crs} is not in metres")
        d = float(distance)
        df = self.df.where(F.col("minx").isNotNull()).withColumn("edges", geo.edges(F.col("parts")))

        def axis(n: Column):
            return F.sequence(F.lit(0).cast("long"), F.greatest(F.ceil(n / d) - 1, F.lit(0).cast("long")))

        # one row per column of the grid keeps the arrays short
        area = df.where(F.col("geom_type").endswith("Polygon")).withColumn(
            "__k", F.explode(axis(F.col("maxx") - F.col("minx"))))
        px = F.col("minx") + (F.col("__k") + 0.5) * d
        line = F.transform(axis(F.col("maxy") - F.col("miny")), lambda l: F.struct(
            px.alias("x"), (F.col("maxy") - (l + 0.5) * d).alias("y")))
        found = F.filter(line, lambda p: geo.covers(p["x"], p["y"], F.col("edges")))
        columns = area.withColumn("__p", found)
        grid = columns.select("geom_id", F.explode("__p").alias("p"))
        first = df.where(F.col("geom_type").endswith("Polygon")).select("geom_id", F.flatten("parts")[0].alias("p"))
        first = first.join(grid.select("geom_id").distinct(), "geom_id", "left_anti")
        # sides of a line with the length before them, as rows
        walk = df.where(F.col("geom_type").endswith("LineString")).select("geom_id", F.posexplode("edges").alias("__i", "s"))
        before = Window.partitionBy("geom_id").orderBy("__i").rowsBetween(Window.unboundedPreceding, -1)
        walk = walk.withColumn("n", _length(F.col("s"))).withColumn("at", F.coalesce(F.sum("n").over(before), F.lit(0.0)))
        low, high = F.ceil(F.col("at") / d - 1e-9), F.ceil((F.col("at") + F.col("n")) / d - 1e-9) - 1
        step = (F.col("__k") * d - F.col("at")) / F.col("n")
        lines = walk.withColumn("__k", F.explode(F.when(low <= high, F.sequence(low, high)))).select("geom_id", F.struct(
            (F.col("s.ax") + step * (F.col("s.bx") - F.col("s.ax"))).alias("x"),
            (F.col("s.ay") + step * (F.col("s.by") - F.col("s.ay"))).alias("y")).alias("p"))
        dots = df.where(F.col("geom_type").endswith("Point")).select("geom_id", F.explode(F.flatten("parts")).alias("p"))
        points = grid.unionByName(first).unionByName(lines).unionByName(dots)
        return self._points(points, group)

    def vector_to_random_points(self, geometry_count: int | None = None, total_count: int | None = None,
                                group: bool = True, seed: int | None = None, strict: bool = True) -> "Geometries":
        """n random points per polygon or line, or in total shared out evenly; the same seed gives the same points.

        A total below the number of geometries fails with ``CountMismatch``; if not ``strict``,
        the even share is then none, as the total is a maximum.

        A polygon is cut into trapezoids, every point is drawn in one of them by area, so no
        try is lost however little of its box the polygon fills; one without area gives
        points on its sides. Points give at most their own points.
        """
        df = self.df.where(F.col("minx").isNotNull()).withColumn("edges", geo.edges(F.col("parts")))
        seed = seed if seed is not None else int.from_bytes(os.urandom(4), "big")
        want = F.lit(geometry_count).cast("long") if geometry_count is not None else None
        if total_count is not None:
            n = df.agg(F.count(F.lit(1)).alias("n")).scalar()
            even = F.floor(F.lit(total_count) / n)
            if strict:
                even = F.when(n > total_count, F.raise_error(F.lit("CountMismatch"))).otherwise(even)
            want = even if want is None else F.least(want, even)
        if want is None:
            raise err.CountMismatch("give geometry_count or total_count")
        area, dots = F.col("geom_type").endswith("Polygon"), F.col("geom_type").endswith("Point")

        def unit(salt: str) -> Column:
            return (F.pmod(F.xxhash64("geom_id", F.col("__n"), F.lit(salt), F.lit(seed)), F.lit(1 << 40))) / float(1 << 40)

        # one light row per wanted point, dealt in runs so that no array is as long as their number
        light = df.select("geom_id", area.alias("__area"), dots.alias("__dots"), F.size("edges").cast("long").alias("__sides"), want.alias("__want"))
        runs = light.withColumn("__run", F.explode(F.when(F.col("__want") > 0, F.sequence(F.lit(0).cast("long"), F.floor((F.col("__want") - 1) / POINT_RUN)))))
        first = F.col("__run") * POINT_RUN + 1
        tries = runs.withColumn("__n", F.explode(F.sequence(first, F.least(F.col("__want"), first + POINT_RUN - 1))))
        tries = tries.withColumn("__u", unit("t")).withColumns({
            "__bucket": F.floor(F.col("__u") * F.col("__sides")),
            "__at": F.when(F.col("__dots"), F.col("__n") - 1).otherwise(F.floor(unit("e") * F.col("__sides")))})

        # trapezoids meet points in as many buckets of the running area as the polygon has sides
        cut = df.where(area).select("geom_id", "edges").mapInArrow(_trapezoid_rows, _TRAPEZOIDS)
        spread = cut.withColumn("t_bucket", F.explode(F.sequence(
            F.greatest(F.lit(0), F.floor(F.col("since") * F.col("sides") - 1e-6)), F.floor(F.col("upto") * F.col("sides") + 1e-6)))).drop("sides")
        spread = spread.withColumnRenamed("geom_id", "t_geom")
        drawn = tries.join(spread, (F.col("geom_id") == F.col("t_geom")) & (F.col("__bucket") == F.col("t_bucket"))
                           & (F.col("since") <= F.col("__u")) & (F.col("__u") < F.col("upto")), "left")
        sides = df.where(~dots).select(F.col("geom_id").alias("s_geom"), F.posexplode("edges").alias("s_at", "s")).select(
            "s_geom", F.col("s_at").cast("long").alias("s_at"), *[F.col(f"s.{c}").alias(c) for c in ("ax", "ay", "bx", "by")])
        own = df.where(dots).select(F.col("geom_id").alias("s_geom"), F.posexplode(F.flatten("parts")).alias("s_at", "s")).select(
            "s_geom", F.col("s_at").cast("long").alias("s_at"), *[F.col(f"s.{c}").alias(f"{end}{c}") for end in "ab" for c in "xy"])
        drawn = drawn.join(sides.unionByName(own), (F.col("geom_id") == F.col("s_geom")) & (F.col("__at") == F.col("s_at")), "left")

        u, t = unit("x"), F.col
        h0, h1, v = t("top0") - t("low0"), t("top1") - t("low1"), u + 0.5 / float(1 << 40)
        s = v * (h0 + h1) / (h0 + F.sqrt(h0 * h0 + v * (h1 * h1 - h0 * h0)))  # share of the width, by area
        low, top = t("low0") + s * (t("low1") - t("low0")), t("top0") + s * (t("top1") - t("top0"))
        p = F.when(t("x0").isNotNull(), F.struct((t("x0") + s * (t("x1") - t("x0"))).alias("x"), (low + unit("y") * (top - low)).alias("y"))).when(
            t("ax").isNotNull(), F.struct((t("ax") + u * (t("bx") - t("ax"))).alias("x"), (t("ay") + u * (t("by") - t("ay"))).alias("y")))
        points = drawn.select("geom_id", F.when(F.col("__area"), F.col("__n")).alias("__k"), p.alias("p")).where(F.col("p").isNotNull())
        return self._points(points.distinct().select("geom_id", "p"), group)

    def _points(self, points: DataFrame, group: bool) -> "Geometries":
        if group:
            df = points.groupBy("geom_id").agg(F.array(F.array_sort(F.collect_list("p"))).alias("parts"))
            df = df.withColumn("geom_type", F.lit("MultiPoint"))
        else:
            df = points.select(F.lit(None).cast("long").alias("geom_id"), F.array(F.array("p")).alias("parts"))
            df = df.withColumn("geom_type", F.lit("Point"))
        return self._new(with_bounds(df.select("geom_id", "geom_type", "parts")))

    def vector_to_raster(self, target):
        """Burn the geometries into the grid of a cube; where several hit, the highest id wins."""
        schema = target.schema
        x, y = schema.xy
        pixels = target.df.select(x, y).distinct()
        burned = geo.pixel_hits(target, self, pixels).groupBy(x, y).agg(F.max("geom_id").alias("value"))
        out = pixels.join(burned, [x, y], "left")
        dims = tuple(d for d in schema.dims if d.name in (x, y))
        return type(target)(out, CubeSchema(dims=dims, bands=(Band("value"),)))


POINT_RUN = 4096  # wanted points that one row stands for before it is taken apart
_TRAPEZOIDS = "geom_id long, sides long, x0 double, x1 double, low0 double, low1 double, top0 double, top1 double, since double, upto double"


def _trapezoids(e: np.ndarray) -> np.ndarray:
    """What lies within the sides (by the even-odd rule) as trapezoids ``x0, x1, low0, low1, top0, top1`` between vertical lines.

    A line sweeps over the corners and carries the sides it crosses; a strip costs as much
    as it has sides. Sides that cross within a strip cut it once more: where there is a
    crossing, two neighbours by their height in the middle have one.
    """
    e = np.where((e[:, 0] > e[:, 2])[:, None], e[:, [2, 3, 0, 1]], e)
    e = e[e[:, 0] < e[:, 2]]
    e = e[np.argsort(e[:, 0], kind="stable")]
    slope = (e[:, 3] - e[:, 1]) / (e[:, 2] - e[:, 0])
    cuts = np.unique(e[:, [0, 2]])
    begins = np.searchsorted(e[:, 0], cuts, side="right")  # sides met up to each line
    active, known, out = np.empty(0, np.int64), 0, []
    for k in range(len(cuts) - 1):
        active = np.concatenate([active[e[active, 2] > cuts[k]], np.arange(known, begins[k])])
        known = begins[k]
        if len(active) < 2:
            continue
        q, m = e[active], slope[active]
        strips = [(cuts[k], cuts[k + 1])]
        while strips:
            x0, x1 = strips.pop()
            y0, y1 = (np.where(x == q[:, 2], q[:, 3], q[:, 1] + m * (x - q[:, 0])) for x in (x0, x1))
            order = np.argsort(y0 + y1, kind="stable")
            y0, y1 = y0[order], y1[order]
            d0, d1 = np.diff(y0), np.diff(y1)
            crossed = d0 * d1 < 0
            if crossed.any():
                at = np.unique(x0 + (x1 - x0) * (d0[crossed] / (d0[crossed] - d1[crossed])))
                at = at[(at > x0 + 1e-9 * (x1 - x0)) & (at < x1 - 1e-9 * (x1 - x0))]
                if len(at):
                    bounds = [x0, *at, x1]
                    strips.extend(list(zip(bounds[:-1], bounds[1:]))[::-1])
                    continue
            n = len(y0) // 2 * 2
            low0, low1 = y0[0:n:2], y1[0:n:2]
            out.append(np.stack([np.full(n // 2, x0), np.full(n // 2, x1), low0, low1,
                                 np.maximum(low0, y0[1:n:2]), np.maximum(low1, y1[1:n:2])], axis=1))
    return np.concatenate(out) if out else np.empty((0, 6))


def _trapezoid_rows(batches):
    """A row per trapezoid, with the shares of the polygon's area before and behind it."""
    names = [field.split()[0] for field in _TRAPEZOIDS.split(", ")]
    for batch in batches:
        for geom_id, edges in zip(batch.column("geom_id"), batch.column("edges")):
            if not edges.is_valid or not len(edges):
                continue
            flat = edges.values
            sides = np.stack([flat.field(c).to_numpy(zero_copy_only=False) for c in ("ax", "ay", "bx", "by")], axis=1)
            traps = _trapezoids(sides.astype(float))
            upto = np.cumsum((traps[:, 4] - traps[:, 2] + traps[:, 5] - traps[:, 3]) / 2 * (traps[:, 1] - traps[:, 0]))
            if not len(upto) or not upto[-1] > 0:
                continue
            since = np.concatenate([[0.0], upto[:-1]])
            kept = upto > since
            shares = [since[kept] / upto[-1], upto[kept] / upto[-1]]
            columns = [pa.array([geom_id.as_py()] * int(kept.sum()), pa.int64()), pa.array(np.full(int(kept.sum()), len(sides)))]
            columns += [pa.array(c) for c in (*traps[kept].T, *shares)]
            yield from pa.Table.from_arrays(columns, names=names).to_batches(max_chunksize=8192)


def _cross_properly(s: Column, q: Column) -> Column:
    """Segments that cross in the inner of both."""
    def side(a: Column, x: Column, y: Column) -> Column:
        return F.signum((a["bx"] - a["ax"]) * (y - a["ay"]) - (a["by"] - a["ay"]) * (x - a["ax"]))

    return (side(s, q["ax"], q["ay"]) * side(s, q["bx"], q["by"]) < 0) & (side(q, s["ax"], s["ay"]) * side(q, s["bx"], s["by"]) < 0)


def _length(s: Column) -> Column:
    return F.sqrt((s["bx"] - s["ax"]) * (s["bx"] - s["ax"]) + (s["by"] - s["ay"]) * (s["by"] - s["ay"]))


class VectorCube:
    """Values per geometry (and other labels) with the geometry table they belong to."""

    def __init__(self, df: DataFrame, schema: CubeSchema, geometries: Geometries):
        self.df, self.schema, self.geometries = df, schema, geometries

    def _cube(self):
        from ..cube import Cube

        return Cube(self.df, self.schema)

    def _back(self, cube) -> "VectorCube":
        return VectorCube(cube.df, cube.schema, self.geometries)

    def apply_dimension(self, process, dimension: str, target_dimension: str | None = None) -> "VectorCube":
        return self._back(self._cube().apply_dimension(process, dimension, target_dimension))

    def filter_bands(self, bands) -> "VectorCube":
        return self._back(self._cube().filter_bands(bands))

    def filter_labels(self, condition, dimension: str) -> "VectorCube":
        return self._back(self._cube().filter_labels(condition, dimension))

    def filter_bbox(self, extent, crs: int | None = None) -> "VectorCube":
        kept = self.geometries.filter_bbox(extent, crs)
        return VectorCube(self.df.join(kept.df.select("geom_id"), "geom_id", "left_semi"), self.schema, kept)

    def filter_vector(self, geometries: Geometries, relation: str = "intersects") -> "VectorCube":
        kept = self.geometries.filter_vector(geometries, relation)
        return VectorCube(self.df.join(kept.df.select("geom_id"), "geom_id", "left_semi"), self.schema, kept)

    def timeseries_table(self, labels: list | None = None, index: str = "date", auto_collapse: bool = True, strict: bool = False) -> DataFrame:
        """Wide table of a zonal series, indexed by date or polygon.

        ``labels`` are the labels that become columns: geometry ids for a date index, the
        times for a polygon index. Without them they are found in the data (one aggregate;
        more than Spark's ``spark.sql.pivotMaxValues`` is an error, as columns are part of
        the plan). Columns are ``<label>`` when there is one band (and ``auto_collapse``),
        else ``<label>_<band>``; where a date index finds a single polygon in the data, they
        are the bands alone. Missing values are null. ``strict`` refuses series without
        rows, without a polygon at some date, with different polygons over the dates, or
        without any value.
        """
        if index not in ("date", "polygon"):
            raise ValueError(index)
        t = self.schema.only("temporal")
        rows, cols = (t, "geom_id") if index == "date" else ("geom_id", t)
        if strict:
            self._check_series(t)
        found = labels is None
        if found:
            labels = self._labels(cols)
        if not labels or not self.schema.values:
            raise err.InvalidTimeSeries("no labels or no bands")
        single = auto_collapse and len(self.schema.values) == 1
        alone = auto_collapse and found and index == "date" and len(labels) == 1
        text = F.col(cols).cast("string")

        def name(label, v: str) -> str:
            return v if alone else str(label) if single else f"{label}_{v}"

        aggs = [F.max(F.when(text == F.lit(str(label)), F.col(v))).alias(name(label, v)) for label in labels for v in self.schema.values]
        return self.df.where(F.col(rows).isNotNull()).groupBy(rows).agg(*aggs)

    def _labels(self, dimension: str) -> list[str]:
        """The labels of a dimension in their own order, as text; as many as a table may have columns."""
        most = int(self.df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
        known = self.df.where(F.col(dimension).isNotNull()).groupBy(dimension).agg(F.first(F.col(dimension).cast("string")).alias("__label"))
        out = [r["__label"] for r in known.orderBy(dimension).limit(most + 1).select("__label").collect()]
        if len(out) > most:
            raise err.InvalidTimeSeries(f"more than {most} labels in {dimension}: name the wanted ones")
        return out

    def _check_series(self, t: str) -> None:
        """One pass over the series: counts of polygons by date, and of values."""
        values = F.greatest(F.lit(0), *[F.count(v) for v in self.schema.values]) if self.schema.values else F.lit(0)
        by_date = self.df.where(F.col(t).isNotNull()).groupBy(t).agg(F.count_distinct("geom_id").alias("n"), values.alias("v"))
        facts = by_date.agg(F.count(F.lit(1)).alias("dates"), F.min("n").alias("low"), F.max("n").alias("high"), F.sum("v").alias("v")).first()
        if not facts["dates"]:
            raise err.InvalidTimeSeries("empty data set")
        if not facts["high"]:
            raise err.InvalidTimeSeries("no polygon at any date")
        if not facts["low"]:
            raise err.InvalidTimeSeries("no polygon at some dates")
        if facts["low"] != facts["high"]:
            raise err.InvalidTimeSeries(f"between {facts['low']} and {facts['high']} polygons at a date")
        if not facts["v"]:
            raise err.InvalidTimeSeries("no value in any band")

    def rename_bands(self, names: dict) -> "VectorCube":
        bands = tuple(replace(b, name=names.get(b.name, b.name)) for b in self.schema.bands)
        df = self.df.withColumnsRenamed(names)
        return VectorCube(df, replace(self.schema, bands=bands), self.geometries)


def split_area(spark, aoi: dict | Geometries, projection=None, tile_size: float | None = None, tile_grid: Geometries | None = None) -> DataFrame:
    """Tiles of an area: of one size from its lower-left corner, cut at the edge, or from a given grid.

    ``aoi`` is a bounding box or polygons; each polygon is tiled by its own box. Tiles that
    do not touch their polygon are left out.
    """
    if tile_grid is not None:
        if projection is not None or tile_size is not None:
            raise err.SplitError("tile_grid excludes projection and tile_size")
        area = aoi if isinstance(aoi, Geometries) else box_geometry(spark, aoi)
        if area.crs != tile_grid.crs:
            area = area.vector_reproject(tile_grid.crs)
        return tile_grid.filter_vector(area, "intersects").df.select("geom_id", "minx", "miny", "maxx", "maxy")
    if tile_size is None or projection is None:
        raise err.SplitError("give tile_grid, or tile_size and projection")
    if tile_size <= 0:
        raise err.SplitError(f"tile size {tile_size}")
    target = epsg(projection)
    area = aoi if isinstance(aoi, Geometries) else box_geometry(spark, aoi)
    if area.crs != target:
        area = area.vector_reproject(target)
    size = float(tile_size)
    df = area.df.where(F.col("minx").isNotNull()).withColumn("edges", geo.edges(F.col("parts")))

    def count(low: str, high: str) -> Column:
        return F.ceil(F.round((F.col(high) - F.col(low)) / size, 10)).cast("long")

    tiles = df.withColumn("col", F.explode(F.sequence(F.lit(0).cast("long"), count("minx", "maxx") - 1)))
    tiles = tiles.withColumn("row", F.explode(F.sequence(F.lit(0).cast("long"), count("miny", "maxy") - 1)))
    tiles = tiles.withColumns({
        "west": F.col("minx") + F.col("col") * size, "south": F.col("miny") + F.col("row") * size,
        "east": F.least(F.col("minx") + (F.col("col") + 1) * size, F.col("maxx")),
        "north": F.least(F.col("miny") + (F.col("row") + 1) * size, F.col("maxy"))})
    corners = [("west", "south"), ("east", "south"), ("east", "north"), ("west", "north")]
    sides = F.array(*[F.struct(F.col(a[0]).alias("ax"), F.col(a[1]).alias("ay"), F.col(b[0]).alias("bx"), F.col(b[1]).alias("by"))
                      for a, b in zip(corners, corners[1:] + corners[:1])])
    touches = F.exists(sides, lambda s: F.exists(F.col("edges"), lambda q: geo.segments_cross(s, q)))
    in_area = geo.covers(F.col("west"), F.col("south"), F.col("edges"))
    holds = F.exists(F.flatten("parts"), lambda p: p["x"].between(F.col("west"), F.col("east")) & p["y"].between(F.col("south"), F.col("north")))
    return tiles.where(touches | in_area | holds).select("geom_id", "col", "row", "west", "south", "east", "north")


def box_geometry(spark, box: dict) -> Geometries:
    """A bounding box as one polygon, or two where it crosses the antimeridian."""
    from .filters import normalize_longitudes

    b = bbox_dict(box)
    crs = b.get("crs", 4326)
    spans = [(b["west"], b["east"])]
    if crs == 4326:
        west, east = normalize_longitudes(b["west"], b["east"])
        spans = [(west, east)] if west <= east else [(west, 180.0), (-180.0, east)]
    shapes = [{"type": "Polygon", "id": i, "coordinates": [[
        (w, b["south"]), (e, b["south"]), (e, b["north"]), (w, b["north"]), (w, b["south"])]]} for i, (w, e) in enumerate(spans)]
    return Geometries.from_shapes(spark, shapes, crs)
