"""Queries for focal operators, vectors, learning and curves."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..cube import Cube
from ..operators import learn
from ..operators.geometry import pixel_hits
from ..operators.vector import PARTS, Geometries, split_area
from ..session import scratch_path
from ..sources import files
from ..sources.geojson import load_geojson
from .base import IN_ELL, IN_SQUARE, IN_TRIANGLE, query

# -- focal

KERNEL = [[1, 2, 1], [0, 3, 0], [2, 1, 4]]
_K = ", ".join(f"({a - 1}, {b - 1}, {w})" for b, row in enumerate(KERNEL) for a, w in enumerate(row))
_EXT = "(SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM {cube}) e"


@query("apply_kernel", f"""SELECT c.x, c.y, c.t, 0.5 * sum(k.w * CASE WHEN c.x + k.dx < e.x0 OR c.x + k.dx > e.x1 OR c.y + k.dy < e.y0 OR c.y + k.dy > e.y1 THEN 3
ELSE coalesce(n.B04, 0) END) AS B04 FROM cube_wide c CROSS JOIN (VALUES {_K}) k(dx, dy, w) CROSS JOIN {_EXT.format(cube="cube_wide")}
LEFT JOIN cube_wide n ON n.t = c.t AND n.x = c.x + k.dx AND n.y = c.y + k.dy GROUP BY c.x, c.y, c.t""", "B04")
def _(t):
    return t.wide.filter_bands(["B04"]).apply_kernel(KERNEL, factor=0.5, border=3)


@query("apply_kernel_replace_invalid", f"""SELECT c.x, c.y, c.t, sum(k.w * CASE WHEN c.x + k.dx < e.x0 OR c.x + k.dx > e.x1 OR c.y + k.dy < e.y0 OR c.y + k.dy > e.y1 THEN 0
ELSE coalesce(n.B02, 0.5) END) AS B02 FROM cube_wide c CROSS JOIN (VALUES {_K}) k(dx, dy, w) CROSS JOIN {_EXT.format(cube="cube_wide")}
LEFT JOIN cube_wide n ON n.t = c.t AND n.x = c.x + k.dx AND n.y = c.y + k.dy GROUP BY c.x, c.y, c.t""", "B02")
def _(t):
    return t.wide.filter_bands(["B02"]).apply_kernel(KERNEL, replace_invalid=0.5)


def _mapped(border: str, u: str, n: str) -> str:
    m2 = f"((({u}) % (2 * ({n})) + 2 * ({n})) % (2 * ({n})))"
    mp = f"((({u}) % (2 * ({n}) - 2) + 2 * ({n}) - 2) % (2 * ({n}) - 2))"
    return {"replicate": f"least(greatest({u}, 0), ({n}) - 1)", "wrap": f"((({u}) % ({n}) + ({n})) % ({n}))",
            "reflect": f"least({m2}, 2 * ({n}) - 1 - {m2})", "reflect_pixel": f"least({mp}, 2 * ({n}) - 2 - {mp})"}[border]


WIDE_KERNEL = [[1, 2, 1, 0, 2], [0, 3, 0, 1, 1], [2, 1, 4, 1, 3], [1, 1, 0, 2, 1], [3, 0, 1, 1, 2]]
_K5 = ", ".join(f"({a - 2}, {b - 2}, {w})" for b, row in enumerate(WIDE_KERNEL) for a, w in enumerate(row))
for _border in ("replicate", "reflect", "reflect_pixel", "wrap"):
    def _bordered(border=_border):
        mx, my = _mapped(border, "c.x + k.dx", "e.x1 + 1"), _mapped(border, "c.y + k.dy", "e.y1 + 1")

        @query(f"apply_kernel_{border}", f"""SELECT c.x, c.y, sum(k.w * n.elev) / 100 AS elev FROM cube_static c CROSS JOIN (VALUES {_K5}) k(dx, dy, w)
CROSS JOIN {_EXT.format(cube="cube_static")} JOIN cube_static n ON n.x = {mx} AND n.y = {my} GROUP BY c.x, c.y""", "elev")
        def _(t):
            return t.static.apply_kernel(WIDE_KERNEL, factor=0.01, border=border)

    _bordered()

_GRAD = f"""(SELECT c.x, c.y, sum(k.gx * n.elev) / 80 AS dx, sum(k.gy * n.elev) / 80 AS dy FROM (SELECT x, y, elev / 1000 AS elev FROM cube_static) c
CROSS JOIN (VALUES (-1,-1,-1,-1),(0,-1,0,-2),(1,-1,1,-1),(-1,0,-2,0),(1,0,2,0),(-1,1,-1,1),(0,1,0,2),(1,1,1,1)) k(ox, oy, gx, gy) CROSS JOIN {_EXT.format(cube="cube_static")}
JOIN (SELECT x, y, elev / 1000 AS elev FROM cube_static) n ON n.x = least(greatest(c.x + k.ox, e.x0), e.x1) AND n.y = least(greatest(c.y + k.oy, e.y0), e.y1) GROUP BY c.x, c.y) g"""


def _terrain(t) -> Cube:
    # pixels of ten units, so that the step is part of the check
    df = t.static.df.withColumns({"x": F.col("x") * 10, "y": F.col("y") * 10, "elev": F.col("elev") / 1000})
    return Cube.of(df, temporal=(), bands=["elev"], band_dim=None, step=10.0)


@query("slope", f"SELECT x * 10 AS x, y * 10 AS y, atan(sqrt(dx * dx + dy * dy)) AS elev_slope FROM {_GRAD}", "elev_slope")
def _(t):
    return _terrain(t).slope()


@query("aspect", f"""SELECT x * 10 AS x, y * 10 AS y, CASE WHEN dx = 0 AND dy = 0 THEN CAST('NaN' AS DOUBLE) WHEN atan2(-dx, -dy) < 0 THEN atan2(-dx, -dy) + 2 * pi()
ELSE atan2(-dx, -dy) END AS elev_aspect FROM {_GRAD}""", "elev_aspect")
def _(t):
    return _terrain(t).aspect()


# a side is on an outline exactly when the cell across it is missing or has another value
_SIDES = """SELECT c.t, CAST(c.SCL AS DOUBLE) AS value, c.x + s.x1 AS x1, c.y + s.y1 AS y1, c.x + s.x2 AS x2, c.y + s.y2 AS y2 FROM cube_wide c
CROSS JOIN (VALUES (0, -1, -0.5::DOUBLE, -0.5::DOUBLE, 0.5::DOUBLE, -0.5::DOUBLE), (0, 1, -0.5, 0.5, 0.5, 0.5), (-1, 0, -0.5, -0.5, -0.5, 0.5), (1, 0, 0.5, -0.5, 0.5, 0.5)) s(dx, dy, x1, y1, x2, y2)
LEFT JOIN cube_wide n ON n.t = c.t AND n.x = c.x + s.dx AND n.y = c.y + s.dy AND n.SCL = c.SCL WHERE n.x IS NULL"""


@query("raster_to_vector", _SIDES)
def _(t):
    return t.wide.band("SCL").raster_to_vector().select("t", F.col("value").cast("double").alias("value"), "x1", "y1", "x2", "y2")


_AREAS = """WITH RECURSIVE cells AS (
  SELECT CAST(x - (SELECT min(x) FROM cube_static) AS BIGINT) AS i, CAST(y - (SELECT min(y) FROM cube_static) AS BIGINT) AS j, x, y, floor(elev / 4000) AS value,
         (SELECT max(x) - min(x) + 1 FROM cube_static) AS w FROM cube_static
), reach AS (
  SELECT i, j, i AS ri, j AS rj, value FROM cells
  UNION
  SELECT r.i, r.j, c.i, c.j, r.value FROM reach r JOIN cells c ON c.value = r.value AND abs(c.i - r.ri) + abs(c.j - r.rj) = 1
), owned AS (
  SELECT c.i, c.j, c.x, c.y, c.value, min(r.rj * c.w + r.ri) AS area FROM cells c JOIN reach r ON r.i = c.i AND r.j = c.j GROUP BY c.i, c.j, c.x, c.y, c.value, c.w
), sides AS (
  SELECT o.area, o.value, o.x, o.y, d.di, d.dj FROM owned o, (VALUES (1, 0), (-1, 0), (0, 1), (0, -1)) d(di, dj)
  WHERE NOT EXISTS (SELECT 1 FROM owned n WHERE n.area = o.area AND n.i = o.i + d.di AND n.j = o.j + d.dj)
)
"""


@query("raster_to_polygons", _AREAS + """SELECT s.area AS geom_id, ':' || s.area AS feature_id, max(s.value) AS value,
  (SELECT count(*) FROM owned o WHERE o.area = s.area)::DOUBLE AS area, count(*)::DOUBLE AS outline,
  min(s.x) - 0.5 AS west, min(s.y) - 0.5 AS south, max(s.x) + 0.5 AS east, max(s.y) + 0.5 AS north FROM sides s GROUP BY s.area""",
       "value area outline west south east north")
def _(t):
    """Area (holes taken off) and length of the outline from the rings; both are off if a ring is chained or turned wrongly."""
    shapes = t.static.apply(lambda v: F.floor(v / 4000)).raster_to_polygons()
    pairs = F.flatten(F.transform("parts", lambda r: F.zip_with(F.slice(r, 1, F.size(r) - 1), F.slice(r, 2, F.size(r) - 1), lambda p, q: F.struct(
        (p["x"] * q["y"] - q["x"] * p["y"]).alias("a"), (F.abs(q["x"] - p["x"]) + F.abs(q["y"] - p["y"])).alias("l")))))
    total = lambda c, f: F.aggregate(F.transform(c, lambda p: p[f]), F.lit(0.0), lambda s, v: s + v)
    return shapes.df.select("geom_id", "feature_id", F.col("value").cast("double").alias("value"), (total(pairs, "a") / 2).alias("area"), total(pairs, "l").alias("outline"),
                            F.col("minx").alias("west"), F.col("miny").alias("south"), F.col("maxx").alias("east"), F.col("maxy").alias("north"))


@query("raster_to_vector_features", _AREAS + """SELECT ':' || area AS feature_id, max(value) AS value, count(*) AS sides,
  min(x) - 0.5 AS west, min(y) - 0.5 AS south, max(x) + 0.5 AS east, max(y) + 0.5 AS north FROM sides GROUP BY area""",
       "value west south east north")
def _(t):
    lines = t.static.apply(lambda v: F.floor(v / 4000)).raster_to_vector()
    return lines.groupBy("feature_id").agg(F.max("value").alias("value"), F.count(F.lit(1)).alias("sides"), F.min("x1").alias("west"), F.min("y1").alias("south"),
                                           F.max("x2").alias("east"), F.max("y2").alias("north"))


# -- vectors: one plot per supplier, by turns a rectangle, a line and a point


def plots(t, kinds=("Polygon", "LineString", "Point"), crs: int = 3857) -> Geometries:
    s = t.table("supplier")
    x, y = (F.col("s_suppkey") % 10 * 100).cast("double"), (F.floor(F.col("s_suppkey") / 10) * 100).cast("double")
    w = (F.lit(45.0) + F.col("s_suppkey") % 7 * 15)

    def p(dx, dy):
        return F.struct((x + dx).alias("x"), (y + dy).alias("y"))

    zero = F.lit(0.0)
    kind = F.element_at(F.array(F.lit("Polygon"), F.lit("LineString"), F.lit("Point")), (F.col("s_suppkey") % 3 + 1).cast("int"))
    parts = F.when(kind == "Polygon", F.array(F.array(p(zero, zero), p(w, zero), p(w, F.lit(75.0)), p(zero, F.lit(75.0)), p(zero, zero)))).when(
        kind == "LineString", F.array(F.array(p(zero, zero), p(w, zero), p(w, F.lit(60.0))))).otherwise(F.array(F.array(p(F.lit(10.0), F.lit(20.0)))))
    df = s.select(F.col("s_suppkey").alias("geom_id"), kind.alias("geom_type"), parts.cast(PARTS).alias("parts"),
                  F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"))
    return Geometries(df.where(F.col("geom_type").isin(*kinds)), crs)


_PLOT = """(SELECT s_suppkey AS geom_id, s_suppkey % 3 AS k, CAST(s_suppkey % 10 * 100 AS DOUBLE) AS x, CAST(s_suppkey // 10 * 100 AS DOUBLE) AS y,
CAST(45 + s_suppkey % 7 * 15 AS DOUBLE) AS w, s_acctbal AS balance, s_nationkey AS nation FROM supplier)"""


@query("load_geojson", f"""SELECT geom_id, CASE k WHEN 0 THEN 'Polygon' WHEN 1 THEN 'LineString' ELSE 'Point' END AS geom_type, x + CASE k WHEN 2 THEN 10 ELSE 0 END AS minx,
CASE k WHEN 0 THEN y + 75 WHEN 1 THEN y + 60 ELSE y + 20 END AS maxy, CAST(CASE k WHEN 0 THEN 5 WHEN 1 THEN 3 ELSE 1 END AS INTEGER) AS vertices FROM {_PLOT} p""", "minx maxy")
def _(t):
    path = scratch_path(t.spark, "geojson")
    files.save_result(plots(t), path, "GeoJSON")
    g = load_geojson(t.spark, path, multiline=False)
    return g.df.select("geom_id", "geom_type", "minx", "maxy", F.size(F.flatten("parts")).alias("vertices"))


@query("load_geojson_properties", f"""SELECT geom_id, u.p AS properties, CASE u.p WHEN 'balance' THEN balance ELSE nation END AS value FROM {_PLOT} s CROSS JOIN (VALUES ('balance'), ('nation')) u(p)""", "value")
def _(t):
    path = scratch_path(t.spark, "geojson")
    files.save_result(plots(t), path, "GeoJSON")
    return load_geojson(t.spark, path, properties=["balance", "nation"], multiline=False).df


@query("load_url", f"SELECT geom_id, u.p AS properties, balance AS value FROM {_PLOT} s CROSS JOIN (VALUES ('balance')) u(p)", "value")
def _(t):
    path = scratch_path(t.spark, "geojson")
    files.save_result(plots(t), path, "GeoJSON")
    return files.load_url(t.spark, path, "GeoJSONSeq", {"properties": ["balance"]}).df


@query("filter_bbox_vector", f"SELECT geom_id FROM {_PLOT} s WHERE k = 0 AND x >= 100 AND x + w <= 640 AND y >= 0 AND y + 75 <= 555")
def _(t):
    return plots(t, ("Polygon",)).filter_bbox([100, 0, 640, 555]).df.select("geom_id")


def _base(t) -> Geometries:
    g = plots(t, ("Polygon",))
    return Geometries(g.df.where("geom_id % 5 = 0").select("geom_id", "geom_type", "parts"), g.crs)


_OVERLAP = "a.x <= b.x + b.w AND b.x <= a.x + a.w AND a.y <= b.y + 75 AND b.y <= a.y + 75"


@query("filter_vector", f"""SELECT a.geom_id FROM {_PLOT} a WHERE k = 0 AND EXISTS (SELECT 1 FROM {_PLOT} b WHERE b.k = 0 AND b.geom_id % 5 = 0 AND {_OVERLAP})""")
def _(t):
    return plots(t, ("Polygon",)).filter_vector(_base(t)).df.select("geom_id")


@query("filter_vector_disjoint", f"""SELECT a.geom_id FROM {_PLOT} a WHERE k = 0 AND NOT EXISTS (SELECT 1 FROM {_PLOT} b WHERE b.k = 0 AND b.geom_id % 5 = 0 AND {_OVERLAP})""")
def _(t):
    return plots(t, ("Polygon",)).filter_vector(_base(t), "disjoint").df.select("geom_id")


@query("filter_vector_buffered", f"""SELECT a.geom_id FROM {_PLOT} a WHERE k = 2 AND EXISTS (SELECT 1 FROM {_PLOT} b WHERE b.k = 0 AND b.geom_id % 5 = 0
AND sqrt(pow(greatest(b.x - a.x - 10, a.x + 10 - b.x - b.w, 0), 2) + pow(greatest(b.y - a.y - 20, a.y + 20 - b.y - 75, 0), 2)) <= 60)""")
def _(t):
    """Points within 60 metres of the base plots: 20 by their own buffer, 40 by that of the plots."""
    return plots(t, ("Point",)).vector_buffer(20).filter_vector(_base(t).vector_buffer(25).vector_buffer(15)).df.select("geom_id")


@query("vector_buffer_reproject", f"SELECT geom_id FROM {_PLOT} s WHERE k = 0 AND x - 30 >= 100 AND x + w + 30 <= 700 AND y - 30 >= 0 AND y + 75 + 30 <= 600")
def _(t):
    """Plots come in degrees, go to metres and are grown there; the box sees the buffer."""
    degrees = plots(t, ("Polygon",)).vector_reproject(4326)
    return degrees.vector_reproject(3857).vector_buffer(30).filter_bbox([99.999, -0.001, 700.001, 600.001]).df.select("geom_id")


@query("filter_vector_within", f"""SELECT a.geom_id FROM {_PLOT} a WHERE k = 2 AND EXISTS (SELECT 1 FROM {_PLOT} b WHERE b.k = 0 AND b.x - 100 <= a.x + 10 AND a.x + 10 <= b.x - 100 + b.w AND b.y <= a.y + 20 AND a.y + 20 <= b.y + 75)""")
def _(t):
    g = plots(t, ("Polygon",))
    west = F.transform("parts", lambda r: F.transform(r, lambda p: F.struct((p["x"] - 100).alias("x"), p["y"].alias("y"))))
    moved = Geometries(g.df.select("geom_id", "geom_type", west.alias("parts")), g.crs)
    return plots(t, ("Point",)).filter_vector(moved, "within").df.select("geom_id")


@query("vector_buffer", """SELECT 1::BIGINT AS geom_id, t, count(B04) AS B04 FROM (SELECT x + 0.25 AS px, y + 0.25 AS py, t, B04 FROM cube_wide) c
WHERE sqrt(pow(greatest(0.5 - px, px - 4.5, 0), 2) + pow(greatest(0.5 - py, py - 4.5, 0), 2)) <= 1.2 GROUP BY t""")
def _(t):
    return t.shifted.filter_bands(["B04"]).aggregate_spatial(t.zones("square").vector_buffer(1.2), "count").df


@query("vector_buffer_negative", """SELECT 1::BIGINT AS geom_id, t, count(B04) AS B04 FROM (SELECT x + 0.25 AS px, y + 0.25 AS py, t, B04 FROM cube_wide) c
WHERE px >= 1.2 AND px <= 3.8 AND py >= 1.2 AND py <= 3.8 GROUP BY t UNION ALL
SELECT 1, NULL, NULL WHERE NOT EXISTS (SELECT 1 FROM cube_wide WHERE x + 0.25 BETWEEN 1.2 AND 3.8 AND y + 0.25 BETWEEN 1.2 AND 3.8)""")
def _(t):
    return t.shifted.filter_bands(["B04"]).aggregate_spatial(t.zones("square").vector_buffer(-0.7), "count").df


@query("vector_reproject", f"""SELECT geom_id, degrees(x / 6378137.0) AS minx, degrees((x + w) / 6378137.0) AS maxx, degrees(2 * atan(exp(y / 6378137.0)) - pi() / 2) AS miny,
degrees(2 * atan(exp((y + 75) / 6378137.0)) - pi() / 2) AS maxy FROM {_PLOT} s WHERE k = 0""", "minx:9 maxx:9 miny:9 maxy:9")
def _(t):
    return plots(t, ("Polygon",)).vector_reproject(4326).df.select("geom_id", "minx", "maxx", "miny", "maxy")


@query("vector_reproject_utm_round_trip", f"SELECT geom_id, x AS minx, x + w AS maxx, y + 75 AS maxy FROM {_PLOT} s WHERE k = 0", "minx:2 maxx:2 maxy:2")
def _(t):
    g = plots(t, ("Polygon",))
    moved = g.df.withColumn("parts", F.transform("parts", lambda r: F.transform(r, lambda p: F.struct((p["x"] + 3e5).alias("x"), (p["y"] + 5e6).alias("y")))))
    back = Geometries(moved.drop("minx", "maxx", "miny", "maxy"), 3857).vector_reproject(32631).vector_reproject(3857)
    return back.df.select("geom_id", (F.col("minx") - 3e5).alias("minx"), (F.col("maxx") - 3e5).alias("maxx"), (F.col("maxy") - 5e6).alias("maxy"))


@query("vector_to_regular_points", f"""SELECT geom_id, x + (i + 0.5) * 30 AS px, y + 75 - (j + 0.5) * 30 AS py FROM {_PLOT} s, (SELECT unnest(range(0, 10)) AS i) a, (SELECT unnest(range(0, 10)) AS j) b
WHERE k = 0 AND (i + 0.5) * 30 <= w AND (j + 0.5) * 30 <= 75
UNION ALL SELECT geom_id, x + least(l * 30, w), y + greatest(l * 30 - w, 0) FROM {_PLOT} s, (SELECT unnest(range(0, 20)) AS l) a WHERE k = 1 AND l * 30 < w + 60
UNION ALL SELECT geom_id, x + 10, y + 20 FROM {_PLOT} s WHERE k = 2""", "px py")
def _(t):
    g = plots(t).vector_to_regular_points(30.0)
    return g.df.select("geom_id", F.explode(F.col("parts")[0]).alias("p")).select("geom_id", F.col("p.x").alias("px"), F.col("p.y").alias("py"))


@query("vector_to_random_points", f"SELECT geom_id, 5::BIGINT AS n, true AS inside FROM {_PLOT} s WHERE k = 0")
def _(t):
    source = plots(t, ("Polygon",))
    g = source.vector_to_random_points(geometry_count=5, seed=11)
    dots = g.df.select("geom_id", F.explode(F.col("parts")[0]).alias("p"))
    ok = F.col("p.x").between(F.col("minx"), F.col("maxx")) & F.col("p.y").between(F.col("miny"), F.col("maxy"))
    box = source.df.select("geom_id", "minx", "maxx", "miny", "maxy")
    return dots.join(box, "geom_id").groupBy("geom_id").agg(F.count_distinct("p").alias("n"), F.bool_and(ok).alias("inside"))


@query("vector_to_random_points_total", f"SELECT CAST((SELECT count(*) FROM {_PLOT} s WHERE k = 0) * (4000 // (SELECT count(*) FROM {_PLOT} s WHERE k = 0)) AS BIGINT) AS n")
def _(t):
    # even shares as in the twin, so none where there are more polygons than points
    g = plots(t, ("Polygon",)).vector_to_random_points(total_count=4000, group=False, seed=5, strict=False)
    return g.df.agg(F.count(F.lit(1)).alias("n"))


@query("point_in_polygon", f"""SELECT DISTINCT geom_id, px AS x, py AS y FROM (
SELECT CAST(1 AS BIGINT) AS geom_id, px, py FROM (SELECT x + 0.25 AS px, y + 0.25 AS py FROM cube_wide) c WHERE {IN_SQUARE}
UNION ALL SELECT 2, px, py FROM (SELECT x + 0.25 AS px, y + 0.25 AS py FROM cube_wide) c WHERE {IN_ELL}
UNION ALL SELECT 3, px, py FROM (SELECT x + 0.25 AS px, y + 0.25 AS py FROM cube_wide) c WHERE {IN_TRIANGLE}) u""", "x y")
def _(t):
    pixels = t.shifted.df.select("x", "y").distinct()
    return pixel_hits(t.shifted, t.zones(), pixels).select("geom_id", "x", "y")


@query("vector_to_raster", f"""SELECT px AS x, py AS y, CAST(CASE WHEN {IN_TRIANGLE} THEN 3 WHEN {IN_ELL} THEN 2 WHEN {IN_SQUARE} THEN 1 END AS BIGINT) AS value
FROM (SELECT DISTINCT x + 0.25 AS px, y + 0.25 AS py FROM cube_wide) c""", "x y value:0")
def _(t):
    return t.zones().vector_to_raster(t.shifted)


def _area(t) -> Geometries:
    """The extent of all supplier plots as one polygon."""
    box = plots(t).df.agg(F.min("minx").alias("w"), F.min("miny").alias("s"), F.max("maxx").alias("e"), F.max("maxy").alias("n"))

    def p(x, y):
        return F.struct(F.col(x).alias("x"), F.col(y).alias("y"))

    ring = F.array(F.array(p("w", "s"), p("e", "s"), p("e", "n"), p("w", "n"), p("w", "s")))
    return Geometries(box.select(F.lit(0).cast("long").alias("geom_id"), F.lit("Polygon").alias("geom_type"), ring.alias("parts")), 3857)


_BOX = f"""(SELECT min(x + CASE k WHEN 2 THEN 10 ELSE 0 END) AS w, max(x + CASE k WHEN 2 THEN 10 ELSE w END) AS e, min(y + CASE k WHEN 2 THEN 20 ELSE 0 END) AS s,
max(y + CASE k WHEN 0 THEN 75 WHEN 1 THEN 60 ELSE 20 END) AS n FROM {_PLOT} p) b"""


@query("split_area", f"""SELECT b.w + c.i * 130 AS west, b.s + r.j * 130 AS south, least(b.w + (c.i + 1) * 130, b.e) AS east, least(b.s + (r.j + 1) * 130, b.n) AS north
FROM {_BOX}, (SELECT unnest(range(0, 100)) AS i) c, (SELECT unnest(range(0, 20000)) AS j) r WHERE c.i < ceil(round((b.e - b.w) / 130, 10)) AND r.j < ceil(round((b.n - b.s) / 130, 10))""",
       "west south east north")
def _(t):
    return split_area(t.spark, _area(t), projection=3857, tile_size=130).select("west", "south", "east", "north")


@query("split_area_grid", f"SELECT geom_id FROM {_PLOT} s WHERE k = 0 AND x <= 430 AND x + w >= 120 AND y <= 380 AND y + 75 >= 0")
def _(t):
    return split_area(t.spark, {"west": 120, "south": 0, "east": 430, "north": 380, "crs": 3857}, tile_grid=plots(t, ("Polygon",))).select("geom_id")


# -- curves

YEAR = 365.0 * 86400


def _line(x, p):
    return p[0] + p[1] * x


_X = f"(epoch_us(t) / 1e6 / {YEAR})"


@query("fit_curve", f"SELECT x, y, regr_intercept(B04, {_X}) AS B04_p0, regr_slope(B04, {_X}) AS B04_p1 FROM cube_wide GROUP BY x, y", "B04_p0:5 B04_p1:5")
def _(t):
    return t.wide.filter_bands(["B04"]).fit_curve([0.0, 0.0], _line, "t", unit=YEAR)


def _growth(x, p):
    return p[0] * F.exp(p[1] * (x - 28))


@query("fit_curve_nonlinear", "SELECT DISTINCT x, y, 40.0 + x AS B08_p0, 0.02 * (1 + y % 5) AS B08_p1 FROM cube_wide", "B08_p0:4 B08_p1:5")
def _(t):
    """Every series follows a known curve at the labels of the cube; the fit has to find its parameters."""
    cube = t.wide.filter_bands(["B08"])
    x = F.unix_micros(F.col("t").cast("timestamp")) / 1e6 / YEAR
    known = _growth(x, [F.lit(40.0) + F.col("x"), F.lit(0.02) * (1 + F.col("y") % 5)])
    return Cube(cube.df.withColumn("B08", known), cube.schema).fit_curve([50.0, 0.01], _growth, "t", unit=YEAR)


@query("predict_curve", f"""SELECT f.x, f.y, l.t, a + b * (epoch_us(l.t) / 1e6 / {YEAR}) AS B04 FROM (SELECT x, y, regr_intercept(B04, {_X}) AS a, regr_slope(B04, {_X}) AS b FROM cube_wide GROUP BY x, y) f
CROSS JOIN (VALUES (TIMESTAMP '2002-01-01'), (TIMESTAMP '2002-07-01')) l(t)""", "B04:5")
def _(t):
    c = t.wide.filter_bands(["B04"])
    return c.predict_curve(c.fit_curve([0.0, 0.0], _line, "t", unit=YEAR), _line, "t", labels=["2002-01-01", "2002-07-01"], unit=YEAR)


@query("predict_curve_gaps", f"""SELECT c.x, c.y, c.t, coalesce(c.B02, a + b * {_X.replace('(t)', '(c.t)')}) AS B02 FROM cube_wide c
LEFT JOIN (SELECT x, y, regr_intercept(B02, {_X}) AS a, regr_slope(B02, {_X}) AS b FROM cube_wide GROUP BY x, y) f ON f.x = c.x AND f.y = c.y""", "B02:5")
def _(t):
    c = t.wide.filter_bands(["B02"])
    return c.predict_curve(c.fit_curve([0.0, 0.0], _line, "t", unit=YEAR), _line, "t", unit=YEAR)


# -- random forests


def _samples(t):
    """All elements of the vectors as predictors; their number is read from one row."""
    arrays = t.view("arrays")
    names = [f"f{i}" for i in range(len(arrays.select("data").first()[0]))]
    return arrays.select("id", "label", *[F.get("data", F.lit(i)).cast("double").alias(n) for i, n in enumerate(names)]), names


def _pixels(t, predictors) -> Cube:
    df, _ = _samples(t)
    df = df.select((F.col("id") % 25).alias("x"), F.floor(F.col("id") / 25).alias("y"), *predictors)
    df = df.withColumn("f0", F.when(F.col("x") != 3, F.col("f0")))
    return Cube.of(df, temporal=(), bands=predictors)


@query("fit_class_random_forest", "SELECT count(*) AS n, count(DISTINCT label) AS classes, CAST(100 AS INTEGER) AS trees, true AS beats_majority FROM arrays")
def _(t):
    """The forest knows all classes, has the default number of trees, and does better on its own rows than the most frequent class."""
    df, names = _samples(t)
    model = learn.fit_class_random_forest(df, names, "label", seed=7)
    found = model.model.transform(df).agg(
        F.count("*").alias("n"), F.countDistinct("label").alias("classes"),
        F.avg((F.col("predicted_class").cast("double") == F.col("label")).cast("double")).alias("__right"))
    most = df.groupBy("label").count().agg((F.max("count") / F.sum("count")).alias("m"))
    return found.select("n", "classes", F.lit(len(model.model.stages[1].trees)).alias("trees"), (F.col("__right") > most.scalar()).alias("beats_majority"))


@query("fit_regr_random_forest", "SELECT id, true AS in_range FROM arrays")
def _(t):
    """Means of leaves lie within the values of the target, for every row."""
    df, names = _samples(t)
    model = learn.fit_regr_random_forest(df, names[1:], "f0", max_variables="sqrt", seed=7)
    ends = df.agg(F.struct(F.min("f0").alias("low"), F.max("f0").alias("high")))
    out = model.model.transform(df)
    return out.select("id", F.col("prediction").between(ends.scalar()["low"], ends.scalar()["high"]).alias("in_range"))


@query("predict_random_forest", "SELECT id % 25 AS x, CAST(floor(id / 25) AS BIGINT) AS y, id % 25 = 3 AS missing, id % 25 <> 3 AS known FROM arrays")
def _(t):
    """Null exactly where a predictor is null, else a label of the training rows."""
    df, names = _samples(t)
    model = learn.fit_class_random_forest(df, names, "label", seed=7)
    out = _pixels(t, names).predict_random_forest(model).df
    labels = df.select(F.col("label").cast("double").alias("__label")).distinct()
    return out.join(labels, F.col("value") == F.col("__label"), "left").select(
        "x", "y", F.col("value").isNull().alias("missing"), F.col("__label").isNotNull().alias("known"))


@query("fit_regr_random_forest_error", "SELECT label, count(*) AS n, true AS better_than_mean, true AS follows FROM arrays GROUP BY label")
def _(t):
    """Squared errors per label below nine tenths of those of its mean, and predictions that rise with the target: a constant fails both."""
    df, names = _samples(t)
    model = learn.fit_regr_random_forest(df, names[1:], "f0", max_variables="all", seed=7)
    out = model.model.transform(df)
    return out.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), (F.avg(F.pow(F.col("prediction") - F.col("f0"), F.lit(2))) < F.var_pop("f0") * 0.9).alias("better_than_mean"),
        (F.corr("prediction", "f0") > 0.5).alias("follows"))


@query("predict_random_forest_right", "SELECT label, count(*) FILTER (id % 25 <> 3) AS n, true AS mostly_right FROM arrays GROUP BY label")
def _(t):
    """For every label more than half of its cells get it back; a constant predictor fails for all labels but one."""
    df, names = _samples(t)
    model = learn.fit_class_random_forest(df, names, "label", seed=7)
    out = _pixels(t, names).predict_random_forest(model).df.where("value is not null")
    known = df.select((F.col("id") % 25).alias("x"), F.floor(F.col("id") / 25).cast("long").alias("y"), "label")
    return out.join(known, ["x", "y"]).groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), (F.avg((F.col("value") == F.col("label")).cast("double")) > 0.5).alias("mostly_right"))


@query("save_load_ml_model", "SELECT id % 25 AS x, CAST(floor(id / 25) AS BIGINT) AS y, true AS same FROM arrays")
def _(t):
    """A model that was saved and loaded predicts what it did before, in every cell."""
    df, names = _samples(t)
    model = learn.fit_class_random_forest(df, names, "label", seed=3)
    loaded = learn.RandomForest.load(model.save(scratch_path(t.spark, "forest")))
    cube = _pixels(t, names)
    again = cube.predict_random_forest(loaded).df.select("x", "y", F.col("value").alias("__again"))
    return cube.predict_random_forest(model).df.join(again, ["x", "y"]).select("x", "y", F.col("value").eqNullSafe(F.col("__again")).alias("same"))
