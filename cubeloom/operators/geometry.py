"""Geometry predicates as Column expressions, and the tile-key join of pixels and geometries.

A geometry is a row ``geom_id, geom_type, parts, minx, miny, maxx, maxy, buffer``; ``parts``
holds rings, lines or points as arrays of ``struct<x, y>``. Polygons use the even-odd rule
over all rings, so holes and multi-polygons need no special case.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..errors import CrsUnknown

TILE = 256  # tile edge in pixels


def edges(parts: Column) -> Column:
    """All segments of all parts as ``struct<ax, ay, bx, by>``."""
    def of(p: Column) -> Column:
        return F.zip_with(
            F.slice(p, 1, F.greatest(F.size(p) - 1, F.lit(0))), F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))),
            lambda a, b: F.struct(a["x"].alias("ax"), a["y"].alias("ay"), b["x"].alias("bx"), b["y"].alias("by")),
        )

    return F.flatten(F.transform(parts, of))


def on_edge(x: Column, y: Column, segs: Column) -> Column:
    def on(s: Column) -> Column:
        cross = (s["bx"] - s["ax"]) * (y - s["ay"]) - (s["by"] - s["ay"]) * (x - s["ax"])
        return (cross == 0) & x.between(F.least(s["ax"], s["bx"]), F.greatest(s["ax"], s["bx"])) & y.between(
            F.least(s["ay"], s["by"]), F.greatest(s["ay"], s["by"]))

    return F.exists(segs, on)


def inside(x: Column, y: Column, segs: Column) -> Column:
    """Even-odd ray casting, the ray running in the direction of +x."""
    def crosses(s: Column) -> Column:
        straddles = (s["ay"] > y) != (s["by"] > y)
        at = s["ax"] + F.try_divide((y - s["ay"]) * (s["bx"] - s["ax"]), s["by"] - s["ay"])
        return F.coalesce(straddles & (x < at), F.lit(False))

    return F.aggregate(segs, F.lit(False), lambda odd, s: odd != crosses(s))


def covers(x: Column, y: Column, segs: Column) -> Column:
    """Point in polygon, boundary points included."""
    return inside(x, y, segs) | on_edge(x, y, segs)


def distance(x: Column, y: Column, segs: Column) -> Column:
    """Distance of a point to the nearest segment (a point is a segment of length zero)."""
    def to(s: Column) -> Column:
        dx, dy = s["bx"] - s["ax"], s["by"] - s["ay"]
        at = F.coalesce(F.try_divide((x - s["ax"]) * dx + (y - s["ay"]) * dy, dx * dx + dy * dy), F.lit(0.0))
        at = F.greatest(F.lit(0.0), F.least(F.lit(1.0), at))
        return F.sqrt(F.pow(x - s["ax"] - at * dx, F.lit(2)) + F.pow(y - s["ay"] - at * dy, F.lit(2)))

    return F.array_min(F.transform(segs, to))


def segments_cross(p: Column, q: Column) -> Column:
    """Whether two segments touch or cross."""
    def side(s: Column, x: Column, y: Column) -> Column:
        return F.signum((s["bx"] - s["ax"]) * (y - s["ay"]) - (s["by"] - s["ay"]) * (x - s["ax"]))

    boxes = (
        (F.least(p["ax"], p["bx"]) <= F.greatest(q["ax"], q["bx"])) & (F.least(q["ax"], q["bx"]) <= F.greatest(p["ax"], p["bx"]))
        & (F.least(p["ay"], p["by"]) <= F.greatest(q["ay"], q["by"])) & (F.least(q["ay"], q["by"]) <= F.greatest(p["ay"], p["by"])))
    return boxes & (side(p, q["ax"], q["ay"]) * side(p, q["bx"], q["by"]) <= 0) & (
        side(q, p["ax"], p["ay"]) * side(q, p["bx"], p["by"]) <= 0)


def segment_hits_cell(s: Column, x: Column, y: Column, hx: float, hy: float) -> Column:
    """Whether a segment passes the pixel of centre (x, y): clip its parameter range to the cell."""
    def span(a: Column, d: Column, low: Column, high: Column):
        t0, t1 = F.try_divide(low - a, d), F.try_divide(high - a, d)
        flat_in = (d == 0) & (a >= low) & (a <= high)
        near = F.when(d != 0, F.least(t0, t1)).when(flat_in, F.lit(0.0)).otherwise(F.lit(2.0))
        far = F.when(d != 0, F.greatest(t0, t1)).when(flat_in, F.lit(1.0)).otherwise(F.lit(-1.0))
        return near, far

    nx, fx = span(s["ax"], s["bx"] - s["ax"], x - hx, x + hx)
    ny, fy = span(s["ay"], s["by"] - s["ay"], y - hy, y + hy)
    return F.greatest(nx, ny, F.lit(0.0)) <= F.least(fx, fy, F.lit(1.0))


def hit(x: Column, y: Column, g: dict[str, Column], step_x: float, step_y: float) -> Column:
    """Pixel-centre rule per geometry type, with the buffer distance where one is set."""
    hx, hy = step_x / 2, step_y / 2
    points = F.exists(F.flatten(g["parts"]), lambda p: (
        (p["x"] >= x - hx) & (p["x"] < x + hx) & (p["y"] >= y - hy) & (p["y"] < y + hy)))
    lines = F.exists(g["edges"], lambda s: segment_hits_cell(s, x, y, hx, hy))
    area = g["geom_type"].isin("Polygon", "MultiPolygon")
    plain = F.when(area, covers(x, y, g["edges"])).when(g["geom_type"].isin("Point", "MultiPoint"), points).otherwise(lines)
    away = distance(x, y, g["edges"])
    grown = F.when(area, covers(x, y, g["edges"])).otherwise(F.lit(False)) | (away <= g["buffer"])
    shrunk = area & covers(x, y, g["edges"]) & (away >= -g["buffer"])
    return F.when(g["buffer"] == 0, plain).when(g["buffer"] > 0, grown).otherwise(shrunk)


GEOM_FIELDS = ("geom_id", "geom_type", "parts", "minx", "miny", "maxx", "maxy", "buffer")


def tiled(geoms: DataFrame, size_x: float, size_y: float, pad_x: float = 0.0, pad_y: float = 0.0) -> DataFrame:
    """One row per geometry and tile its bounding box covers; empty geometries vanish."""
    def span(low: str, high: str, size: float, pad: float) -> Column:
        grow = F.greatest(F.col("buffer"), F.lit(0.0)) + pad
        return F.sequence(F.floor((F.col(low) - grow) / size), F.floor((F.col(high) + grow) / size))

    return (
        geoms.where(F.col("minx").isNotNull())
        .withColumn("__tx", F.explode(span("minx", "maxx", size_x, pad_x)))
        .withColumn("__ty", F.explode(span("miny", "maxy", size_y, pad_y)))
    )


def aligned(geometries, crs: int | None):
    """The geometries in the reference system ``crs``.

    Geometries without a system are taken as they are; geometries that have one can't meet
    data that has none.
    """
    if geometries.crs is None or geometries.crs == crs:
        return geometries
    if crs is None:
        raise CrsUnknown(f"geometries in EPSG:{geometries.crs}, data without a reference system")
    return geometries.vector_reproject(crs)


def bounds(low: str, high: str) -> tuple[Column, Column]:
    """The ends of a geometry along an axis, its buffer included; an area that shrinks keeps its outer bounds."""
    grow = F.greatest(F.col("buffer"), F.lit(0.0))
    return F.col(low) - grow, F.col(high) + grow


def box_pairs(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs of geometries whose bounding boxes (buffers included) meet, each once; columns of ``b`` begin with ``b_``.

    A geometry's level is the power of two that its box fits into, so at its level, and at
    any above, it covers four cells at most, however its size compares to others. Two geometries meet
    at the higher of their levels, where the larger one is at home, and there only in the
    cell of the lower left corner of what their boxes share.
    """
    def boxed(df: DataFrame) -> DataFrame:
        ends = dict(zip(("__w", "__e"), bounds("minx", "maxx"))) | dict(zip(("__s", "__n"), bounds("miny", "maxy")))
        size = F.greatest(F.col("__e") - F.col("__w"), F.col("__n") - F.col("__s"), F.lit(1e-9))
        return df.where(F.col("minx").isNotNull()).withColumns(ends).withColumn("__level", F.ceil(F.log2(size)).cast("int"))

    a, b = boxed(a), boxed(b)
    prefixed = [F.col(c).alias(f"b_{c}") for c in b.columns]

    def side(length: Column) -> Column:
        return F.pow(F.lit(2.0), length)

    def cells(df: DataFrame, levels: Column) -> DataFrame:
        df = df.withColumn("__at", F.explode(levels))
        for name, low, high in (("__tx", "__w", "__e"), ("__ty", "__s", "__n")):
            df = df.withColumn(name, F.explode(F.sequence(F.floor(F.col(low) / side(F.col("__at"))), F.floor(F.col(high) / side(F.col("__at"))))))
        return df

    def above(df: DataFrame, top: DataFrame, start: int) -> Column:
        """Levels from ``start`` above the own one up to the highest of the other side."""
        highest = top.agg(F.max("__level")).scalar()
        first = F.col("__level") + start
        return F.when(first <= highest, F.sequence(first, highest)).otherwise(F.array().cast("array<int>"))

    def met(small: DataFrame, large: DataFrame, other: DataFrame, start: int, flip: bool) -> DataFrame:
        probes, homes = cells(small, above(small, other, start)), cells(large, F.array("__level"))
        left, right = (homes, probes) if flip else (probes, homes)
        key = ["__at", "__tx", "__ty"]
        return left.join(right.select(*key, *prefixed), key)

    pairs = met(a, b, b, 0, False).unionByName(met(b, a, a, 1, True))
    w, s = F.greatest("__w", "b___w"), F.greatest("__s", "b___s")
    meet = (F.col("__w") <= F.col("b___e")) & (F.col("b___w") <= F.col("__e")) & (F.col("__s") <= F.col("b___n")) & (F.col("b___s") <= F.col("__n"))
    once = (F.floor(w / side(F.col("__at"))) == F.col("__tx")) & (F.floor(s / side(F.col("__at"))) == F.col("__ty"))
    inner = [c for c in pairs.columns if c.removeprefix("b_").startswith("__")]
    return pairs.where(meet & once).drop(*inner)


def pixel_hits(cube, geometries, pixels: DataFrame | None = None) -> DataFrame:
    """Join pixel rows to the geometries they belong to: columns of the pixels plus ``geom_id``.

    Plain polygons are cut into runs along the pixel rows (see ``run_hits``), points, lines
    and buffered geometries are tested exactly on the pairs that share a tile. A range filter with
    the bounds of all geometries goes down to the scan first.
    """
    x, y = cube.schema.xy
    sx, sy = cube.schema.dim(x).step or 1.0, cube.schema.dim(y).step or 1.0
    geometries = aligned(geometries, cube.schema.dim(x).crs)
    some = geometries.df.select(*GEOM_FIELDS)
    grow = F.greatest(F.max("buffer"), F.lit(0.0))
    box = some.agg(F.struct(
        (F.min("minx") - grow - sx).alias("w"), (F.max("maxx") + grow + sx).alias("e"),
        (F.min("miny") - grow - sy).alias("s"), (F.max("maxy") + grow + sy).alias("n")))
    ends = box.scalar()
    rows = (cube.df if pixels is None else pixels).where(cube._between(x, ends["w"], ends["e"]) & cube._between(y, ends["s"], ends["n"]))
    places = rows.select(x, y).distinct() if pixels is None else rows.select(x, y)
    if geometries.areas and not geometries.grown:
        found = run_hits(places, some, x, y, sx, sy)
    else:
        plain = F.col("geom_type").isin("Polygon", "MultiPolygon") & (F.col("buffer") == 0)
        found = run_hits(places, some.where(plain), x, y, sx, sy).unionByName(tile_hits(places, some.where(~plain), x, y, sx, sy))
    return rows.join(found, [x, y]).select(*rows.columns, "geom_id")


STRIDE = 32  # pixels of a row that a run covers as one entry


def run_hits(places: DataFrame, polygons: DataFrame, x: str, y: str, sx: float, sy: float) -> DataFrame:
    """``x, y, geom_id`` of distinct pixels whose centre lies in a polygon or on its edge."""
    return run_pairs(places, polygons, x, y, sx, sy).where("__hit").select(x, y, "geom_id").distinct()


def run_pairs(places: DataFrame, polygons: DataFrame, x: str, y: str, sx: float, sy: float) -> DataFrame:
    """Pixels and the runs of polygons they may lie in, with ``__hit`` where they do.

    Every edge meets the pixel rows it spans; its crossings with a row, in order, bound the
    runs of the polygon there (even-odd). A run is keyed by the cells at its two ends and by whole
    strides between them, so pixels and runs meet in an equi-join whose pairs are hits, but
    for those in the end cells. The work follows the pixels, the crossings and the runs, not the
    number of polygons that share a tile. Edges are exact: the place of a crossing and the
    test for a point on an edge are those of ``covers``.
    """
    grid = places.withColumns({"__x": F.col(x).cast("double"), "__y": F.col(y).cast("double")})
    ends = places.agg(F.struct(*[f(F.col(c).cast("double")).alias(n) for n, f, c in (
        ("w", F.min, x), ("e", F.max, x), ("s", F.min, y), ("n", F.max, y))]))
    lines = grid.select("__y").distinct().withColumn("__row", F.floor(F.col("__y") / sy))
    low, high = F.least("__s.ay", "__s.by"), F.greatest("__s.ay", "__s.by")
    extent = polygons.where(F.col("minx").isNotNull()).select("geom_id", F.explode(edges(F.col("parts"))).alias("__s"), ends.scalar().alias("__e"))
    first, last = F.floor(F.greatest(low, F.col("__e.s")) / sy), F.floor(F.least(high, F.col("__e.n")) / sy)
    spans = extent.where(first <= last).withColumn("__row", F.explode(F.sequence(first, last)))
    yy, s = F.col("__y"), {c: F.col("__s")[c] for c in ("ax", "ay", "bx", "by")}
    at = s["ax"] + F.try_divide((yy - s["ay"]) * (s["bx"] - s["ax"]), s["by"] - s["ay"])
    flat = s["ay"] == s["by"]
    end = F.when(s["ay"] == yy, s["ax"]).otherwise(s["bx"])

    def mark(touch: bool, low: Column, high: Column) -> Column:
        return F.struct(F.lit(touch).alias("touch"), low.alias("low"), high.alias("high"))

    crossing = F.when((s["ay"] > yy) != (s["by"] > yy), mark(False, at, at))
    # an end on the row, or a whole edge along it, belongs to the polygon whatever the crossings say
    touch = F.when((s["ay"] == yy) | (s["by"] == yy), mark(
        True, F.when(flat, F.least(s["ax"], s["bx"])).otherwise(end), F.when(flat, F.greatest(s["ax"], s["bx"])).otherwise(end)))
    met = spans.join(lines, "__row").select("geom_id", "__y", "__s", "__e", F.explode(F.array_compact(F.array(crossing, touch))).alias("__m"))
    order = Window.partitionBy("geom_id", "__y", "__m.touch").orderBy("__m.low", "__m.high", "__s")
    met = met.withColumns({"__n": F.row_number().over(order), "__next": F.lead(F.struct(F.col("__m.low").alias("low"), "__s")).over(order)})
    runs = met.where(F.col("__m.touch") | (F.col("__n") % 2 == 1)).select(
        "geom_id", "__y", F.col("__m.touch").alias("__touch"), F.col("__m.low").alias("__low"),
        F.when(F.col("__m.touch"), F.col("__m.high")).otherwise(F.col("__next.low")).alias("__high"),
        F.col("__s").alias("__left"), F.col("__next.__s").alias("__right"), "__e")
    # a centre on an edge may miss the computed crossing by rounding
    slack = (F.abs("__low") + F.abs("__high") + sx) * 1e-9
    runs = runs.withColumns({
        "__c0": F.floor((F.greatest(F.col("__low"), F.col("__e.w")) - slack) / sx), "__c1": F.floor((F.least(F.col("__high"), F.col("__e.e")) + slack) / sx)})
    t0, t1 = F.ceil(F.col("__c0") / STRIDE), F.floor((F.col("__c1") + 1) / STRIDE)
    none = F.array().cast("array<bigint>")

    def numbers(a: Column, b: Column) -> Column:
        return F.when(a <= b, F.sequence(a, b)).otherwise(none)

    short = t0 >= t1
    cells = F.when(short, numbers(F.col("__c0"), F.col("__c1"))).otherwise(F.concat(
        numbers(F.col("__c0"), t0 * STRIDE - 1), numbers(t1 * STRIDE, F.col("__c1"))))
    strides = F.when(short, none).otherwise(numbers(t0, t1 - 1))

    def keys(level: int, at: Column) -> Column:
        return F.transform(at, lambda k: F.struct(F.lit(level).alias("l"), k.alias("k")))

    runs = runs.withColumn("__k", F.explode(F.concat(keys(0, cells), keys(1, strides))))
    column = F.floor(F.col("__x") / sx)
    grid = grid.withColumn("__k", F.explode(F.array(
        F.struct(F.lit(0).alias("l"), column.alias("k")), F.struct(F.lit(1).alias("l"), F.floor(column / STRIDE).alias("k")))))
    xx = F.col("__x")

    def on(edge: str) -> Column:
        e = F.col(edge)
        cross = (e["bx"] - e["ax"]) * (yy - e["ay"]) - (e["by"] - e["ay"]) * (xx - e["ax"])
        return F.coalesce((cross == 0) & xx.between(F.least(e["ax"], e["bx"]), F.greatest(e["ax"], e["bx"])), F.lit(False))

    hit = F.when(F.col("__touch"), xx.between(F.col("__low"), F.col("__high"))).otherwise(
        ((xx >= F.col("__low")) & (xx < F.col("__high"))) | on("__left") | on("__right"))
    return grid.join(runs, ["__y", "__k"]).select(x, y, "geom_id", hit.alias("__hit"))


def tile_hits(places: DataFrame, geometries: DataFrame, x: str, y: str, sx: float, sy: float) -> DataFrame:
    """``x, y, geom_id`` of distinct pixels by the exact test on all pairs that share a tile (an equi-join)."""
    size_x, size_y = TILE * sx, TILE * sy
    px, py = F.col(x).cast("double"), F.col(y).cast("double")
    left = places.withColumns({"__tx": F.floor(px / size_x), "__ty": F.floor(py / size_y)})
    right = tiled(geometries, size_x, size_y, sx / 2, sy / 2).withColumn("__g_edges", edges_or_points())
    right = right.select("geom_id", "__tx", "__ty", "__g_edges", *[F.col(c).alias(f"__g_{c}") for c in GEOM_FIELDS[1:]])
    g = {c: F.col(f"__g_{c}") for c in (*GEOM_FIELDS[1:], "edges")}
    pad_x, pad_y = F.greatest(g["buffer"], F.lit(0.0)) + sx / 2, F.greatest(g["buffer"], F.lit(0.0)) + sy / 2
    near = px.between(g["minx"] - pad_x, g["maxx"] + pad_x) & py.between(g["miny"] - pad_y, g["maxy"] + pad_y)
    return left.join(right, ["__tx", "__ty"]).where(near & hit(px, py, g, sx, sy)).select(x, y, "geom_id")


def edges_or_points() -> Column:
    """Segments of a geometry row; single points become segments of length zero."""
    dots = F.transform(F.flatten(F.col("parts")), lambda p: F.struct(
        p["x"].alias("ax"), p["y"].alias("ay"), p["x"].alias("bx"), p["y"].alias("by")))
    return F.when(F.col("geom_type").isin("Point", "MultiPoint"), dots).otherwise(edges(F.col("parts")))


def pixel_flags(cube, geometries) -> DataFrame:
    """Distinct (x, y) that lie in any geometry, with ``__hit`` = true."""
    x, y = cube.schema.xy
    pixels = cube.df.select(x, y).distinct()
    return pixel_hits(cube, geometries, pixels).select(x, y).distinct().withColumn("__hit", F.lit(True))
