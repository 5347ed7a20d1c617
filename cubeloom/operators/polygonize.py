"""Outlines and polygons of homogeneous areas.

Connected components by contraction: in every round each remaining node joins its
neighbour with the smallest scrambled id, edges are rewritten and made distinct, so the
edge table shrinks by a constant share per round however large one area is. Tables are
checkpointed to the shared folder between rounds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .base import CubeBase

BLOCK = 64  # cells to a side of the blocks in which neighbours are found


def connected_components(links: DataFrame) -> DataFrame:
    """``id -> component`` (the smallest id of the component) of all ids in links ``a, b``, named once each."""
    links = cut_lineage(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    moves: list[DataFrame] = []
    while not links.isEmpty():
        turn = len(moves)

        def scrambled(c: str):
            return F.struct(F.xxhash64(F.col(c), F.lit(turn)).alias("h"), F.col(c).alias("n"))

        best = links.groupBy("a").agg(F.min(scrambled("b")).alias("m"))
        move = cut_lineage(best.select("a", F.least(F.col("m"), scrambled("a"))["n"].alias("to")))
        links = cut_lineage(
            links.join(move, "a").select(F.col("to").alias("x"), "b")
            .join(move.select(F.col("a").alias("b"), "to"), "b").select(F.col("x").alias("a"), F.col("to").alias("b"))
            .where("a <> b").distinct())
        moves.append(move)
    if not moves:
        return links.select(F.col("a").alias("id"), F.col("a").alias("component"))
    # put the moves together from the last (smallest) to the first
    whole = moves[-1]
    for move in reversed(moves[:-1]):
        later = whole.select(F.col("a").alias("to"), F.col("to").alias("end"))
        whole = move.join(later, "to", "left").select("a", F.coalesce("end", "to").alias("to"))
    label = cut_lineage(whole.select(F.col("a").alias("id"), F.col("to").alias("node")))
    smallest = label.groupBy("node").agg(F.min("id").alias("component"))
    return label.join(smallest, "node").select("id", "component")


def rings(sides: DataFrame, keys: list[str]) -> DataFrame:
    """Sides chained to rings: ``keys, ring, steps, x, y`` of every corner, in falling order of ``steps``.

    ``sides`` are directed with the area to their left: ``keys, vi, vj`` (start), ``way`` (0 to 3
    for +x, +y, -x, -y), ``ex, ey`` (end). At a corner where an area meets itself the ring
    stays with its cell (a left turn), so a hole that touches the outside there belongs to it. Pointers
    to the next side are doubled: after a round a side knows the smallest side, and how far it
    is, among twice as many sides ahead; a ring of n sides takes about log2(n) rounds of
    joins on single sides, so one long ring is spread like many short ones.
    """
    step = {0: (1, 0), 1: (0, 1), 2: (-1, 0), 3: (0, -1)}

    def moved(axis: int):
        return F.element_at(F.array(*[F.lit(step[w][axis]).cast("long") for w in range(4)]), F.col("way") + 1)

    named = sides.withColumn("id", F.struct(*[F.col(k) for k in keys], F.col("vi"), F.col("vj"), F.col("way")))
    ahead = named.select(*keys, F.col("vi").alias("ni"), F.col("vj").alias("nj"), F.col("way").alias("nway"), F.col("id").alias("nid"))
    turn = F.pmod(F.col("nway") - F.col("way") + 1, F.lit(4))  # 2 left, 1 straight, 0 right
    linked = named.withColumns({"ni": F.col("vi") + moved(0), "nj": F.col("vj") + moved(1)}).join(ahead, [*keys, "ni", "nj"])
    linked = cut_lineage(linked.groupBy("id").agg(
        F.max_by(F.struct("nid", "nway"), turn).alias("next"), F.first("way").alias("way"), F.first("ex").alias("x"), F.first("ey").alias("y")))
    state = linked.select("id", F.col("next.nid").alias("to"), F.col("id").alias("least"), F.lit(0).cast("long").alias("steps"))
    reach = 1
    while True:
        far = state.select(F.col("id").alias("to"), F.col("to").alias("to2"), F.col("least").alias("least2"), F.col("steps").alias("steps2"))
        lower = F.col("least2") < F.col("least")
        moves = cut_lineage(state.join(far, "to").select(
            "id", F.col("to2").alias("to"), F.least("least", "least2").alias("least"),
            F.when(lower, F.col("steps2") + reach).otherwise(F.col("steps")).alias("steps"), lower.alias("changed")))
        settled = moves.where("changed").isEmpty()
        state = moves.drop("changed")
        reach *= 2
        if settled:
            break
    corners = linked.where(F.col("next.nway") != F.col("way")).join(state, "id")
    return corners.select(*[F.col(f"id.{k}").alias(k) for k in keys], F.col("least").alias("ring"), "steps", "x", "y")


class PolygonizeOps(CubeBase):
    def raster_to_polygons(self):
        """Each area of equal, 4-connected pixels as a polygon with its holes: geometries for the other vector operators.

        Properties are ``feature_id``, ``value`` and the other dimensions. The outer ring runs
        counter-clockwise and comes first, holes run clockwise; corners only, closed. Where an
        area touches itself at a corner its ring passes the corner twice. Null pixels belong to no
        area. ``geom_id`` is the number of the first pixel, or a hash of the feature where
        there are other dimensions.
        """
        from .vector import Geometries

        cells, others, x, y, sx, sy = self._areas()
        x0, y0 = (F.col(x).cast("double") - sx / 2), (F.col(y).cast("double") - sy / 2)

        def side(way: int, di: int, dj: int, ex, ey):
            # on the rim unless the cell beyond it is of the same area
            return F.when(F.col("near").bitwiseAND(1 << way) == 0, F.struct(
                F.lit(way).alias("way"), (F.col("i") + di).alias("vi"), (F.col("j") + dj).alias("vj"), ex.alias("ex"), ey.alias("ey")))

        sides = F.array_compact(F.array(side(0, 0, 0, x0 + sx, y0), side(1, 1, 0, x0 + sx, y0 + sy), side(2, 1, 1, x0, y0 + sy), side(3, 0, 1, x0, y0)))
        rim = cells.select("component", F.explode(sides).alias("s")).select("component", "s.*")
        corners = rings(rim, ["component"])
        ordered = corners.groupBy("component", "ring").agg(
            F.transform(F.sort_array(F.collect_list(F.struct("steps", "x", "y")), asc=False), lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("r"))
        closed = F.concat("r", F.slice("r", 1, 1))
        twice = F.aggregate(F.zip_with("r", F.concat(F.slice("r", 2, F.size("r")), F.slice("r", 1, 1)), lambda p, q: p["x"] * q["y"] - q["x"] * p["y"]),
                            F.lit(0.0), lambda s, v: s + v)
        shapes = ordered.select("component", F.struct((twice < 0).alias("hole"), F.col("ring").alias("n"), closed.alias("r")).alias("ring")).groupBy("component").agg(
            F.transform(F.sort_array(F.collect_list("ring")), lambda p: p["r"]).alias("parts"))
        facts = cells.groupBy("component").agg(F.first("value").alias("value"), *[F.first(o).alias(o) for o in others])
        feature = F.concat_ws(":", F.col("component.plane"), F.col("component.n").cast("string"))
        df = shapes.join(facts, "component").select(
            (F.xxhash64(feature) if others else F.col("component.n")).alias("geom_id"), F.lit("Polygon").alias("geom_type"), "parts",
            feature.alias("feature_id"), "value", *others)
        return Geometries(df, self.schema.dim(self.schema.xy[0]).crs)

    def _areas(self):
        """Valid cells with the area they belong to (``component``), and the names and steps of the grid.

        ``near`` has a bit for each neighbour of equal value: below 1, right 2, above 4,
        left 8; ``copies`` is how often the cell is there. Cells go once, with the border
        of the blocks around, to a block of the grid, where neighbours are found in order;
        only cells that have one meet the labels of the areas. Cells without a place are left out.
        """
        long = self.to_values()
        schema = long.schema
        x, y = schema.xy
        sx, sy = schema.dim(x).step or 1.0, schema.dim(y).step or 1.0
        others = schema.others(x, y)
        # the values are looked at as well, so that an aggregated cube is shuffled once for both
        ends = long._scalars(x0=F.min(x), x1=F.max(x), y0=F.min(y), value=F.max("value"))
        i, j = F.round((F.col(x) - ends["x0"]) / sx).cast("long"), F.round((F.col(y) - ends["y0"]) / sy).cast("long")
        width = F.round((ends["x1"] - ends["x0"]) / sx).cast("long") + 1
        valid = long.df.where(F.col("value").isNotNull())

        def block(di: int, dj: int):
            return F.struct(F.floor((i + di) / BLOCK).alias("bi"), F.floor((j + dj) / BLOCK).alias("bj"), F.lit(not (di or dj)).alias("own"))

        def beyond(at, step: int):
            return F.pmod(at, F.lit(BLOCK)) == (0 if step < 0 else BLOCK - 1)

        reach = F.array_compact(F.array(
            F.when(i.isNotNull() & j.isNotNull(), block(0, 0)), F.when(beyond(i, -1) & (i > 0), block(-1, 0)), F.when(beyond(i, 1) & (i < width - 1), block(1, 0)),
            F.when(beyond(j, -1) & (j > 0), block(0, -1)), F.when(beyond(j, 1), block(0, 1))))
        dealt = valid.select(*others, x, y, "value", F.explode(reach).alias("b")).select(*others, x, y, "value", "b.*")
        dealt = dealt.repartition(*others, "bi", "bj").withColumns({"i": i, "j": j})
        row = Window.partitionBy(*others, "bi", "bj", "j", "value").orderBy("i")
        column = Window.partitionBy(*others, "bi", "bj", "i").orderBy("j")

        def in_row(step: int):
            return F.count(F.lit(1)).over(row.rangeBetween(step, step)) > 0

        def in_column(step: int):
            return F.array_contains(F.collect_set("value").over(column.rangeBetween(step, step)), F.col("value"))

        near = dealt.withColumns({"__r": in_row(1), "__l": in_row(-1)}).withColumns({
            "__a": in_column(1), "__b": in_column(-1), "copies": F.count(F.lit(1)).over(column.rangeBetween(0, 0))}).where("own")
        bits = sum((F.col(c).cast("int") * (1 << k) for k, c in enumerate(("__b", "__r", "__a", "__l"))), F.lit(0))
        cells = cut_lineage(near.select(*others, x, y, "value", "i", "j", width.alias("w"), bits.alias("near"), "copies"))
        # cells of one row of equal value are told apart by plane: the other labels as text
        plane = F.concat_ws("\u0001", *[F.coalesce(F.col(o).cast("string"), F.lit("\u0002")) for o in others])
        n = F.col("j") * F.col("w") + F.col("i")

        def cell(n):
            return F.struct(plane.alias("plane"), n.alias("n"))

        ahead = F.array_compact(F.array(F.when(F.col("near").bitwiseAND(2) > 0, cell(n + 1)), F.when(F.col("near").bitwiseAND(4) > 0, cell(n + F.col("w")))))
        links = cells.where(F.col("near").bitwiseAND(6) > 0).select(cell(n).alias("a"), F.explode(ahead).alias("b"))
        parts = connected_components(links)
        named = cells.withColumn("id", cell(n))
        alone = named.where("near = 0").withColumn("component", F.col("id"))
        return named.where("near > 0").join(parts, "id").unionByName(alone).drop("id"), others, x, y, sx, sy

    def raster_to_vector(self) -> DataFrame:
        """Outline segments of each area of equal, 4-connected pixels.

        One row per pixel side on an outline: ``feature_id, value, x1, y1, x2, y2`` plus the
        other dimensions and the band. Null pixels belong to no area. A side is inside an
        area exactly when the pixel beyond it has the same value; pixels that are there more
        than once have no sides.
        """
        owned, others, x, y, sx, sy = self._areas()
        x0, y0 = (F.col(x).cast("double") - sx / 2), (F.col(y).cast("double") - sy / 2)

        def side(bit: int, ax, ay, bx, by):
            return F.when(F.col("near").bitwiseAND(bit) == 0, F.struct(ax.alias("x1"), ay.alias("y1"), bx.alias("x2"), by.alias("y2")))

        sides = F.array_compact(F.array(
            side(1, x0, y0, x0 + sx, y0), side(4, x0, y0 + sy, x0 + sx, y0 + sy),
            side(8, x0, y0, x0, y0 + sy), side(2, x0 + sx, y0, x0 + sx, y0 + sy)))
        feature = F.concat_ws(":", F.col("component.plane"), F.col("component.n").cast("string"))
        return owned.where("copies = 1").select(*others, feature.alias("feature_id"), "value", F.explode(sides).alias("s")).select(
            *others, "feature_id", "value", "s.*")
