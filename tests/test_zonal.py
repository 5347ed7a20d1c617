"""Runs of polygons along pixel rows against the test of every pixel with every polygon."""

import random

from pyspark.sql import functions as F

from cubeloom import Cube
from cubeloom.operators import geometry as geo
from cubeloom.operators.vector import Geometries


def grid(spark, n, step=1.0, phase=0.0):
    df = spark.range(n * n).select((F.col("id") % n * step + phase).alias("x"), (F.floor(F.col("id") / n) * step + phase).alias("y"), F.lit(1.0).alias("v"))
    return Cube.of(df, temporal=(), bands=["v"], step=step)


def all_pairs(cube, polygons):
    """By the even-odd test and the edge test on every pair."""
    g = polygons.df.where("minx is not null").select("geom_id", geo.edges(F.col("parts")).alias("e"))
    rows = cube.df.select("x", "y").crossJoin(g).where(geo.covers(F.col("x").cast("double"), F.col("y").cast("double"), F.col("e")))
    return sorted(tuple(r) for r in rows.select("x", "y", "geom_id").collect())


def by_runs(cube, polygons):
    return sorted((r.x, r.y, r.geom_id) for r in geo.pixel_hits(cube, polygons).collect())


def star(rng, i, whole, far=40):
    pick = (lambda: rng.randrange(-3, far)) if whole else (lambda: rng.uniform(-3, far))
    rings = []
    for _ in range(rng.choice([1, 1, 2, 3])):
        ring = [(pick(), pick()) for _ in range(rng.randrange(3, 9))]
        rings.append([*ring, ring[0]])
    return {"type": "Polygon", "id": i, "coordinates": rings}


def test_random_polygons_with_corners_on_pixels(spark):
    rng = random.Random(7)
    polygons = Geometries.from_shapes(spark, [star(rng, i, i % 2 == 0) for i in range(60)])
    for step, phase in ((1.0, 0.0), (1.0, 0.5), (0.1, 0.05), (2.5, -1.0)):
        cube = grid(spark, 36, step, phase)
        assert by_runs(cube, polygons) == all_pairs(cube, polygons)


def test_wide_polygons_holes_empty_ones_and_far_ones(spark):
    ring = lambda a, b: [(a, a), (b, a), (b, b), (a, b), (a, a)]
    shapes = [{"type": "Polygon", "id": 1, "coordinates": [ring(-1e7, 1e7)]}, {"type": "Polygon", "id": 2, "coordinates": [ring(-5, 150), ring(3, 130)]},
              {"type": "Polygon", "id": 3, "coordinates": []}, {"type": "Polygon", "id": 4, "coordinates": [ring(900, 901)]},
              {"type": "MultiPolygon", "id": 5, "coordinates": [[ring(0, 2)], [ring(100, 133)]]}, {"type": "Polygon", "id": 6, "coordinates": [[(0, 5), (9, 5), (0, 5)]]},
              {"type": "Point", "id": 7, "coordinates": (4.2, 4.2)}]
    cube = grid(spark, 140)
    polygons = Geometries.from_shapes(spark, shapes)
    areas = Geometries.from_shapes(spark, [s for s in shapes if s["type"] != "Point"])
    assert by_runs(cube, polygons) == sorted([*all_pairs(cube, areas), (4.0, 4.0, 7)])
    assert by_runs(cube, Geometries.from_shapes(spark, shapes[2:3])) == []


def test_work_follows_pixels_and_runs_where_many_polygons_share_a_tile(spark):
    rng = random.Random(1)
    shapes = []
    for i in range(5000):
        x, y, r = rng.uniform(0, 250), rng.uniform(0, 250), rng.uniform(0.5, 4)
        shapes.append({"type": "Polygon", "id": i, "coordinates": [[(x - r, y), (x, y - r), (x + r, y), (x, y + r), (x - r, y)]]})
    polygons = Geometries.from_shapes(spark, shapes)
    cube = grid(spark, 256)
    pairs = geo.run_pairs(cube.df.select("x", "y"), polygons.df.select(*geo.GEOM_FIELDS), "x", "y", 1.0, 1.0)
    tested, hits = pairs.count(), pairs.where("__hit").count()
    rows = sum(2 * r + 1 for r in (s["coordinates"][0][2][0] - s["coordinates"][0][1][0] for s in shapes))
    assert hits <= tested <= hits + 2 * rows  # besides hits, the two end cells of a run
    expected = 0
    for s in shapes[:200]:
        (x0, y0), (x1, y1) = s["coordinates"][0][0], s["coordinates"][0][1]
        cx, cy, r = x1, y0, x1 - x0
        expected += sum(abs(px - cx) + abs(py - cy) <= r for px in range(max(0, int(cx - r) - 1), min(256, int(cx + r) + 2)) for py in range(max(0, int(cy - r) - 1), min(256, int(cy + r) + 2)))
    assert pairs.where("__hit and geom_id < 200").count() == expected


def test_every_pair_of_boxes_meets_once_whatever_their_sizes(spark):
    rng = random.Random(11)

    def shapes(n, seed):
        out = []
        for i in range(n):
            x, y, r = rng.uniform(-500, 500), rng.uniform(-500, 500), rng.choice([0.0, 0.01, 1, 1, 3, 40, 700])
            out.append({"type": "Polygon", "id": i, "coordinates": [[(x, y), (x + r, y), (x + r, y + r / 2), (x, y)]]})
        return Geometries.from_shapes(spark, out)

    a, b = shapes(300, 1), shapes(200, 2)
    a = Geometries(a.df.withColumn("buffer", F.when(F.col("geom_id") % 3 == 0, 5.0).otherwise(0.0)), None)
    got = [(r.geom_id, r.b_geom_id) for r in geo.box_pairs(a.df.select(*geo.GEOM_FIELDS), b.df.select(*geo.GEOM_FIELDS)).collect()]
    boxes = [{r.geom_id: (r.minx - r.buffer, r.maxx + r.buffer, r.miny - r.buffer, r.maxy + r.buffer) for r in g.df.collect()} for g in (a, b)]
    want = [(i, j) for i, p in boxes[0].items() for j, q in boxes[1].items() if p[0] <= q[1] and q[0] <= p[1] and p[2] <= q[3] and q[2] <= p[3]]
    assert len(got) == len(set(got)) and sorted(got) == sorted(want)


def test_one_large_base_among_many_small_ones(spark):
    small = [{"type": "Point", "id": i, "coordinates": (i * 1000.0, 0.5)} for i in range(3000)]
    base = [{"type": "Polygon", "id": 1, "coordinates": [[(-1, -1), (2e6, -1), (2e6, 1), (-1, 1), (-1, -1)]]}, {"type": "Point", "id": 2, "coordinates": (2_500_000.0, 0.5)}]
    found = Geometries.from_shapes(spark, small).filter_vector(Geometries.from_shapes(spark, base))
    assert sorted(r.geom_id for r in found.df.select("geom_id").collect()) == [*range(2001), 2500]
    none = Geometries.from_shapes(spark, small).filter_vector(Geometries.from_shapes(spark, [{"type": "Polygon", "id": 1, "coordinates": []}]))
    assert none.df.count() == 0
