"""The plans over many ranges must give what one range gives, also with one hot key."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cubeloom import Cube
from cubeloom.functions import reducers as R
from cubeloom.plans import ranked, scan


@pytest.fixture(scope="module")
def hot(spark):
    """A cube in which one pixel holds most of the rows, with gaps."""
    rng = random.Random(4)
    rows = []
    for i in range(600):
        x = 0 if i % 3 else 1 + i % 7
        v = None if rng.random() < 0.3 else float(rng.randint(-20, 20))
        rows.append((x, 0, dt.datetime(2020, 1, 1) + dt.timedelta(hours=i * 5), v, float(i % 11)))
    return Cube.of(spark.createDataFrame(rows, "x long, y long, t timestamp_ntz, a double, b double").repartition(4), bands=["a", "b"]).df


def cube_of(df):
    return Cube.of(df, bands=["a", "b"])


def both(monkeypatch, make):
    monkeypatch.setattr(scan, "range_count", lambda df: 1)
    one = make()
    monkeypatch.setattr(scan, "range_count", lambda df: 16)
    return one, make()


@pytest.mark.parametrize("how", ["cumsum", "cummax", "cummin", "array_interpolate_linear"])
def test_order_functions(monkeypatch, hot, values, how):
    p, r = both(monkeypatch, lambda: values(cube_of(hot).apply_dimension(how, "t")))
    assert p == r


def test_by_label_and_strict(monkeypatch, hot, values):
    p, r = both(monkeypatch, lambda: values(cube_of(hot).interpolate_linear("t", by="label")))
    assert p == r
    monkeypatch.undo()
    p, r = both(monkeypatch, lambda: values(cube_of(hot).cumulate("cumsum", "t", ignore_nodata=False)))
    assert p == r


@pytest.mark.parametrize("block", [True, False])
def test_smoothing(monkeypatch, hot, values, block):
    rnd = lambda rows: [tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in rows]
    p, r = both(monkeypatch, lambda: rnd(values(cube_of(hot).smooth_savitzky_golay("t", fill=block))))
    assert p == r


@pytest.mark.parametrize("probs", [[0.5], [0.0, 0.1, 0.75, 1.0]])
def test_quantiles(hot, values, probs):
    wise = {r.x: (r.a, r.b) for r in ranked.quantiles(hot, ["x"], ["a", "b"], probs).collect()}
    frame = hot.toPandas()
    for x, rows in frame.groupby("x"):
        for got, name in zip(wise[x], ("a", "b")):
            assert got == pytest.approx(list(rows[name].dropna().quantile(probs)), abs=1e-9)
    assert ranked.quantiles(hot, [], ["a"], probs).first()[0] == pytest.approx(list(frame["a"].dropna().quantile(probs)), abs=1e-9)


def test_quantiles_of_empty_group(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0)], "k int, v double")
    rows = {r.k: r.v for r in ranked.quantiles(df, ["k"], ["v"], [0.1, 0.5]).collect()}
    assert rows == {1: [None, None], 2: [3.0, 3.0]}


def test_building_starts_no_job(spark, hot):
    seen = spark.sparkContext.statusTracker()
    before = len(seen.getJobIdsForGroup())
    cube = cube_of(hot)
    for make in (lambda: cube.apply_dimension("cumsum", "t"), lambda: cube.interpolate_linear("t"), lambda: cube.smooth_savitzky_golay("t"),
                 lambda: cube.median_time(), lambda: cube.reduce_dimension(R.quantiles([0.1, 0.9]), "t"), lambda: cube.resample_cube_temporal(cube)):
        make()
    assert len(seen.getJobIdsForGroup()) == before


def test_mode_prefers_smallest(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 5.0), (1, 2.0), (1, 2.0), (1, 9.0)], "k int, v double")
    assert ranked.modes(df, ["k"], ["v"]).first().v == 2.0


def test_nearest_in_time(monkeypatch, hot, values):
    goal = cube_of(hot).filter_temporal("2020-02").aggregate_temporal_period("day", "mean", complete=False)
    goal = Cube.of(goal.df.withColumn("t", F.to_timestamp_ntz(F.col("t"), F.lit("yyyy-DDD"))), bands=["a", "b"])
    for within in (None, 0.5):
        monkeypatch.undo()
        p, r = both(monkeypatch, lambda: values(cube_of(hot).resample_cube_temporal(goal, valid_within=within)))
        assert p == r


def test_strict_median(hot, values):
    got = {r.x: r.a for r in cube_of(hot).reduce_dimension(R.median(ignore_nodata=False), "t").df.collect()}
    has_null = {r.x for r in hot.where("a is null").select("x").distinct().collect()}
    assert {x for x, v in got.items() if v is None} == has_null


def test_chunks_are_balanced(hot):
    sizes = [r["count"] for r in scan.with_chunk(hot, "t", 8).groupBy(scan.CHUNK).count().collect()]
    assert len(sizes) == 8 and max(sizes) <= 2 * 600 / 8


def final_plan(df):
    """The plan that ran, without the plans of the start that it prints along."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    kept, skip = [], None
    for line in df._jdf.queryExecution().executedPlan().toString().splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth >= skip:
            continue
        skip = None
        if "== Initial Plan ==" in line:
            skip = depth
            continue
        kept.append(line)
    return "\n".join(kept)


def scans_and_exchanges(df):
    plan = final_plan(df)
    return plan.count("FileScan"), plan.count(" Exchange ") - plan.count("ReusedExchange")


@pytest.mark.parametrize("make", [
    lambda c: c.interpolate_linear("t"), lambda c: c.interpolate_linear("t", by="label"), lambda c: c.apply_dimension("cumsum", "t"), lambda c: c.median_time()])
def test_input_is_read_for_the_cuts_and_once_more(spark, hot, tmp_path, make):
    hot.write.parquet(str(tmp_path / "hot"))
    cube = cube_of(spark.read.parquet(str(tmp_path / "hot")))
    scans, exchanges = scans_and_exchanges(make(cube).df)
    assert scans <= 2 and exchanges <= 8


def test_leading_digits_never_fall(spark):
    rng = random.Random(1)
    values = [rng.choice([-1, 1]) * rng.random() * 2.0 ** rng.randint(-1074, 1023) for _ in range(3000)]
    values += [s * 2.0**e * f for e in range(-1074, 1024, 7) for f in (1.0, 1 - 2**-53, 1 + 2**-52) for s in (-1, 1)]
    values = sorted([*values, 0.0, -0.0, float("inf"), -float("inf"), 5e-324, -5e-324, 1.7e308])
    df = spark.createDataFrame([(i, v) for i, v in enumerate([*values, float("nan")])], "i int, v double")
    digits = [r.d for r in df.select("i", ranked.leading_digits(F.col("v")).alias("d")).orderBy("i").collect()]
    assert digits == sorted(digits) and None not in digits
    near = spark.createDataFrame([(1.0,), (1.0 + 1 / 8192,), (1.0 + 1 / 2048,)], "v double").select(ranked.leading_digits(F.col("v"))).collect()
    assert near[0] == near[1] and near[0] != near[2]


def test_quantiles_of_one_large_group(spark):
    rng = random.Random(8)
    rows = [(0, rng.gauss(0, 1)) for _ in range(4000)] + [(0, 0.25)] * 2000 + [(1, float(i % 3)) for i in range(50)] + [(2, None)]
    df = spark.createDataFrame(rows, "k int, v double").repartition(7)
    got = {r.k: r.v for r in ranked.quantiles(df, ["k"], ["v"], [0.0, 0.01, 0.5, 0.99, 1.0]).collect()}
    frame = df.toPandas()
    for k in (0, 1):
        assert got[k] == pytest.approx(list(frame[frame.k == k].v.quantile([0.0, 0.01, 0.5, 0.99, 1.0])), abs=1e-12)
    assert got[2] == [None] * 5


def test_positions_and_neighbours_come_from_one_scan(spark, hot):
    df = scan.with_position(hot.select("x", "t", "a"), ["x"], "t", total="n", more={"left": scan.last_known(F.col("a")), "right": scan.next_known(F.col("a"))})
    frame = df.toPandas().sort_values(["x", "t"])
    for _, g in frame.groupby("x"):
        assert list(g["__pos"]) == list(range(len(g))) and set(g["n"]) == {len(g)}
        last = None
        for pos, a, left in zip(g["__pos"], g["a"], g["left"]):
            last = (pos + 1, a) if a == a and a is not None else last
            assert (None if left is None else (left["o"], left["v"])) == last
        coming = None
        for pos, a, right in list(zip(g["__pos"], g["a"], g["right"]))[::-1]:
            coming = (pos + 1, a) if a == a and a is not None else coming
            assert (None if right is None else (right["o"], right["v"])) == coming


def test_nearest_in_time_reads_four_tables_and_gathers_nothing(spark, hot, tmp_path, values):
    hot.write.parquet(str(tmp_path / "hot"))
    cube = cube_of(spark.read.parquet(str(tmp_path / "hot")))
    goal = Cube.of(spark.range(900).select((F.lit(dt.datetime(2019, 12, 1)) + F.make_dt_interval(hours=F.col("id") * 7)).cast("timestamp_ntz").alias("t"), F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"),
                                         F.lit(1.0).alias("a")), bands=["a"])
    out = cube.resample_cube_temporal(goal)
    plan = final_plan(out.df)
    assert plan.count("FileScan") <= 4 and "collect_list" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    times = [r.t for r in goal.df.select("t").distinct().orderBy("t").collect()]
    source = {}
    for r in sorted(hot.collect(), key=lambda r: r.t):
        source.setdefault((r.x, r.y), []).append((r.t, r.a))
    got = {(r.x, r.y, r.t): r.a for r in out.df.collect()}
    assert len(got) == len(source) * len(times)
    for (x, y), series in source.items():
        for t in times:
            assert got[x, y, t] == min(series, key=lambda s: (abs(s[0] - t), s[0]))[1]
