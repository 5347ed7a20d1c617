import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cubeloom import errors as err
from cubeloom.functions import arrays as a
from cubeloom.functions import dates as d
from cubeloom.functions import logic as l
from cubeloom.functions import math as m
from cubeloom.functions import reducers as R
from cubeloom.functions import text as tx


def one(spark, *cols):
    return tuple(spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first())


def num(v):
    return F.lit(v).cast("double")


def test_math_edges(spark):
    got = one(
        spark, m.divide(num(1), num(0)), m.divide(num(1), num(0), ieee=True), m.divide(num(-1), num(0), ieee=True),
        m.mod(27, -5), m.mod(-27, 5), m.mod(num(1), num(0)), m.round_(num(2.5)), m.round_(num(3.5)), m.round_(num(1234.56), -2),
        m.int_(num(-3.7)), m.clip(num(5), 1, 3), m.clip(num(None), 1, 3), m.linear_scale_range(num(50), 0, 100), m.linear_scale_range(num(-5), 0, 100, 0, 255),
        m.normalized_difference(num(1), num(-1)), m.log(num(8), 2), m.log(num(81), 3))
    assert got[0] is None and got[1] == math.inf and got[2] == -math.inf
    assert got[3:6] == (-3.0, 3.0, None)
    assert got[6:9] == (2.0, 4.0, 1200.0)
    assert got[9] == -3 and got[10] == 3 and got[11] is None and got[12] == 0.5 and got[13] == 0.0 and got[14] is None
    assert got[15] == 3.0 and got[16] == pytest.approx(4.0)


def test_convert(spark):
    got = one(spark, m.convert(num(300.7), "uint8"), m.convert(num(-5), "uint8"), m.convert(num(40000), "int16"), m.convert(num(1.5), "float32"))
    assert got == (255, 0, 32767, 1.5)


def test_logic(spark):
    null = F.lit(None).cast("double")
    got = one(spark, l.eq(null, 1.0), l.eq(num(1), 1.2, delta=0.5), l.eq(F.lit("AbC"), "aBc", case_sensitive=False), l.neq(num(1), 2.0),
              l.is_valid(num(float("nan"))), l.is_valid(num(float("inf"))), l.is_valid(null), l.is_valid(num(1)), l.is_infinite(null),
              l.is_nan(F.lit("x"), numeric=False), l.xor(F.lit(True), F.lit(True)), l.and_(F.lit(False), F.lit(None).cast("boolean")),
              l.or_(F.lit(False), F.lit(None).cast("boolean")), l.if_(F.lit(None).cast("boolean"), 1, 2), l.between(num(3), 1, 3, exclude_max=True))
    assert got == (None, True, True, True, False, False, False, True, False, True, False, False, None, 2, False)


def test_text(spark):
    got = one(spark, tx.text_begins(F.lit("Hello"), "he"), tx.text_begins(F.lit("Hello"), "he", case_sensitive=False), tx.text_ends(F.lit("a.b"), "."),
              tx.text_contains(F.lit("a.b"), "."), tx.text_concat([F.lit("A"), 1, True, None, F.lit(2.5)], " "),
              tx.text_concat(F.array(F.lit(1), F.lit(None).cast("int")), "-"))
    assert got == (False, True, False, True, "A 1 true null 2.5", "1-null")


@pytest.mark.parametrize("given_, start, end", [
    ("2021", "2021-01-01", "2022-01-01"), ("2021-12", "2021-12-01", "2022-01-01"), ("2021-02-28", "2021-02-28", "2021-03-01"),
    (("2019-02", "2019-03"), "2019-02-01", "2019-03-01"), (("2019", None), "2019-01-01", None), ((None, "2019"), None, "2019-01-01"),
    (("2019-01-01T10:00:00Z", "2019-01-01T12:00:00+01:00"), "2019-01-01T10:00:00", "2019-01-01T11:00:00")])
def test_extent(given_, start, end):
    assert d.extent(given_) == tuple(dt.datetime.fromisoformat(v) if v else None for v in (start, end))


def test_extent_empty():
    with pytest.raises(err.TemporalExtentEmpty):
        d.extent(("2020-01-02", "2020-01-02"))


def test_dates(spark):
    ntz = lambda s: F.lit(s).cast("timestamp_ntz")
    got = one(spark, d.date_shift(ntz("2020-01-31 00:00:00"), 1, "month"), d.date_shift(F.lit("2020-03-31").cast("date"), -1, "month", date_only=True),
              d.date_difference(ntz("2020-01-01"), ntz("2020-01-02 12:00:00"), "day"), d.date_difference(ntz("2020-01-31"), ntz("2020-03-31"), "month"),
              d.rfc3339(ntz("2020-01-02 03:04:05")), d.parse_rfc3339(F.lit("2020-01-02T03:04:05+01:00")), d.parse_rfc3339(F.lit("2020-01-02")))
    assert got == (dt.datetime(2020, 2, 29), dt.date(2020, 2, 29), 1.5, 2.0, "2020-01-02T03:04:05Z", dt.datetime(2020, 1, 2, 2, 4, 5), dt.datetime(2020, 1, 2))


@pytest.mark.parametrize("period, day, label", [
    ("hour", "2020-02-03 17:30:00", "2020-02-03-17"), ("day", "2020-12-31", "2020-366"), ("week", "2021-01-01", "2020-53"), ("dekad", "2020-01-31", "2020-03"),
    ("dekad", "2020-02-01", "2020-04"), ("dekad", "2020-02-29", "2020-06"), ("dekad", "2020-12-31", "2020-36"), ("month", "2020-07-15", "2020-07"),
    ("season", "2019-12-01", "2020-djf"), ("season", "2020-02-29", "2020-djf"), ("season", "2020-03-01", "2020-mam"), ("season", "2020-11-30", "2020-son"),
    ("tropical-season", "2019-11-01", "2020-ndjfma"), ("tropical-season", "2020-04-30", "2020-ndjfma"), ("tropical-season", "2020-05-01", "2020-mjjaso"),
    ("year", "2020-05-01", "2020"), ("decade", "2019-12-31", "2010"), ("decade", "2020-01-01", "2020"), ("decade-ad", "2020-12-31", "2011"), ("decade-ad", "2021-01-01", "2021")])
def test_period_labels(spark, period, day, label):
    t = F.lit(day).cast("timestamp_ntz")
    assert one(spark, d.period_label(t, period), d.period_label(d.period_start(t, period), period)) == (label, label)


def test_arrays(spark):
    data = F.array(*[F.lit(v).cast("double") for v in (3.0, None, 1.0, 2.0, None)])
    got = one(spark, a.sort(data), a.sort(data, asc=False, nodata=True), a.order(data), a.order(data, asc=False), a.array_interpolate_linear(data),
              a.cumsum(data), a.cumsum(data, ignore_nodata=False), a.array_contains(data, 7.0), a.array_contains(data, None), a.array_find(data, 2.0),
              a.array_find(F.array(F.lit(1), F.lit(2), F.lit(1)), 1, reverse=True), a.array_modify(data, [9.0], 1, 2), a.array_create([1, 2], 2), a.array_element(data, 9, return_nodata=True))
    assert got[0] == [1.0, 2.0, 3.0] and got[1] == [3.0, 2.0, 1.0, None, None] and got[2] == [2, 3, 0] and got[3] == [0, 3, 2]
    assert got[4] == [3.0, 2.0, 1.0, 2.0, None] and got[5] == [3.0, None, 4.0, 6.0, None] and got[6] == [3.0, None, None, None, None]
    assert got[7:] == (False, False, 3, 2, [3.0, 9.0, 2.0, None], [1, 2, 1, 2], None)


def test_array_errors(spark):
    data = F.array(F.lit(1.0))
    labelled = a.array_create_labeled(data, F.array(F.lit("a")))
    assert one(spark, a.array_element(labelled, label="a"), a.array_find_label(labelled, "a"), a.array_labels(labelled)) == (1.0, 0, ["a"])
    for bad in (a.array_element(data, 3), a.array_append(labelled, 2.0, "a"), a.array_modify(data, [1.0], 5)):
        with pytest.raises(Exception, match="ArrayElementNotAvailable|LabelExists"):
            one(spark, bad)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float)), min_size=1, max_size=12))
def test_array_and_group_forms_agree(spark, items):
    """A reducer gives the same over an array and over a group, in the default and the strict form."""
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, v double")
    names = ("sum", "mean", "min", "max", "sd", "variance", "product", "first", "last", "extrema", "count")
    for strict in (False, True):
        reds = [R.NAMES[n]() if n == "count" else R.NAMES[n](ignore_nodata=not strict) for n in names]
        grouped = rows.agg(*[r.agg(F.col("v"), F.col("i")).alias(n) for r, n in zip(reds, names)]).first()
        whole = F.array(*[F.lit(v).cast("double") for v in items])
        single = one(spark, *[r.arr(whole) for r in reds])
        for n, x, y in zip(names, grouped, single):
            assert x == pytest.approx(y, nan_ok=True) if x is not None and y is not None else x == y, n


def test_quantile_probabilities():
    from cubeloom.plans.ranked import probabilities_of

    assert probabilities_of(None, 4) == [0.25, 0.5, 0.75]
    with pytest.raises(err.AscendingProbabilitiesRequired):
        probabilities_of([0.5, 0.1])
