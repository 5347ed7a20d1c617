"""Queries for the scalar functions, each applied to every value of a cube."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as d
from ..functions import logic as l
from ..functions import math as m
from ..functions import text as tx
from .base import query

BANDS = ("B02", "B04", "B08")
R3 = "B02 B04 B08"


def scalar(name: str, fn, sql: str, before=lambda v: v, r: str = R3) -> None:
    """``sql`` holds ``{v}`` for the value."""
    cols = ", ".join(f"{sql.format(v=b)} AS {b}" for b in BANDS)

    @query(name, f"SELECT x, y, t, {cols} FROM cube_wide", r)
    def _(t):
        return t.optical.apply(lambda v: fn(before(v)))


# fixed numbers of each template are part of the query, not of the data
scalar("absolute", lambda v: m.absolute(v - 30), "abs({v} - 30)")
scalar("add", lambda v: m.add(v, 2.5), "({v} + 2.5)")
scalar("subtract", lambda v: m.subtract(v, 2.5), "({v} - 2.5)")
scalar("multiply", lambda v: m.multiply(v, 1.5), "({v} * 1.5)")
scalar("divide", lambda v: m.divide(v, F.floor(v / 20)), "({v} / NULLIF(floor({v} / 20), 0))")
scalar("mod", lambda v: m.mod(v - 30, -7), "(({v} - 30) - (-7) * floor(({v} - 30) / (-7)))")
scalar("power", lambda v: m.power(v / 10, 1.7), "pow({v} / 10, 1.7)")
scalar("exp", lambda v: m.exp(v / 50), "exp({v} / 50)")
scalar("ln", lambda v: m.ln(v), "ln({v})")
scalar("log", lambda v: m.log(v, 3), "(ln({v}) / ln(3))")
scalar("log2", lambda v: m.log2(v), "log2({v})")
scalar("log10", lambda v: m.log10(v), "log10({v})")
scalar("sqrt", lambda v: m.sqrt(v), "sqrt({v})")
scalar("sgn", lambda v: m.sgn(v - 25), "CAST(sign({v} - 25) AS DOUBLE)")
scalar("ceil", lambda v: m.ceil(v * 3).cast("double"), "ceil({v} * 3)")
scalar("floor", lambda v: m.floor(v * 3).cast("double"), "floor({v} * 3)")
scalar("int", lambda v: m.int_((v - 30) * 3).cast("double"), "trunc(({v} - 30) * 3)")
scalar("clip", lambda v: m.clip(v, 10, 40), "(CASE WHEN {v} < 10 THEN 10 WHEN {v} > 40 THEN 40 ELSE {v} END)")
scalar("linear_scale_range", lambda v: m.linear_scale_range(v, 5, 60, 0, 255),
       "((CASE WHEN {v} < 5 THEN 5.0 WHEN {v} > 60 THEN 60.0 ELSE {v} END - 5.0) / 55.0 * 255.0)")
scalar("normalized_difference", lambda v: m.normalized_difference(v, F.lit(12.0)), "(({v} - 12.0) / ({v} + 12.0))")
scalar("sin", m.sin, "sin({v})")
scalar("cos", m.cos, "cos({v})")
scalar("tan", m.tan, "tan({v} / 100)", lambda v: v / 100)
scalar("arcsin", m.arcsin, "asin({v} / 110)", lambda v: v / 110)
scalar("arccos", m.arccos, "acos({v} / 110)", lambda v: v / 110)
scalar("arctan", m.arctan, "atan({v})")
scalar("arctan2", lambda v: m.arctan2(v - 30, F.lit(-3.0)), "atan2({v} - 30, -3.0)")
scalar("sinh", m.sinh, "sinh({v} / 30)", lambda v: v / 30)
scalar("cosh", m.cosh, "cosh({v} / 30)", lambda v: v / 30)
scalar("tanh", m.tanh, "tanh({v} / 30)", lambda v: v / 30)
scalar("arsinh", m.arsinh, "asinh({v})")
scalar("arcosh", m.arcosh, "acosh({v} + 1)", lambda v: v + 1)
scalar("artanh", m.artanh, "atanh({v} / 110)", lambda v: v / 110)
scalar("pi", lambda v: v * m.pi(), "({v} * pi())")
scalar("e", lambda v: v * m.e(), "({v} * exp(1))")
scalar("nan", lambda v: F.when(v > 20, m.nan()).otherwise(v), "(CASE WHEN {v} > 20 THEN CAST('NaN' AS DOUBLE) ELSE {v} END)")
scalar("constant", lambda v: m.constant(42.5), "42.5")
scalar("apply", lambda v: m.sqrt(m.absolute(v - 20)) + 1, "(sqrt(abs({v} - 20)) + 1)")
scalar("is_infinite", lambda v: l.is_infinite(m.divide(v, 0 * v, ieee=True)), "({v} IS NOT NULL)")
scalar("is_nan", lambda v: F.coalesce(l.is_nan(F.when(v > 20, m.nan()).otherwise(v)), F.lit(False)), "coalesce({v} > 20, false)")
scalar("is_nodata", l.is_nodata, "({v} IS NULL)")
scalar("is_valid", l.is_valid, "({v} IS NOT NULL)")
scalar("gt", lambda v: l.gt(v, 20), "({v} > 20)")
scalar("gte", lambda v: l.gte(v, 20), "({v} >= 20)")
scalar("lt", lambda v: l.lt(v, 20), "({v} < 20)")
scalar("lte", lambda v: l.lte(v, 20), "({v} <= 20)")
scalar("between", lambda v: l.between(v, 10, 30, exclude_max=True), "({v} >= 10 AND {v} < 30)")
scalar("and_", lambda v: l.and_(v > 10, v < 40), "({v} > 10 AND {v} < 40)")
scalar("or_", lambda v: l.or_(v < 10, v > 40), "({v} < 10 OR {v} > 40)")
scalar("xor", lambda v: l.xor(v > 10, v > 40), "(({v} > 10) <> ({v} > 40))")
scalar("not_", lambda v: l.not_(v > 10), "(NOT {v} > 10)")
scalar("if_", lambda v: l.if_(v > 20, v * 2, -1.0), "(CASE WHEN {v} > 20 THEN {v} * 2 ELSE -1.0 END)")


@query("round", """SELECT x, y, t, round_even(B04 / 4, 0) AS r0, round_even(B04 / 16, 1) AS r1, round_even(B04, -1) AS rm1
FROM cube_wide""", "r0 r1 rm1")
def _(t):
    v = F.col("B04")
    return t.wide.df.select("x", "y", "t", m.round_(v / 4).alias("r0"), m.round_(v / 16, 1).alias("r1"), m.round_(v, -1).alias("rm1"))


@query("divide_ieee", """SELECT x, y, t, CASE WHEN SCL = 4 AND B04 > 20 THEN 'inf' WHEN SCL = 4 AND B04 < 20 THEN '-inf'
WHEN SCL = 4 THEN 'nan' ELSE 'finite' END AS kind FROM cube_wide""")
def _(t):
    q = m.divide(F.col("B04") - 20, F.col("SCL") - 4, ieee=True)
    kind = F.when(F.isnan(q), "nan").when(q == m.INF, "inf").when(q == -m.INF, "-inf").otherwise("finite")
    return t.wide.df.select("x", "y", "t", kind.alias("kind"))


@query("convert_data_type", """SELECT x, y, t, CAST(trunc(least(greatest(B04 * 9 - 20, 0), 255)) AS SMALLINT) AS B04,
CAST(trunc(least(greatest(B08 * 9 - 20, 0), 255)) AS SMALLINT) AS B08 FROM cube_wide""")
def _(t):
    return t.optical.filter_bands(["B04", "B08"]).apply(lambda v: v * 9 - 20).convert_data_type("uint8")


@query("eq", """SELECT id, lang = 'en' AS plain, lower(source) = lower('SRC1') AS folded, abs(length(data) - 4000) <= 500 AS near
FROM texts""")
def _(t):
    return t.view("texts").select("id", l.eq(F.col("lang"), "en").alias("plain"), l.eq(F.col("source"), "SRC1", case_sensitive=False).alias("folded"),
                                  l.eq(F.length("data"), 4000, delta=500).alias("near"))


@query("neq", """SELECT id, lang <> 'en' AS plain, lower(source) <> lower('SRC1') AS folded, abs(length(data) - 4000) > 500 AS far
FROM texts""")
def _(t):
    return t.view("texts").select("id", l.neq(F.col("lang"), "en").alias("plain"), l.neq(F.col("source"), "SRC1", case_sensitive=False).alias("folded"),
                                  l.neq(F.length("data"), 4000, delta=500).alias("far"))


@query("text_begins", "SELECT id, starts_with(data, 'The') AS a, starts_with(lower(data), 'the') AS b FROM texts")
def _(t):
    v = F.col("data")
    return t.view("texts").select("id", tx.text_begins(v, "The").alias("a"), tx.text_begins(v, "tHe", case_sensitive=False).alias("b"))


@query("text_ends", "SELECT id, ends_with(data, '.') AS a, ends_with(lower(data), 'e.') AS b FROM texts")
def _(t):
    v = F.col("data")
    return t.view("texts").select("id", tx.text_ends(v, ".").alias("a"), tx.text_ends(v, "E.", case_sensitive=False).alias("b"))


@query("text_contains", "SELECT id, contains(data, 'the') AS a, contains(lower(data), 'license') AS b, contains(data, 'a.') AS c FROM texts")
def _(t):
    v = F.col("data")
    return t.view("texts").select("id", tx.text_contains(v, "the").alias("a"), tx.text_contains(v, "LICENSE", case_sensitive=False).alias("b"),
                                  tx.text_contains(v, "a.").alias("c"))


@query("text_concat", """SELECT id, concat(CAST(id AS VARCHAR), '-', coalesce(lang, 'null'), '-', CASE WHEN id % 2 = 0 THEN 'true' ELSE 'false' END,
'-null-', data) AS joined FROM texts""")
def _(t):
    parts = [F.col("id"), F.col("lang"), F.col("id") % 2 == 0, None, F.col("data")]
    return t.view("texts").select("id", tx.text_concat(parts, "-").alias("joined"))


@query("date_between", """SELECT scene_id, t >= TIMESTAMP '1996-03-01' AND t <= TIMESTAMP '1998-01-01' AS a,
t >= TIMESTAMP '1996-03-01' AND t < TIMESTAMP '1998-01-01' AS b FROM scenes""")
def _(t):
    c = F.col("t")
    return t.view("scenes").select("scene_id", d.date_between(c, "1996-03-01", "1998-01-01").alias("a"),
                                   d.date_between(c, "1996-03-01", "1998-01-01", exclude_max=True).alias("b"))


_MONTHS = """((year(b) - year(a)) * 12 + month(b) - month(a) + CASE WHEN day(a) = day(b) OR (a = last_day(a) AND b = last_day(b))
THEN 0.0 ELSE (day(b) - day(a)) / 31.0 END)"""


@query("date_difference", f"""SELECT scene_id, epoch_us(b) / 1e6 - epoch_us(a) / 1e6 AS seconds, (epoch_us(b) - epoch_us(a)) / 86400e6 AS days,
CAST({_MONTHS} AS DOUBLE) AS months, CAST({_MONTHS} / 12 AS DOUBLE) AS years
FROM (SELECT scene_id, TIMESTAMP '1996-02-29' AS a, t AS b FROM scenes) s""", "seconds days months years")
def _(t):
    a, b = "1996-02-29", F.col("t")
    return t.view("scenes").select("scene_id", d.date_difference(a, b).alias("seconds"), d.date_difference(a, b, "day").alias("days"),
                                   d.date_difference(a, b, "month").alias("months"), d.date_difference(a, b, "year").alias("years"))


@query("date_shift", """SELECT scene_id, t + INTERVAL 1 MONTH AS m1, t - INTERVAL 1 YEAR AS y1, t + INTERVAL 36 HOUR AS h36,
t + INTERVAL 1500 MILLISECOND AS ms, CAST(t + INTERVAL 2 WEEK AS DATE) AS w2 FROM scenes""")
def _(t):
    c = F.col("t")
    return t.view("scenes").select(
        "scene_id", d.date_shift(c, 1, "month").alias("m1"), d.date_shift(c, -1, "year").alias("y1"), d.date_shift(c, 36, "hour").alias("h36"),
        d.date_shift(c, 1500, "millisecond").alias("ms"), d.date_shift(c.cast("date"), 2, "week", date_only=True).alias("w2"))


@query("rfc3339_text", """SELECT scene_id, strftime(t, '%Y-%m-%dT%H:%M:%SZ') AS instant, strftime(t, '%Y-%m-%d') AS day,
t + INTERVAL 90 MINUTE AS back FROM scenes""")
def _(t):
    text = d.rfc3339(F.col("t"))
    shifted = d.rfc3339(F.col("t") + F.expr("interval 90 minutes"))
    return t.view("scenes").select("scene_id", text.alias("instant"), d.rfc3339(F.col("t"), date_only=True).alias("day"),
                                   d.parse_rfc3339(shifted).alias("back"))
