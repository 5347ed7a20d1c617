"""Queries for reducers and array functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as a
from ..functions import reducers as R
from .base import query

# -- reducers along time, per pixel and band


def reducer(name: str, red, sql: str, r: str = "B02 B04 B08") -> None:
    cols = ", ".join(f"{sql.format(v=b)} AS {b}" for b in ("B02", "B04", "B08"))

    @query(name, f"SELECT x, y, {cols} FROM cube_wide GROUP BY x, y", r)
    def _(t):
        return t.optical.reduce_temporal(red)


ARRAY = "B02[] B04[] B08[]"
reducer("sum", "sum", "sum({v})", "B02 B04:4 B08:4")
reducer("sum_strict", R.sum(ignore_nodata=False), "CASE WHEN count(*) = count({v}) THEN sum({v}) END", "B02 B04:4 B08:4")


@query("product", "SELECT x, y, " + ", ".join(f"product(1.0 + ({b} - 20) / 1e5) AS {b}" for b in ("B02", "B04", "B08")) + " FROM cube_wide GROUP BY x, y", "B02 B04 B08")
def _(t):
    """The reducer itself, over values near 1 so that long products stay finite."""
    return t.optical.apply(lambda v: 1.0 + (v - 20) / 1e5).reduce_temporal("product")


reducer("mean", "mean", "avg({v})")
reducer("mean_strict", R.mean(ignore_nodata=False), "CASE WHEN count(*) = count({v}) THEN avg({v}) END")
reducer("median", "median", "quantile_cont({v}, 0.5)")
reducer("min", "min", "min({v})")
reducer("max", "max", "max({v})")
reducer("extrema", "extrema", "[min({v}), max({v})]", ARRAY)
reducer("sd", "sd", "stddev_samp({v})")
reducer("variance", "variance", "var_samp({v})")
reducer("quantiles", R.quantiles([0.1, 0.25, 0.9]), "quantile_cont({v}, [0.1, 0.25, 0.9])", ARRAY)
reducer("quantiles_q", R.quantiles(q=4), "quantile_cont({v}, [0.25, 0.5, 0.75])", ARRAY)
reducer("count", "count", "count({v})", "")
reducer("count_all", R.count(True), "count(*)", "")
reducer("count_condition", R.count(lambda v: v > 25), "count(*) FILTER (WHERE {v} > 25)", "")
reducer("first", "first", "arg_min({v}, t) FILTER (WHERE {v} IS NOT NULL)")
reducer("first_strict", R.first(ignore_nodata=False), "arg_min_null({v}, t)")
reducer("last", "last", "arg_max({v}, t) FILTER (WHERE {v} IS NOT NULL)")
reducer("rms", "rms", "sqrt(avg({v} * {v}))")


@query("mode", """SELECT x, y, CAST(arg_max(SCL, n * 100 - SCL) AS DOUBLE) AS SCL
FROM (SELECT x, y, SCL, count(*) AS n FROM cube_wide GROUP BY x, y, SCL) c GROUP BY x, y""")
def _(t):
    return t.wide.filter_bands(["SCL"]).reduce_temporal("mode")


@query("all", """SELECT x, y, bool_and(B02 < 0.08) AS B02, bool_and(B04 < 50) AS B04, bool_and(B08 < 200) AS B08
FROM cube_wide GROUP BY x, y""", "B02 B04 B08")
def _(t):
    c = t.optical
    return c._new(c.df.withColumns({"B02": F.col("B02") < 0.08, "B04": F.col("B04") < 50, "B08": F.col("B08") < 200})).reduce_temporal("all")


@query("any", """SELECT x, y, CASE WHEN bool_or(B02 > 0.5) THEN true WHEN count(*) > count(B02) THEN NULL ELSE bool_or(B02 > 0.5) END AS B02,
bool_or(B04 > 49) AS B04, bool_or(B08 > 200) AS B08 FROM cube_wide GROUP BY x, y""", "B02 B04 B08")
def _(t):
    c = t.optical
    flags = c._new(c.df.withColumns({"B02": F.col("B02") > 0.5, "B04": F.col("B04") > 49, "B08": F.col("B08") > 200}))
    return flags.reduce_temporal(R.any(ignore_nodata=False))


# -- array functions, one array per row


def array(name: str, out, sql: str, r: str = "") -> None:
    @query(name, f"SELECT id, {sql} FROM arrays", r)
    def _(t):
        return t.view("arrays").select("id", *[c.alias(n) for n, c in out().items()])


def data():
    return F.col("data")


def labelled():
    return a.array_create_labeled(data(), F.transform(data(), lambda v, i: F.concat(F.lit("f"), i.cast("string"))))


def holes():
    """The data with null in place of what is not positive."""
    return F.transform(data(), lambda v: F.when(v > 0, v.cast("double")))


SQL_HOLES = "list_transform(data, lambda v: CASE WHEN v > 0 THEN CAST(v AS DOUBLE) END)"
SQL_SOME = f"list_filter({SQL_HOLES}, lambda v: v IS NOT NULL)"
SQL_NULLS = f"list_filter({SQL_HOLES}, lambda v: v IS NULL)"

array("sort", lambda: {"plain": a.sort(holes()), "down": a.sort(holes(), asc=False, nodata=True), "front": a.sort(holes(), nodata=False)},
      f"list_sort({SQL_SOME}) AS plain, list_concat(list_reverse_sort({SQL_SOME}), {SQL_NULLS}) AS down, "
      f"list_concat({SQL_NULLS}, list_sort({SQL_SOME})) AS front", "plain[] down[] front[]")
array("order", lambda: {"plain": a.order(data()).cast("array<bigint>"), "down": a.order(data(), asc=False).cast("array<bigint>")},
      "list_transform(list_grade_up(data), lambda i: i - 1) AS plain, list_transform(list_grade_up(data, 'DESC'), lambda i: i - 1) AS down", "plain[]:0 down[]:0")
array("rearrange", lambda: {"sorted": a.rearrange(data(), a.order(data()))}, "list_sort(data) AS sorted", "sorted[]")
array("array_append", lambda: {"data": a.array_append(data(), F.lit(9.5).cast("float")), "n": F.size(a.array_append(labelled(), F.lit(1.0).cast("float"), F.lit("new"))).cast("bigint")},
      "list_append(data, CAST(9.5 AS FLOAT)) AS data, len(data) + 1 AS n", "data[]")
array("array_apply", lambda: {"data": a.array_apply(data(), lambda v, i: v.cast("double") * 2 + i)}, "list_transform(data, lambda v, i: CAST(v AS DOUBLE) * 2 + (i - 1)) AS data", "data[]:4")
array("array_concat", lambda: {"data": a.array_concat(data(), a.sort(data()))}, "list_concat(data, list_sort(data)) AS data", "data[]")
array("array_contains", lambda: {"has": a.array_contains(a.array_append(holes(), F.lit(None).cast("double")), F.element_at(data(), 3).cast("double")), "none": a.array_contains(data(), None)},
      f"coalesce(list_contains({SQL_SOME}, CAST(data[3] AS DOUBLE)), false) AS has, false AS none")
array("array_create", lambda: {"data": a.array_create(data(), repeat=3), "lit": a.array_create([1.0, 2.5])},
      "list_concat(list_concat(data, data), data) AS data, [1.0::DOUBLE, 2.5::DOUBLE] AS lit", "data[] lit[]")
array("array_create_labeled", lambda: {"l7": a.array_element(labelled(), label="f7"), "last": F.element_at(labelled(), -1)["label"]},
      "data[8] AS l7, concat('f', len(data) - 1) AS last", "l7")
array("array_element", lambda: {"third": a.array_element(data(), 2), "none": a.array_element(data(), 999, return_nodata=True), "named": a.array_element(labelled(), label="f5")},
      "data[3] AS third, data[1000] AS none, data[6] AS named", "third none named")
array("array_filter", lambda: {"data": a.array_filter(data(), lambda v, i: (v > 0) & (i % 2 == 0))},
      "list_filter(data, lambda v, i: v > 0 AND (i - 1) % 2 = 0) AS data", "data[]")
array("array_find", lambda: {"first": a.array_find(F.transform(data(), lambda v: v > 0), True).cast("bigint"), "last": a.array_find(F.transform(data(), lambda v: v > 0), True, reverse=True).cast("bigint"),
                     "none": a.array_find(F.transform(data(), lambda v: F.floor(v)), 77)},
      "NULLIF(list_position(list_transform(data, lambda v: v > 0), true), 0)::BIGINT - 1 AS first, "
      "len(data) - NULLIF(list_position(list_reverse(list_transform(data, lambda v: v > 0)), true), 0)::BIGINT AS last, NULL::BIGINT AS none", "first:0 last:0 none:0")
array("array_find_label", lambda: {"pos": a.array_find_label(labelled(), "f11"), "none": a.array_find_label(labelled(), "zz")}, "11::BIGINT AS pos, NULL::BIGINT AS none", "pos:0 none:0")
array("array_interpolate_linear", lambda: {"data": a.array_interpolate_linear(holes())},
      f"""list_transform({SQL_HOLES}, lambda v, i: CASE WHEN v IS NOT NULL THEN v
 WHEN list_max(list_filter(range(1, i), lambda j: data[j] > 0)) IS NULL OR list_min(list_filter(range(i, len(data) + 1), lambda j: data[j] > 0)) IS NULL THEN NULL
 ELSE CAST(data[list_max(list_filter(range(1, i), lambda j: data[j] > 0))] AS DOUBLE)
  + (CAST(data[list_min(list_filter(range(i, len(data) + 1), lambda j: data[j] > 0))] AS DOUBLE) - CAST(data[list_max(list_filter(range(1, i), lambda j: data[j] > 0))] AS DOUBLE))
  * (i - list_max(list_filter(range(1, i), lambda j: data[j] > 0)))
  / (list_min(list_filter(range(i, len(data) + 1), lambda j: data[j] > 0)) - list_max(list_filter(range(1, i), lambda j: data[j] > 0))) END) AS data""", "data[]")
array("array_labels", lambda: {"named": F.array_join(a.array_labels(labelled()), ","), "index": a.array_labels(data(), labelled=False).cast("array<bigint>")},
      "array_to_string(list_transform(data, lambda v, i: concat('f', i - 1)), ',') AS named, range(0, len(data)) AS index", "index[]:0")
array("array_modify", lambda: {"put": a.array_modify(data(), F.array(F.lit(7.0).cast("float"), F.lit(8.0).cast("float")), 2, 3), "cut": a.array_modify(data(), [], 1, 2),
                       "insert": a.array_modify(data(), F.array(F.lit(5.0).cast("float")), 4, 0)},
      "list_concat(list_concat(data[1:2], [7.0::FLOAT, 8.0::FLOAT]), data[6:]) AS put, list_concat(data[1:1], data[4:]) AS cut, "
      "list_concat(list_concat(data[1:4], [5.0::FLOAT]), data[5:]) AS insert", "put[] cut[] insert[]")
array("array_reducers", lambda: {"total": R.sum().arr(data()), "med": R.median().arr(data()), "dev": R.sd().arr(data()), "first_some": R.first().arr(holes()), "valid": R.count().arr(holes())},
      f"list_sum(list_transform(data, lambda v: CAST(v AS DOUBLE))) AS total, list_aggregate(list_transform(data, lambda v: CAST(v AS DOUBLE)), 'quantile_cont', 0.5) AS med, "
      f"list_aggregate(list_transform(data, lambda v: CAST(v AS DOUBLE)), 'stddev_samp') AS dev, ({SQL_SOME})[1] AS first_some, len({SQL_SOME}) AS valid",
      "total:5 med dev:5 first_some")

# -- running functions along time


def running(name: str, sql: str, r: str = "B02 B04:4 B08:4") -> None:
    cols = ", ".join(f"CASE WHEN {b} IS NOT NULL THEN {sql.format(v=b)} OVER w END AS {b}" for b in ("B02", "B04", "B08"))

    @query(name, f"SELECT x, y, t, {cols} FROM cube_wide WINDOW w AS (PARTITION BY x, y ORDER BY t ROWS UNBOUNDED PRECEDING)", r)
    def _(t):
        return t.optical.apply_dimension(name, "t")


running("cumsum", "sum({v})")
running("cummax", "max({v})")
running("cummin", "min({v})")


@query("cumproduct", """SELECT x, y, t, CASE WHEN B04 IS NOT NULL THEN product(1.0 + (B04 - 20) / 1e5) OVER w END AS B04 FROM cube_wide
WINDOW w AS (PARTITION BY x, y ORDER BY t ROWS UNBOUNDED PRECEDING)""", "B04")
def _(t):
    return t.optical.filter_bands(["B04"]).apply(lambda v: F.lit(1.0) + (v - 20) / 1e5).apply_dimension("cumproduct", "t")


@query("cumsum_strict", """SELECT x, y, t, CASE WHEN count(*) OVER w = count(B02) OVER w THEN sum(B02) OVER w END AS B02 FROM cube_wide
WINDOW w AS (PARTITION BY x, y ORDER BY t ROWS UNBOUNDED PRECEDING)""", "B02")
def _(t):
    return t.optical.filter_bands(["B02"]).cumulate("cumsum", "t", ignore_nodata=False)


_FILL = """SELECT x, y, t, coalesce(B02, lv + (rv - lv) * (p - lp) / (rp - lp)) AS B02 FROM (
 SELECT x, y, t, B02, p, last_value(B02 IGNORE NULLS) OVER b AS lv, last_value(CASE WHEN B02 IS NOT NULL THEN p END IGNORE NULLS) OVER b AS lp,
  first_value(B02 IGNORE NULLS) OVER f AS rv, first_value(CASE WHEN B02 IS NOT NULL THEN p END IGNORE NULLS) OVER f AS rp
 FROM (SELECT x, y, t, B02, CAST({p} AS DOUBLE) AS p FROM cube_wide) c
 WINDOW b AS (PARTITION BY x, y ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
  f AS (PARTITION BY x, y ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) s"""


@query("interpolate_time_by_position", _FILL.format(p="row_number() OVER (PARTITION BY x, y ORDER BY t)"), "B02")
def _(t):
    return t.wide.filter_bands(["B02"]).apply_dimension("array_interpolate_linear", "t")


@query("interpolate_time_by_label", _FILL.format(p="epoch_us(t)"), "B02")
def _(t):
    return t.wide.filter_bands(["B02"]).interpolate_linear("t", by="label")


# fixed values: weights of the quadratic fit over five points, in the middle and at the edges
_MIDDLE = "(-3 * lag(v, 2) OVER w + 12 * lag(v) OVER w + 17 * v + 12 * lead(v) OVER w - 3 * lead(v, 2) OVER w) / 35"
_EDGE0 = "(31 * v + 9 * {f}(v, 1) OVER w - 3 * {f}(v, 2) OVER w - 5 * {f}(v, 3) OVER w + 3 * {f}(v, 4) OVER w) / 35"
_EDGE1 = "(9 * {b}(v, 1) OVER w + 13 * v + 12 * {f}(v, 1) OVER w + 6 * {f}(v, 2) OVER w - 5 * {f}(v, 3) OVER w) / 35"


@query("savitzky_golay", f"""SELECT x, y, t, CASE WHEN n < 5 THEN v WHEN p = 1 THEN {_EDGE0.format(f='lead')} WHEN p = 2 THEN {_EDGE1.format(f='lead', b='lag')}
 WHEN p = n THEN {_EDGE0.format(f='lag')} WHEN p = n - 1 THEN {_EDGE1.format(f='lag', b='lead')} ELSE {_MIDDLE} END AS B08
FROM (SELECT x, y, t, B08 AS v, row_number() OVER (PARTITION BY x, y ORDER BY t) AS p, count(*) OVER (PARTITION BY x, y) AS n FROM cube_wide) c
WINDOW w AS (PARTITION BY x, y ORDER BY t)""", "B08")
def _(t):
    return t.wide.filter_bands(["B08"]).smooth_savitzky_golay("t", window=5, degree=2, fill=False)
