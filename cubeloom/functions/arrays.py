"""Array functions. Indices are 0-based; labelled arrays are ``array<struct<label, value>>``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .math import col


def _some(data: Column) -> Column:
    return F.filter(data, lambda v: v.isNotNull())


def _nulls(data: Column) -> Column:
    return F.filter(data, lambda v: v.isNull())


def sort(data: Column, asc: bool = True, nodata: bool | None = None) -> Column:
    """Sort values; nulls are removed, or put last (True) or first (False)."""
    ordered = F.sort_array(_some(data), asc)
    if nodata is None:
        return ordered
    return F.concat(ordered, _nulls(data)) if nodata else F.concat(_nulls(data), ordered)


def order(data: Column, asc: bool = True, nodata: bool | None = None) -> Column:
    """The permutation that sorts the data; equal values keep their order."""
    pairs = F.transform(data, lambda v, i: F.struct(v.alias("v"), F.when(F.lit(asc), i).otherwise(-i).alias("i")))
    some = F.sort_array(F.filter(pairs, lambda p: p["v"].isNotNull()), asc)
    index = F.transform(some, lambda p: F.abs(p["i"]))
    if nodata is None:
        return index
    blank = F.transform(F.filter(pairs, lambda p: p["v"].isNull()), lambda p: F.abs(p["i"]))
    return F.concat(index, blank) if nodata else F.concat(blank, index)


def rearrange(data: Column, order: Column) -> Column:
    return F.transform(order, lambda i: F.get(data, i))


def array_append(data: Column, value, label=None) -> Column:
    """Append a value, or with a label a labelled value whose label must be new."""
    if label is None:
        return F.array_append(data, col(value))
    labels = F.transform(data, lambda s: s["label"])
    added = F.array_append(data, F.struct(col(label).alias("label"), col(value).alias("value")))
    return F.when(F.array_contains(labels, col(label)), F.raise_error(F.lit("LabelExists"))).otherwise(added)


def array_apply(data: Column, process) -> Column:
    """Map a function of (value) or (value, index) over the elements."""
    return F.transform(data, process)


def array_concat(array1: Column, array2: Column) -> Column:
    return F.concat(array1, array2)


def array_contains(data: Column, value) -> Column:
    """Membership; never null, and false for a null value."""
    if value is None:
        return F.lit(False)
    return F.coalesce(F.array_contains(data, col(value)), F.lit(False))


def array_create(data, repeat: int = 1) -> Column:
    data = data if isinstance(data, Column) else F.array(*[col(v) for v in data])
    return F.flatten(F.array_repeat(data, repeat))


def array_create_labeled(data: Column, labels: Column) -> Column:
    return F.zip_with(labels, data, lambda l, v: F.struct(l.alias("label"), v.alias("value")))


def array_element(data: Column, index=None, label=None, return_nodata: bool = False) -> Column:
    """Element by index or label; a missing one raises unless ``return_nodata``."""
    if (index is None) == (label is None):
        raise ValueError("give either index or label")
    if index is not None:
        found = F.get(data, col(index))
        missing = (col(index) >= F.size(data)) | (col(index) < 0)
    else:
        hits = F.filter(data, lambda s: s["label"] == col(label))
        found, missing = F.get(hits, F.lit(0))["value"], F.size(hits) == 0
    if return_nodata:
        return found
    return F.when(missing, F.raise_error(F.lit("ArrayElementNotAvailable"))).otherwise(found)


def array_filter(data: Column, condition) -> Column:
    return F.filter(data, condition)


def array_find(data: Column, value, reverse: bool = False) -> Column:
    """Index of the first (or last) match, else null."""
    if value is None:
        return F.lit(None).cast("long")
    source = F.reverse(data) if reverse else data
    at = F.nullif(F.array_position(source, col(value)), F.lit(0).cast("long"))
    return F.size(data) - at if reverse else at - 1


def array_find_label(data: Column, label) -> Column:
    return array_find(F.transform(data, lambda s: s["label"]), label)


def array_labels(data: Column, labelled: bool = True) -> Column:
    if labelled:
        return F.transform(data, lambda s: s["label"])
    return F.transform(data, lambda v, i: i)


def array_modify(data: Column, values, index: int, length: int = 1) -> Column:
    """Replace ``length`` elements from ``index`` on by the given values."""
    new = values if isinstance(values, Column) else F.array(*[col(v) for v in values])
    if isinstance(values, (list, tuple)) and not values:
        new = F.slice(data, 1, 0)
    changed = F.concat(F.slice(data, 1, index), new, F.slice(data, index + length + 1, F.greatest(F.size(data), F.lit(0))))
    return F.when(F.size(data) < index, F.raise_error(F.lit("ArrayElementNotAvailable"))).otherwise(changed)


def array_interpolate_linear(data: Column) -> Column:
    """Fill inner nulls on the line between their valid neighbours, by position.

    One pass left to right keeps the last valid element, one right to left the next.
    """
    known = F.transform(data, lambda v, i: F.when(v.isNotNull(), F.struct(i.alias("i"), v.cast("double").alias("v"))))
    none = F.filter(known, lambda k: F.lit(False))

    def carried(a: Column) -> Column:
        return F.aggregate(a, none, lambda acc, k: F.array_append(acc, F.coalesce(k, F.get(acc, F.size(acc) - 1))))

    left, right = carried(known), F.reverse(carried(F.reverse(known)))
    both = F.arrays_zip(data.alias("d"), left.alias("l"), right.alias("r"))

    def fill(s: Column, i: Column) -> Column:
        l, r = s["l"], s["r"]
        line = l["v"] + (r["v"] - l["v"]) * F.try_divide(i - l["i"], r["i"] - l["i"])
        return F.coalesce(s["d"].cast("double"), line)

    return F.transform(both, fill)


def _running(data: Column, step, ignore_nodata: bool) -> Column:
    start = F.struct(
        F.lit(None).cast("double").alias("acc"), F.lit(False).alias("stop"),
        F.filter(F.transform(data, lambda v: v.cast("double")), lambda v: F.lit(False)).alias("out"),
    )

    def merge(s: Column, v: Column) -> Column:
        v = v.cast("double")
        acc = F.when(v.isNull(), s["acc"]).when(s["acc"].isNull(), v).otherwise(step(s["acc"], v))
        stop = s["stop"] | (v.isNull() if not ignore_nodata else F.lit(False))
        shown = F.when(stop | v.isNull(), F.lit(None).cast("double")).otherwise(acc)
        return F.struct(acc.alias("acc"), stop.alias("stop"), F.array_append(s["out"], shown).alias("out"))

    return F.aggregate(data, start, merge, lambda s: s["out"])


def cumsum(data: Column, ignore_nodata: bool = True) -> Column:
    return _running(data, lambda a, v: a + v, ignore_nodata)


def cumproduct(data: Column, ignore_nodata: bool = True) -> Column:
    return _running(data, lambda a, v: a * v, ignore_nodata)


def cummax(data: Column, ignore_nodata: bool = True) -> Column:
    return _running(data, lambda a, v: F.greatest(a, v), ignore_nodata)


def cummin(data: Column, ignore_nodata: bool = True) -> Column:
    return _running(data, lambda a, v: F.least(a, v), ignore_nodata)
