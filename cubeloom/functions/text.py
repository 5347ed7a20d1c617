"""Text functions. Patterns are plain text, never regular expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .math import col


def _fold(data, pattern, case_sensitive: bool):
    data, pattern = col(data), col(pattern)
    return (data, pattern) if case_sensitive else (F.lower(data), F.lower(pattern))


def text_begins(data, pattern, case_sensitive: bool = True) -> Column:
    return F.startswith(*_fold(data, pattern, case_sensitive))


def text_ends(data, pattern, case_sensitive: bool = True) -> Column:
    return F.endswith(*_fold(data, pattern, case_sensitive))


def text_contains(data, pattern, case_sensitive: bool = True) -> Column:
    return F.contains(*_fold(data, pattern, case_sensitive))


def text_concat(parts, separator: str = "") -> Column:
    """Join a list of columns or an array; numbers, booleans and nulls become lower-case text."""
    if isinstance(parts, (list, tuple)):
        texts = F.array(*[_as_text(p) for p in parts])
    else:
        texts = F.transform(parts, lambda v: F.coalesce(v.cast("string"), F.lit("null")))
    return F.array_join(texts, separator)


def _as_text(part) -> Column:
    if part is None:
        return F.lit("null")
    if isinstance(part, bool):
        return F.lit(str(part).lower())
    return F.coalesce(col(part).cast("string"), F.lit("null"))
