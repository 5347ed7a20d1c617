"""Merging cubes and resampling time to another cube's labels."""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import errors as err
from ..plans import scan as sc
from ..schema import CONSTANT, CubeSchema
from .base import CubeBase


def outer_join(left: DataFrame, right: DataFrame, schema: CubeSchema) -> DataFrame:
    """Full outer join on all dimensions, by sorting or hashing whatever their labels are.

    Where a dimension has one constant label on either side, Spark compares the two while
    planning; if they differ it is left with a join on ``false``, which tries every pair of rows.
    So labels that may be constants are compared together with a dimension that varies.
    """
    def constant(name: str) -> bool:
        return schema.dim(name).type == "other" or any(CONSTANT in df.schema[name].metadata for df in (left, right))

    names = schema.dim_names
    fixed = [n for n in names if constant(n)]
    plain = [n for n in names if n not in fixed]
    if not fixed or not plain:
        return left.join(right, names, "full_outer")

    def keyed(df: DataFrame) -> DataFrame:
        # null where the label is null: nulls meet nothing
        return df.withColumns({f"__k_{n}": F.when(F.col(n).isNotNull(), F.struct(F.col(n).alias("label"), F.col(plain[0]).alias("along"))) for n in fixed})

    other = keyed(right).withColumnsRenamed({n: f"__r_{n}" for n in fixed})
    both = keyed(left).join(other, plain + [f"__k_{n}" for n in fixed], "full_outer")
    both = both.withColumns({n: F.coalesce(n, f"__r_{n}") for n in fixed})
    return both.select(*names, *[c for c in both.columns if c not in names and not c.startswith(("__k_", "__r_"))])


class MergeOps(CubeBase):
    def merge_cubes(self, other, overlap_resolver=None, keep_single: bool = True):
        """Union of the labels of shared dimensions; the resolver decides where both hold data.

        A cube that lacks dimensions is spread over them. Bands only one cube has are
        kept next to each other. Without a resolver, overlapping data is an error.
        With ``keep_single=False`` cells of only one cube become null, as a comparison needs.
        A cube without dimensions and bands adds nothing: it is filled by what it is merged with.
        """
        a, b = self.schema, other.schema
        for one, rest in ((a, other), (b, self)):
            if not one.dim_names and not one.values:
                return rest
        shared = [d for d in a.dim_names if b.has(d)]
        if len(shared) < len(b.dim_names) and len(shared) < len(a.dim_names):
            raise err.DimensionMismatch(f"{a.dim_names} and {b.dim_names} each have dimensions the other lacks")
        if len(a.dim_names) < len(b.dim_names):
            flip = (lambda x, y: overlap_resolver(y, x)) if overlap_resolver else None
            return other.merge_cubes(self, flip, keep_single)
        spread = len(b.dim_names) < len(a.dim_names)
        if a.band_dim and b.band_dim:
            pairs = {v: v for v in a.values if v in b.values}
        elif b.band_dim and not a.band_dim:
            raise err.DimensionMismatch("the base cube has no bands, the other has")
        else:
            # a cube without bands has one value per cell, whatever its column is called
            pairs = {v: b.values[0] for v in a.values}
        left = self.df.withColumn("__in_a", F.lit(True))
        right = other.df.select(*shared, F.lit(True).alias("__in_b"), *[F.col(v).alias(f"__b_{v}") for v in b.values])
        df = left.join(right, shared, "left") if spread else outer_join(left, right, a)

        def value(v: str) -> Column:
            x = F.col(v)
            if v not in pairs:
                return x
            y = F.col(f"__b_{pairs[v]}")
            both = F.coalesce(F.col("__in_a"), F.lit(False)) & F.coalesce(F.col("__in_b"), F.lit(False))
            if overlap_resolver is None:
                clash = both & x.isNotNull() & y.isNotNull()
                return F.when(clash, F.raise_error(F.lit("OverlapResolverMissing"))).otherwise(F.coalesce(x, y))
            resolved = F.when(both, overlap_resolver(x, y))
            return resolved.otherwise(F.coalesce(x, y)) if keep_single else resolved

        extra = [x for x in b.bands if x.name not in pairs.values()]
        columns = {v: value(v) for v in a.values}
        columns.update({x.name: F.col(f"__b_{x.name}") for x in extra})
        schema = a.with_bands([*a.bands, *extra], a.band_dim or b.band_dim)
        return self._new(df.select(*a.dim_names, *[c.alias(n) for n, c in columns.items()]), schema)

    def _operate(self, op, other, flip: bool = False, keep_single: bool = True):
        """``cube op cube`` merges with the operator, ``cube op number`` applies it."""
        fn = (lambda x, y: op(y, x)) if flip else op
        if isinstance(other, CubeBase):
            return self.merge_cubes(other, fn, keep_single)
        return self._new(self._map_values(lambda c: fn(c, other)))

    def __add__(self, o):
        return self._operate(operator.add, o)

    def __radd__(self, o):
        return self._operate(operator.add, o, True)

    def __sub__(self, o):
        return self._operate(operator.sub, o)

    def __rsub__(self, o):
        return self._operate(operator.sub, o, True)

    def __mul__(self, o):
        return self._operate(operator.mul, o)

    def __rmul__(self, o):
        return self._operate(operator.mul, o, True)

    def __truediv__(self, o):
        return self._operate(_divide, o)

    def __rtruediv__(self, o):
        return self._operate(_divide, o, True)

    def __pow__(self, o):
        return self._operate(lambda x, y: F.pow(x, _col(y)), o)

    def __neg__(self):
        return self._new(self._map_values(lambda c: -c))

    def __eq__(self, o):
        return self._operate(operator.eq, o, keep_single=False)

    def __ne__(self, o):
        return self._operate(operator.ne, o, keep_single=False)

    def __lt__(self, o):
        return self._operate(operator.lt, o, keep_single=False)

    def __le__(self, o):
        return self._operate(operator.le, o, keep_single=False)

    def __gt__(self, o):
        return self._operate(operator.gt, o, keep_single=False)

    def __ge__(self, o):
        return self._operate(operator.ge, o, keep_single=False)

    def __and__(self, o):
        return self._operate(operator.and_, o)

    def __or__(self, o):
        return self._operate(operator.or_, o)

    def __invert__(self):
        return self._new(self._map_values(lambda c: ~c))

    __hash__ = None

    def resample_cube_temporal(self, target, dimension: str | None = None, valid_within: float | None = None):
        """Each target timestamp takes the nearest source value, the earlier one on a tie.

        With ``valid_within`` only valid values at most that many days away count. An as-of
        join: the source's times are cut into ranges, every series meets the target's
        labels range by range as rows, and a scan carries the last and next source value over
        the borders of the ranges. Every pair that is built is a cell of the result.
        """
        schema = self.schema
        t = dimension or schema.only("temporal")
        if not schema.has(t) or not target.schema.has(t):
            raise err.DimensionNotAvailable(t)
        if schema.dim(t).type != "temporal" or target.schema.dim(t).type != "temporal":
            raise err.DimensionMismatch(t)
        keys = schema.others(t)
        ranges = sc.range_count(self.df)
        cuts = sc.cut_points(self.df, t, ranges) if ranges > 1 else None
        labels = sc.with_chunk(target.df.select(F.col(t).cast(self.df.schema[t].dataType).alias(t)).distinct(), t, ranges, cuts)
        goals = self.df.select(*keys).distinct().withColumn(sc.CHUNK, F.explode(F.sequence(F.lit(0), F.lit(ranges - 1)))).join(labels, sc.CHUNK)
        source = sc.with_chunk(self.df, t, ranges, cuts)
        cols = [*keys, t, sc.CHUNK]
        # of one instant the source comes first: it is the last known value of its goal
        series = source.select(*cols, F.lit(False).alias("__goal"), *[F.col(v).alias(f"__v_{v}") for v in schema.values]).unionByName(
            goals.select(*cols, F.lit(True).alias("__goal"), *[F.lit(None).cast(self.df.schema[v].dataType).alias(f"__v_{v}") for v in schema.values]))
        series = series.withColumn("__us", sc.order_key(series, t))
        runs = {}
        for v in schema.values:
            cell = F.struct(F.col("__us").alias("o"), F.col(f"__v_{v}").alias("v"))
            good = ~F.col("__goal") & (F.col(f"__v_{v}").isNotNull() if valid_within is not None else F.lit(True))
            known = F.when(good, cell)
            runs[f"__p_{v}"] = sc.Running(F.max, known, lambda c, l: F.coalesce(l, c))
            runs[f"__n_{v}"] = sc.Running(F.min, known, lambda c, l: F.coalesce(l, c), forward=False)
        found = sc.scan(series, keys, t, runs, then="__goal").where("__goal")

        def nearest(v: str) -> Column:
            before, after = F.col(f"__p_{v}"), F.col(f"__n_{v}")
            back, ahead = F.col("__us") - before["o"], after["o"] - F.col("__us")
            if valid_within is not None:
                limit = int(valid_within * 86400e6)
                back, ahead = F.when(back <= limit, back), F.when(ahead <= limit, ahead)
            return F.when(back.isNotNull() & (ahead.isNull() | (back <= ahead)), before["v"]).when(
                ahead.isNotNull(), after["v"])

        return self._new(found.withColumns({v: nearest(v) for v in schema.values}))


def _col(x):
    return x if isinstance(x, Column) else F.lit(x)


def _divide(x, y):
    return F.try_divide(_col(x), _col(y))
