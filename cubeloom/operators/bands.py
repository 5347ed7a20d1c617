"""Band math and spectral indices: row-wise expressions, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import errors as err
from ..functions import indices as ix
from ..functions.math import linear_scale_range, normalized_difference
from ..schema import Band
from .base import CubeBase


class BandExpr:
    """One band in an expression; operators on bands of one cube build one Column."""

    def __init__(self, cube, column: Column):
        self._cube, self.column = cube, column

    def _with(self, other, op, keep_single: bool = True):
        if isinstance(other, BandExpr):
            if other._cube is not self._cube:
                return self.cube().merge_cubes(other.cube(), op, keep_single)
            other = other.column
        return BandExpr(self._cube, op(self.column, other))

    def cube(self):
        """The expression as a cube without band dimension."""
        return self._cube._new(self._cube.df.withColumn("value", self.column), self._cube.schema.single())

    def __add__(self, o):
        return self._with(o, lambda a, b: a + b)

    def __radd__(self, o):
        return self._with(o, lambda a, b: b + a)

    def __sub__(self, o):
        return self._with(o, lambda a, b: a - b)

    def __rsub__(self, o):
        return self._with(o, lambda a, b: b - a)

    def __mul__(self, o):
        return self._with(o, lambda a, b: a * b)

    def __rmul__(self, o):
        return self._with(o, lambda a, b: b * a)

    def __truediv__(self, o):
        return self._with(o, lambda a, b: F.try_divide(a, _c(b)))

    def __rtruediv__(self, o):
        return self._with(o, lambda a, b: F.try_divide(_c(b), a))

    def __pow__(self, o):
        return self._with(o, lambda a, b: F.pow(a, _c(b)))

    def __neg__(self):
        return BandExpr(self._cube, -self.column)

    def __invert__(self):
        return BandExpr(self._cube, ~self.column)

    def __eq__(self, o):
        return self._with(o, lambda a, b: a == b, keep_single=False)

    def __ne__(self, o):
        return self._with(o, lambda a, b: a != b, keep_single=False)

    def __lt__(self, o):
        return self._with(o, lambda a, b: a < b, keep_single=False)

    def __le__(self, o):
        return self._with(o, lambda a, b: a <= b, keep_single=False)

    def __gt__(self, o):
        return self._with(o, lambda a, b: a > b, keep_single=False)

    def __ge__(self, o):
        return self._with(o, lambda a, b: a >= b, keep_single=False)

    def __and__(self, o):
        return self._with(o, lambda a, b: a & b)

    def __or__(self, o):
        return self._with(o, lambda a, b: a | b)

    __hash__ = None


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)



class BandOps(CubeBase):
    def b(self, key) -> BandExpr:
        """A band for use in expressions: ``((c.b("nir") - c.b("red")) / 2).cube()``."""
        return BandExpr(self, F.col(self.schema.find_bands(key)[0]).cast("double"))

    def ndvi(self, nir: str | None = None, red: str | None = None, target_band: str | None = None):
        """(nir - red) / (nir + red); with ``target_band`` appended, else the only value."""
        names = {}
        for role, given in (("nir", nir), ("red", red)):
            found = self.schema.find_bands(given or role)
            if not given and not any(b.common_name == role and b.name == found[0] for b in self.schema.bands):
                raise err.BandNotFound(f"no band has the common name {role!r}")
            names[role] = F.col(found[0]).cast("double")
        value = normalized_difference(names["nir"], names["red"])
        if target_band is None:
            return self._new(self.df.withColumn("value", value), self.schema.single())
        if target_band in self.schema.values:
            raise err.LabelExists(target_band)
        schema = self.schema.with_bands([*self.schema.bands, Band(target_band)])
        return self._new(self.df.withColumn(target_band, value), schema)

    def _index_vars(self, variable_map: dict | None, platform: str | None) -> dict[str, Column]:
        if variable_map is None:
            if platform is None:
                if not self.schema.collection_id:
                    raise err.BandMappingError("name the platform or a variable map")
                platform = ix.guess_platform(self.schema.collection_id)
            variable_map = ix.variables(self.schema.values, platform)
        return {var: F.col(self.schema.find_bands(b)[0]).cast("double") for var, b in variable_map.items()}

    def compute_indices(self, indices: list[str], append: bool = False, variable_map: dict | None = None,
                        platform: str | None = None):
        spec = {"collection": {"input_range": None, "output_range": None},
                "indices": {i: {"input_range": None, "output_range": None} for i in indices}}
        return self.compute_and_rescale_indices(spec, append, variable_map, platform)

    def append_indices(self, indices: list[str], variable_map: dict | None = None, platform: str | None = None):
        return self.compute_indices(indices, True, variable_map, platform)

    def compute_index(self, index: str, variable_map: dict | None = None, platform: str | None = None):
        return self.compute_indices([index], False, variable_map, platform)

    def append_index(self, index: str, variable_map: dict | None = None, platform: str | None = None):
        return self.compute_indices([index], True, variable_map, platform)

    def compute_and_rescale_indices(self, index_dict: dict, append: bool = False, variable_map: dict | None = None,
                                    platform: str | None = None):
        """Several indices in one projection, each (and the input bands) scaled to a whole-number range."""
        if set(index_dict) != {"collection", "indices"}:
            raise ValueError("give the keys collection and indices")
        _check_ranges("collection", index_dict["collection"])
        found = {}
        for name, ranges in index_dict["indices"].items():
            index = ix.get_index(name)
            _check_ranges(name, ranges)
            found[name] = (index, ranges)
        columns = self._index_vars(variable_map, platform)
        out = {}
        for name, (index, ranges) in found.items():
            missing = [b for b in index.bands if b not in columns]
            if missing:
                raise err.BandMappingError(f"{name} needs {missing}")
            value = index.formula(columns)
            if ranges["input_range"] is not None:
                value = linear_scale_range(value, *ranges["input_range"], *ranges["output_range"])
            out[name] = value
        dim = self.schema.band_dim or "bands"
        if not append:
            df = self.df.select(*self.schema.dim_names, *[c.alias(n) for n, c in out.items()])
            return self._new(df, self.schema.with_bands(list(out), dim))
        scale = index_dict["collection"]
        bands = {v: F.col(v) for v in self.schema.values}
        if scale["input_range"] is not None:
            bands = {v: linear_scale_range(c, *scale["input_range"], *scale["output_range"]) for v, c in bands.items()}
        df = self.df.select(*self.schema.dim_names, *[c.alias(n) for n, c in {**bands, **out}.items()])
        return self._new(df, self.schema.with_bands([*self.schema.bands, *[Band(n) for n in out]], dim))

    def append_and_rescale_indices(self, index_dict: dict, variable_map: dict | None = None, platform: str | None = None):
        return self.compute_and_rescale_indices(index_dict, True, variable_map, platform)


def _check_ranges(name: str, ranges: dict) -> None:
    if set(ranges) != {"input_range", "output_range"}:
        raise ValueError(f"{name}: give input_range and output_range")
    given = [r for r in ranges.values() if r is not None]
    if len(given) == 1:
        raise ValueError(f"{name}: give both ranges or none")
    for r in given:
        if len(r) != 2 or not all(isinstance(v, int) for v in r):
            raise ValueError(f"{name}: a range is two whole numbers")


def index_table(spark) -> DataFrame:
    """The catalogue of indices as a table."""
    rows = [(i.name, i.long_name, i.kind, list(i.bands)) for i in ix.load_indices().values()]
    return spark.createDataFrame(rows, "name string, long_name string, kind string, bands array<string>")
