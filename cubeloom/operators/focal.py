"""Focal operators: convolution, terrain, and processes on blocks with overlap.

Cells are copied to the tiles whose border zone they lie in (few copies) and shuffled once
by tile. A tile with its halo is a small dense array behind that shuffle, and a kernel
is added up by shifting it; a kernel of rank one takes a pass along x and one along y. The
number of rows does not grow with the kernel.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import errors as err
from ..functions.logic import is_valid
from ..plans.groups import groups
from ..schema import Band, Dim
from .base import CubeBase
from .geometry import TILE
from .measures import DEGREE, by_dimension, in_pixels, measure, moved, time_block
from .projection import is_metric

BORDERS = ("replicate", "reflect", "reflect_pixel", "wrap")


def source_index(u, n, border: str):
    """The in-range index (0..n-1) that stands for an index outside; works on ints and Columns."""
    if border == "replicate":
        return _least(_greatest(u, 0), n - 1)
    if border == "wrap":
        return _mod(u, n)
    if border == "reflect":  # edge value is repeated: fedcba|abcdefgh|hgfedc
        m = _mod(u, 2 * n)
        return _least(m, 2 * n - 1 - m)
    m = _mod(u, _greatest(2 * n - 2, 1))  # edge value is not repeated: gfedcb|abcdefgh|gfedcb
    return _least(m, 2 * n - 2 - m) if not isinstance(n, int) or n > 1 else m


def _least(a, b):
    return min(a, b) if isinstance(a, int) and isinstance(b, int) else F.least(_lit(a), _lit(b))


def _greatest(a, b):
    return max(a, b) if isinstance(a, int) and isinstance(b, int) else F.greatest(_lit(a), _lit(b))


def _mod(a, b):
    return a % b if isinstance(a, int) and isinstance(b, int) else F.pmod(_lit(a), _lit(b))


def _lit(v):
    return v if isinstance(v, Column) else F.lit(v).cast("long")


def _passes(kernel: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """The weights along y and along x whose product the kernel is, if it is one: a row and a column through its largest weight."""
    b, a = np.unravel_index(np.abs(kernel).argmax(), kernel.shape)
    if not kernel[b, a]:
        return kernel[:, 0], kernel[0]
    along_y, along_x = kernel[:, a] / kernel[b, a], kernel[b]
    near = np.abs(np.outer(along_y, along_x) - kernel).max() <= 4 * np.finfo(float).eps * abs(kernel[b, a])
    return (along_y, along_x) if near else None


def _weighted(padded: np.ndarray, kernel: np.ndarray, passes: tuple[np.ndarray, np.ndarray] | None) -> np.ndarray:
    """Sums of the surroundings of every cell of an array that has a border of half a kernel around it."""
    rows, cols = kernel.shape
    height, width = padded.shape[0] - rows + 1, padded.shape[1] - cols + 1
    out = np.zeros((height, width))
    if passes is not None:
        line = np.zeros((padded.shape[0], width))
        for a in np.flatnonzero(passes[1]).tolist():
            line += passes[1][a] * padded[:, a : a + width]
        for b in np.flatnonzero(passes[0]).tolist():
            out += passes[0][b] * line[b : b + height]
        return out
    for b, a in np.argwhere(kernel).tolist():
        out += kernel[b, a] * padded[b : b + height, a : a + width]
    return out


def _tile_sums(keys: list[str], kept: list[str], values: list[str], kernels: dict[str, list[list[float]]], hx: int, hy: int, size: int):
    """The work on sorted tiles: for every own cell of a tile its sums, from a dense array of the tile and its halo."""
    arrays = {n: np.array(k, float) for n, k in kernels.items()}
    passes = {n: _passes(k) for n, k in arrays.items()}

    def work(batches):
        for tile in groups(batches, keys):
            u, v = tile.column("__u").to_numpy(), tile.column("__v").to_numpy()
            own = tile.column("__own").to_numpy() & (u // size == tile.column("__ti").to_numpy()) & (v // size == tile.column("__tj").to_numpy())
            at = np.flatnonzero(own)
            if not at.size:
                continue
            i, j = u - u.min(), v - v.min()
            out = {}
            for name in values:
                padded = np.zeros((int(j.max()) + 1 + 2 * hy, int(i.max()) + 1 + 2 * hx))
                padded[j + hy, i + hx] = tile.column(f"__d_{name}").to_numpy()
                for n, kernel in arrays.items():
                    out[f"{name}__{n}"] = pa.array(_weighted(padded, kernel, passes[n])[j[at], i[at]])
            mine = tile.take(pa.array(at)).combine_chunks()
            columns = [mine.column(c).combine_chunks() for c in (*kept, "__u", "__v", "__nx", "__ny")]
            yield pa.RecordBatch.from_arrays([*columns, *out.values()], names=[*kept, "__ci", "__cj", "__nx", "__ny", *out])

    return work


class FocalOps(CubeBase):
    def _indexed(self) -> tuple[DataFrame, dict[str, Column]]:
        """Pixel indices 0..n-1 as ``__i`` and ``__j``, with the extent as columns."""
        x, y = self.schema.xy
        sx, sy = self.schema.dim(x).step or 1.0, self.schema.dim(y).step or 1.0
        ends = self._scalars(x0=F.min(x), x1=F.max(x), y0=F.min(y), y1=F.max(y))
        df = self.df.withColumns({
            "__i": F.round((F.col(x) - ends["x0"]) / sx).cast("long"),
            "__j": F.round((F.col(y) - ends["y0"]) / sy).cast("long"),
            "__nx": F.round((ends["x1"] - ends["x0"]) / sx).cast("long") + 1,
            "__ny": F.round((ends["y1"] - ends["y0"]) / sy).cast("long") + 1,
        })
        return df, ends

    def _convolved(self, kernels: dict[str, list[list[float]]], border, replace_invalid: float) -> DataFrame:
        """For every present cell the weighted sums ``<value>__<kernel>`` of its surroundings."""
        schema = self.schema
        x, y = schema.xy
        shapes = {(len(k), len(k[0])) for k in kernels.values()}
        if len(shapes) != 1:
            raise err.KernelDimensionsUneven("kernels of one run have one shape")
        rows, cols = shapes.pop()
        if rows % 2 == 0 or cols % 2 == 0 or any(len(r) != cols for k in kernels.values() for r in k):
            raise err.KernelDimensionsUneven(f"{rows} x {cols}")
        hx, hy = cols // 2, rows // 2
        constant = not isinstance(border, str)
        if not constant and border not in BORDERS:
            raise ValueError(f"unknown border {border!r}")
        df, _ = self._indexed()
        values = schema.values
        # missing values count as replace_invalid; subtracting it here lets absent rows be zero
        df = df.withColumns({
            f"__d_{v}": F.when(is_valid(F.col(v).cast("double")), F.col(v).cast("double") - replace_invalid).otherwise(0.0)
            for v in values})

        def images(index: str, n: str, h: int) -> Column:
            """Own index plus the outside indices this cell stands for."""
            own = F.array(F.col(index))
            if constant or h == 0:
                return own
            outside = F.concat(F.sequence(F.lit(-h).cast("long"), F.lit(-1).cast("long")),
                               F.sequence(F.col(n), F.col(n) + (h - 1)))
            return F.concat(own, F.filter(outside, lambda u: source_index(u, F.col(n), border) == F.col(index)))

        def tiles(index: str, h: int) -> Column:
            return F.sequence(F.floor((F.col(index) - h) / TILE), F.floor((F.col(index) + h) / TILE))

        others = schema.others(x, y)
        df = df.withColumn("__u", F.explode(images("__i", "__nx", hx))).withColumn("__v", F.explode(images("__j", "__ny", hy)))
        df = df.withColumn("__ti", F.explode(tiles("__u", hx))).withColumn("__tj", F.explode(tiles("__v", hy)))
        keys = [*others, "__ti", "__tj"]
        kept = [*others, x, y, *values]
        df = df.select(*kept, "__ti", "__tj", "__u", "__v", "__nx", "__ny", ((F.col("__u") == F.col("__i")) & (F.col("__v") == F.col("__j"))).alias("__own"),
                       *[f"__d_{v}" for v in values])
        added = ["__ci", "__cj", "__nx", "__ny", *[f"{v}__{n}" for v in values for n in kernels]]
        kinds = [T.LongType()] * 4 + [T.DoubleType()] * (len(added) - 4)
        tiles_of = _tile_sums(keys, kept, values, kernels, hx, hy, TILE)
        out = df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(
            tiles_of, T.StructType([*[df.schema[c] for c in kept], *[T.StructField(c, k) for c, k in zip(added, kinds)]]))
        sums = [(v, n) for v in values for n in kernels]
        fixed = {}
        for v, n in sums:
            k = kernels[n]
            base = F.lit(float(replace_invalid) * sum(map(sum, k)))
            if constant and float(border) != float(replace_invalid):
                gap = float(border) - float(replace_invalid)
                for b in range(rows):
                    for a in range(cols):
                        i, j = F.col("__ci") + (a - hx), F.col("__cj") + (b - hy)
                        inside = (i >= 0) & (i < F.col("__nx")) & (j >= 0) & (j < F.col("__ny"))
                        if k[b][a] and not (a == hx and b == hy):
                            base = base + F.when(inside, 0.0).otherwise(gap * float(k[b][a]))
            fixed[f"{v}__{n}"] = F.col(f"{v}__{n}") + base
        return out.withColumns(fixed).select(*others, x, y, *values, *fixed)

    def apply_kernel(self, kernel: list[list[float]], factor: float = 1.0, border=0, replace_invalid: float = 0.0):
        """Weighted sum over the surroundings of each cell, times a factor.

        ``kernel[b][a]`` weighs the cell b rows and a columns along y and x; the kernel is
        not mirrored.
        """
        df = self._convolved({"k": kernel}, border, replace_invalid)
        return self._new(df.withColumns({v: F.col(f"{v}__k") * float(factor) for v in self.schema.values}))

    def _gradient(self) -> tuple[DataFrame, float, float]:
        """Horn's 3 x 3 differences; the border repeats the edge cell."""
        x, y = self.schema.xy
        sx, sy = self.schema.dim(x).step or 1.0, self.schema.dim(y).step or 1.0
        kernels = {"gx": [[-1, 0, 1], [-2, 0, 2], [-1, 0, 1]], "gy": [[-1, -2, -1], [0, 0, 0], [1, 2, 1]]}
        return self._convolved(kernels, "replicate", 0.0), 8 * sx, 8 * sy

    def _terrain(self, suffix: str, formula):
        df, wx, wy = self._gradient()
        names = {v: f"{v}_{suffix}" for v in self.schema.values}
        df = df.withColumns({n: formula(F.col(f"{v}__gx") / wx, F.col(f"{v}__gy") / wy) for v, n in names.items()})
        return self._new(df, self.schema.with_bands([Band(n) for n in names.values()], self.schema.band_dim or "bands"))

    def slope(self):
        """Angle to the horizontal in radians, one ``<band>_slope`` per band."""
        return self._terrain("slope", lambda dx, dy: F.atan(F.sqrt(dx * dx + dy * dy)))

    def aspect(self):
        """Downslope direction in radians clockwise from north, NaN where flat."""
        def formula(dx: Column, dy: Column) -> Column:
            angle = F.atan2(-dx, -dy)
            return F.when((dx == 0) & (dy == 0), F.lit(float("nan"))).otherwise(
                F.when(angle < 0, angle + 2 * math.pi).otherwise(angle))

        return self._terrain("aspect", formula)

    # -- blocks ---------------------------------------------------------------------

    def apply_neighborhood(self, process, size: dict, overlap: dict | None = None, schema=None, context: dict | None = None):
        """Run a cube-to-cube process on blocks of ``size`` labels with ``overlap`` on both sides.

        ``size`` and ``overlap`` map a dimension to a number of pixels (for time seconds), a
        text such as ``128 px``, ``100 m``, ``10 days`` or ``P1M``, or are lists of mappings with
        dimension, value and unit. Metres need a known reference system; in degrees they
        hold at the middle latitude. Blocks of months follow the calendar.
        ``process`` is a function of a cube, which then carries the block as an extra
        dimension so that all blocks run in one plan, or with ``schema`` set a function of
        a pandas frame and the context, called once per block. Overlap cells are dropped
        from the result.
        """
        from dataclasses import replace

        cube_schema = self.schema
        size, overlap = by_dimension(size), by_dimension(overlap)
        df = self.df
        own, blocks = [], []
        ends = self._scalars(**{d: F.min(d) for d in size})
        for d, wanted in size.items():
            dim = cube_schema.dim(d)
            temporal = dim.type == "temporal"
            n, pad = measure(wanted, temporal), measure(overlap.get(d, 0), temporal)
            if temporal:
                block = lambda t: time_block(t, ends[d], n)
                at, first, last = block(F.col(d)), block(moved(F.col(d), pad, -1)), block(moved(F.col(d), pad, 1))
            else:
                index, step = F.round((F.col(d) - ends[d]) / (dim.step or 1.0)), dim.step or 1.0
                scale = self._metres(d) if "m" in (n.unit, pad.unit) else 1.0
                n, pad = in_pixels(n, step, scale), in_pixels(pad, step, scale)
                at, first, last = F.floor(index / n), F.floor((index - pad) / n), F.floor((index + pad) / n)
            df = df.withColumns({
                f"__own_{d}": at, f"__blk_{d}": F.explode(F.sequence(F.greatest(first, F.lit(0).cast("long")), last)),
            })
            own.append(f"__own_{d}")
            blocks.append(f"__blk_{d}")
        core = F.lit(True)
        for o, b in zip(own, blocks):
            core = core & (F.col(o) == F.col(b))
        if schema is not None:
            from .udf import call_on_group

            source = df.withColumn("__core", core)
            # blocks without any core cell are only overlap and give no output
            out = source.groupBy(*blocks).applyInPandas(call_on_group(process, context, keep="__core"), schema)
            return type(self)(out, self.schema)
        block = F.concat_ws("~", *[F.col(b).cast("string") for b in blocks])
        spread = df.withColumns({"__block": block, "__core": core})
        sub_schema = cube_schema.with_dim(Dim("block"))
        cells = spread.select(*cube_schema.dim_names, F.col("__block").alias("block"), "__core", *cube_schema.values)
        out = process(type(self)(cells.select(*sub_schema.dim_names, *sub_schema.values), sub_schema))
        kept = cells.where("__core").select(*cube_schema.dim_names, "block")
        df = out.df.join(kept, [*cube_schema.dim_names, "block"], "left_semi")
        return self._new(df, replace(out.schema, dims=cube_schema.dims))

    def _metres(self, d: str) -> Column | float:
        """Metres of one unit of a spatial dimension."""
        crs = self.schema.dim(d).crs
        if crs is None:
            raise err.CrsUnknown(f"a size in metres, {d!r} without a reference system")
        if is_metric(crs):
            return 1.0
        x, y = self.schema.xy
        if d != x:
            return DEGREE
        middle = self._scalars(low=F.min(y), high=F.max(y))
        return F.cos(F.radians((middle["low"] + middle["high"]) / 2)) * DEGREE

    def apply_polygon(self, polygons, process, mask_value=None):
        """Run a cube-to-cube process on the sub-cube of each polygon.

        The sub-cubes are one cube with the polygon as an extra dimension, so the process
        runs for all polygons in one plan. Cells outside all polygons get ``mask_value``;
        a cell in two polygons is an error.
        """
        from dataclasses import replace

        from .geometry import pixel_hits

        schema = self.schema
        x, y = schema.xy
        pixels = self.df.select(x, y).distinct()
        zone = pixel_hits(self, polygons, pixels).groupBy(x, y).agg(
            F.min("geom_id").alias("geom_id"), F.count(F.lit(1)).alias("__n"))
        geom = F.when(F.col("__n") > 1, F.raise_error(F.lit("GeometriesOverlap"))).otherwise(F.col("geom_id"))
        zone = zone.select(x, y, geom.alias("geom_id"))
        joined = self.df.join(zone, [x, y], "left")
        sub_schema = schema.with_dim(Dim("geom_id", "geometry"))
        sub = joined.where(F.col("geom_id").isNotNull()).select(*sub_schema.dim_names, *sub_schema.values)
        done = process(type(self)(sub, sub_schema))
        result = replace(done.schema, dims=schema.dims)
        outside = joined.where(F.col("geom_id").isNull()).select(
            *schema.dim_names, *[F.lit(mask_value).cast("double").alias(v) for v in result.values])
        inside = done.df.select(*schema.dim_names, *[F.col(v).cast("double").alias(v) for v in result.values])
        return self._new(inside.unionByName(outside), result)

    def chunk_polygon(self, chunks, process, mask_value=None):
        """Older name of ``apply_polygon``."""
        return self.apply_polygon(chunks, process, mask_value)
