"""Spatial resampling and reprojection of the pixel grid.

Every source pixel names the target cells it contributes to, so no grid has to be joined:
``near`` needs no shuffle at all, the other methods one ``groupBy`` on the target cell.
Across reference systems the area methods use the projected outline of each pixel: its four
corners, which neighbours share, so that the outlines fill the plane without gap or overlap.
"""

from __future__ import annotations

import math
from dataclasses import replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..errors import UnsupportedProjection
from ..functions import reducers as R
from ..plans.grouping import group_reduce
from .base import CubeBase
from .projection import epsg, let, project, project_all

AREA = {"min": "min", "max": "max", "med": "median", "q1": R.quantiles([0.25]), "q3": R.quantiles([0.75]), "mode": "mode"}
WEIGHTED = ("average", "sum", "rms")


def _bilinear(d: Column) -> Column:
    return F.greatest(1 - F.abs(d), F.lit(0.0))


def _cubic(d: Column) -> Column:
    """Cubic convolution with a = -0.5."""
    d = F.abs(d)
    return F.when(d <= 1, 1.5 * d * d * d - 2.5 * d * d + 1).when(
        d < 2, -0.5 * d * d * d + 2.5 * d * d - 4 * d + 2).otherwise(0.0)


def _cubicspline(d: Column) -> Column:
    """Cubic B-spline."""
    d = F.abs(d)
    return F.when(d <= 1, 2 / 3 - d * d + d * d * d / 2).when(d < 2, (2 - d) * (2 - d) * (2 - d) / 6).otherwise(0.0)


def _lanczos(d: Column) -> Column:
    """Windowed sinc with three lobes."""
    p = d * math.pi
    return F.when(d == 0, 1.0).when(F.abs(d) < 3, F.try_divide(3 * F.sin(p) * F.sin(p / 3), p * p)).otherwise(0.0)


KERNELS = {"bilinear": (_bilinear, 1.0), "cubic": (_cubic, 2.0), "cubicspline": (_cubicspline, 2.0), "lanczos": (_lanczos, 3.0)}
ALIGN = ("upper-left", "upper-right", "lower-left", "lower-right")


def _span(points: list[tuple[Column, Column]], source: int, target: int) -> tuple[Column, Column, Column, Column]:
    """Bounds of projected points."""
    moved = project_all(points, source, target)
    return F.array_min(moved["x"]), F.array_max(moved["x"]), F.array_min(moved["y"]), F.array_max(moved["y"])


def _clipped_area(corners: Column, west: Column, south: Column, rx: float, ry: float) -> Column:
    """Area, in target cells, of the part of an outline that lies in the cell with the given lower-left corner.

    Each side adds the signed area between the cell's lower edge and itself, where it runs
    over the cell: the height is cut to the cell, so what is added is a level stretch at 0,
    a slope, and a level stretch at 1. Nothing is divided by a difference that vanishes.
    """
    def cut(v: Column) -> Column:
        return F.greatest(F.lit(0.0), F.least(F.lit(1.0), v))

    def side(a: Column, b: Column) -> Column:
        ax, ay, bx, by = (a["x"] - west) / rx, (a["y"] - south) / ry, (b["x"] - west) / rx, (b["y"] - south) / ry
        whole = F.struct(ax.alias("x"), ay.alias("y"), (bx - ax).alias("dx"), (by - ay).alias("dy"))
        # the stretch of the side that runs over the cell, from u to v of its length
        over = let(whole, lambda q: F.struct(
            *[q[k].alias(k) for k in ("x", "y", "dx", "dy")],
            F.coalesce(cut(F.try_divide(-q["x"], q["dx"])), F.lit(0.0)).alias("u"),
            F.coalesce(cut(F.try_divide(1.0 - q["x"], q["dx"])), F.lit(0.0)).alias("v")))
        steps = let(over, lambda q: F.struct(
            *[q[k].alias(k) for k in ("y", "dx", "dy")], F.least(q["u"], q["v"]).alias("u"), F.greatest(q["u"], q["v"]).alias("v")))
        # within it, where the height passes 0 and 1; a level side has no such place
        def height(q: Column) -> Column:
            def place(level: float) -> Column:
                return F.greatest(q["u"], F.least(q["v"], F.try_divide(level - q["y"], q["dy"])))

            m, n = F.least(place(0.0), place(1.0)), F.greatest(place(0.0), place(1.0))
            start, end = cut(q["y"] + q["dy"] * q["u"]), cut(q["y"] + q["dy"] * q["v"])
            slope = (n - m) * cut(q["y"] + q["dy"] * (m + n) / 2)
            return q["dx"] * F.when(q["dy"] == 0, (q["v"] - q["u"]) * start).otherwise(
                (m - q["u"]) * start + slope + (q["v"] - n) * end)

        return let(steps, height)

    following = F.concat(F.slice(corners, 2, 3), F.slice(corners, 1, 1))
    return F.abs(F.aggregate(F.zip_with(corners, following, side), F.lit(0.0), lambda total, part: total + part))


def _outline_area(corners: Column) -> Column:
    """Area of an outline of four corners, by its diagonals."""
    a, b, c, d = (F.get(corners, F.lit(i)) for i in range(4))
    return F.abs((c["x"] - a["x"]) * (d["y"] - b["y"]) - (c["y"] - a["y"]) * (d["x"] - b["x"])) / 2


class ResampleOps(CubeBase):
    def resample_spatial(self, resolution=0, projection=None, method: str = "near", align: str = "upper-left"):
        """Resample to a new pixel size and/or reference system, aligned to one corner of the extent."""
        if align not in ALIGN:
            raise ValueError(f"align {align!r}")
        schema = self.schema
        x, y = schema.xy
        sx, sy = schema.dim(x).step or 1.0, schema.dim(y).step or 1.0
        rx, ry = resolution if isinstance(resolution, (list, tuple)) else (resolution, resolution)
        source, target = schema.dim(x).crs or 4326, epsg(projection) if projection else schema.dim(x).crs or 4326
        if source != target and not (rx and ry):
            raise UnsupportedProjection("a new reference system needs a resolution")
        rx, ry = float(rx or sx), float(ry or sy)
        cx, cy = F.col(x).cast("double"), F.col(y).cast("double")
        low_x, high_x, low_y, high_y = _span([(cx + a * sx / 2, cy + b * sy / 2) for a in (-1, 1) for b in (-1, 1)], source, target)
        ends = self._scalars(w=F.min(low_x), e=F.max(high_x), s=F.min(low_y), n=F.max(high_y))
        # the grid starts at the chosen corner: origin, then direction of counting
        ox = ends["w"] if align.endswith("left") else ends["e"] - F.ceil((ends["e"] - ends["w"]) / rx - 1e-9) * rx
        oy = ends["s"] if align.startswith("lower") else ends["n"] - F.ceil((ends["n"] - ends["s"]) / ry - 1e-9) * ry
        grid = {"x": (ox, rx, ends["w"], ends["e"]), "y": (oy, ry, ends["s"], ends["n"])}
        return self._onto(grid, method, source, target)

    def resample_cube_spatial(self, target, method: str = "near"):
        """Resample onto the grid of another cube."""
        tx, ty = target.schema.xy
        dx, dy = target.schema.dim(tx), target.schema.dim(ty)
        rx, ry = dx.step or 1.0, dy.step or 1.0
        ends = target._scalars(x0=F.min(tx), x1=F.max(tx), y0=F.min(ty), y1=F.max(ty))
        grid = {"x": (ends["x0"] - rx / 2, rx, ends["x0"] - rx / 2, ends["x1"] + rx / 2),
                "y": (ends["y0"] - ry / 2, ry, ends["y0"] - ry / 2, ends["y1"] + ry / 2)}
        source = self.schema.dim(self.schema.xy[0]).crs or 4326
        return self._onto(grid, method, source, dx.crs or source)

    def _onto(self, grid: dict, method: str, source: int, target: int):
        schema = self.schema
        x, y = schema.xy
        sx, sy = schema.dim(x).step or 1.0, schema.dim(y).step or 1.0
        (ox, rx, west, east), (oy, ry, south, north) = grid["x"], grid["y"]
        kernel, support = KERNELS.get(method, (None, 0.5))
        if kernel is None and method != "near" and method not in AREA and method not in WEIGHTED:
            raise ValueError(f"unknown method {method!r}")
        same = source == target
        # a kernel widens with the reduction ratio, so every source pixel is used
        fx, fy = (max(1.0, rx / sx), max(1.0, ry / sy)) if same else (1.0, 1.0)
        ax, ay = (support * fx * sx, support * fy * sy) if kernel else (sx / 2, sy / 2)
        cx, cy = F.col(x).cast("double"), F.col(y).cast("double")
        if same:
            lx, hx, ly, hy = cx - ax, cx + ax, cy - ay, cy + ay
        else:
            lx, hx, ly, hy = _span([(cx + a * ax, cy + b * ay) for a in (-1, 0, 1) for b in (-1, 0, 1)], source, target)
        by_area = method in AREA or method in WEIGHTED
        df = self.df
        if by_area and not same:
            ring = [(cx + a * sx / 2, cy + b * sy / 2) for a, b in ((-1, -1), (1, -1), (1, 1), (-1, 1))]
            df = df.withColumn("__q", project_all(ring, source, target))
            lx, hx, ly, hy = (end(F.col("__q")[c]) for c in "xy" for end in (F.array_min, F.array_max))

        def cells(low: Column, high: Column, o: Column, r: float, first: Column, last: Column) -> Column:
            """Indices whose centre (or, by area, whose cell) the range touches, within the grid."""
            if by_area:
                a, b = F.floor((low - o) / r + 1e-9), F.ceil((high - o) / r - 1e-9) - 1
            else:
                a, b = F.ceil((low - o) / r - 0.5 - 1e-9), F.floor((high - o) / r - 0.5 + 1e-9)
            a = F.greatest(a, F.floor((first - o) / r + 1e-9))
            b = F.least(b, F.ceil((last - o) / r - 1e-9) - 1)
            return F.when(a <= b, F.sequence(a, b))

        df = df.withColumns({"__ox": ox, "__oy": oy})
        df = df.withColumn("__k", F.explode(cells(lx, hx, F.col("__ox"), rx, west, east)))
        df = df.withColumn("__l", F.explode(cells(ly, hy, F.col("__oy"), ry, south, north)))
        tx, ty = F.col("__ox") + (F.col("__k") + 0.5) * rx, F.col("__oy") + (F.col("__l") + 0.5) * ry
        bx, by = (tx, ty) if same else project(tx, ty, target, source)
        df = df.withColumns({"__tx": tx, "__ty": ty, "__bx": bx, "__by": by})
        new_dims = tuple(replace(d, step={x: rx, y: ry}[d.name], crs=target) if d.name in (x, y) else d for d in schema.dims)
        out_schema = replace(schema, dims=new_dims)
        others = schema.others(x, y)
        target_cols = [F.col("__tx").alias(x), F.col("__ty").alias(y)]
        dx, dy = (F.col("__bx") - cx) / sx, (F.col("__by") - cy) / sy
        if method == "near":
            # the pixel a target centre falls in; a centre on an edge belongs to the higher pixel
            hit = (F.round(dx, 9) >= -0.5) & (F.round(dx, 9) < 0.5) & (F.round(dy, 9) >= -0.5) & (F.round(dy, 9) < 0.5)
            return self._new(df.where(hit).select(*others, *target_cols, *schema.values), out_schema)
        if by_area and not same:
            df = df.withColumns({"__p": _outline_area(F.col("__q")) / (rx * ry),
                                 "__a": _clipped_area(F.col("__q"), F.col("__tx") - rx / 2, F.col("__ty") - ry / 2, rx, ry)})
            df = df.where(F.col("__a") > 1e-9 * F.least(F.lit(1.0), F.col("__p")))  # what only touches has no share
        if method in AREA:
            rows = df.select(*others, *target_cols, *schema.values)
            out = group_reduce(rows, [*others, x, y], schema.values, AREA[method])
            if method in ("q1", "q3"):
                out = out.withColumns({v: F.col(v)[0] for v in schema.values})
            return self._new(out, out_schema)
        if method in WEIGHTED:
            def share(c: Column, s: float, t: Column, r: float) -> Column:
                return (F.least(c + s / 2, t + r / 2) - F.greatest(c - s / 2, t - r / 2)) / s

            weight = share(cx, sx, F.col("__tx"), rx) * share(cy, sy, F.col("__ty"), ry) if same else F.col("__a")
            if not same and method == "sum":  # a pixel is shared out by the part of it that a cell holds
                weight = weight / F.col("__p")
        else:
            weight = kernel(dx / fx) * kernel(dy / fy)
        df = df.withColumn("__w", weight).where(F.col("__w") != 0)
        df = df.select(*others, *target_cols, "__w", *schema.values)

        def total(v: str) -> Column:
            c, w = F.col(v), F.when(F.col(v).isNotNull(), F.col("__w"))
            if method == "sum":
                return F.sum(w * c)
            if method == "rms":
                return F.sqrt(F.try_divide(F.sum(w * c * c), F.sum(w)))
            return F.try_divide(F.sum(w * c), F.sum(w))

        return self._new(df.groupBy(*others, x, y).agg(*[total(v).alias(v) for v in schema.values]), out_schema)
