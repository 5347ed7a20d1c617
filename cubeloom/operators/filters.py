"""Spatial and temporal filters, property filters and masks."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import errors as err
from ..functions import dates
from .base import CubeBase
from .geometry import aligned, bounds, pixel_flags


def bbox_dict(value, crs: int | str | None = None) -> dict:
    """A bounding box from a dict or a west-south-east-north sequence."""
    if isinstance(value, dict):
        missing = {"west", "south", "east", "north"} - set(value)
        if missing:
            raise err.InvalidBBox(f"missing {sorted(missing)}")
        box = {k: value[k] for k in ("west", "south", "east", "north")}
        crs = crs or value.get("crs")
        box.update({k: value[k] for k in ("base", "height") if value.get(k) is not None})
    else:
        if len(value) != 4:
            raise err.InvalidBBox(f"need 4 numbers, got {len(value)}")
        box = dict(zip(("west", "south", "east", "north"), value))
    bad = {k: v for k, v in box.items() if isinstance(v, bool) or not isinstance(v, (int, float))}
    if bad:
        raise err.InvalidBBox(f"not numbers: {bad}")
    if crs is not None:
        box["crs"] = int(str(crs).upper().replace("EPSG:", ""))
    return box


def normalize_longitudes(west: float, east: float) -> tuple[float, float]:
    """West to [-180, 180), east to (-180, 180]."""
    return west - 360 * math.floor((west + 180) / 360), east - 360 * math.ceil((east - 180) / 360)


def _between(name: str, low, high) -> Column:
    return (F.col(name) >= low) & (F.col(name) <= high)


def bbox_condition(box: dict, x: str, y: str, z: str | None = None, between=_between) -> Column:
    """Pixel-centre test for a box; longitudes are cyclic, so east may lie left of west."""
    west, east = box["west"], box["east"]
    cyclic = box.get("crs") == 4326
    if cyclic:
        west, east = normalize_longitudes(west, east)
    if cyclic and east < west:
        inside_x = (F.col(x) >= west) | (F.col(x) <= east)
    else:
        inside_x = between(x, west, east)
    cond = inside_x & between(y, box["south"], box["north"])
    if z and "base" in box:
        cond = cond & (F.col(z) >= box["base"])
    if z and "height" in box:
        cond = cond & (F.col(z) <= box["height"])
    return cond


class Property:
    """A scene property in a filter expression, such as ``prop("cloud_cover") <= 20``."""

    def __init__(self, name: str):
        self.name = name

    def _op(self, op, value) -> Column:
        return op(F.col(self.name), value)

    def __eq__(self, v):
        return self._op(lambda c, x: c == x, v)

    def __ne__(self, v):
        return self._op(lambda c, x: c != x, v)

    def __gt__(self, v):
        return self._op(lambda c, x: c > x, v)

    def __ge__(self, v):
        return self._op(lambda c, x: c >= x, v)

    def __lt__(self, v):
        return self._op(lambda c, x: c < x, v)

    def __le__(self, v):
        return self._op(lambda c, x: c <= x, v)

    def is_one_of(self, *options):
        values = options[0] if len(options) == 1 and isinstance(options[0], (list, tuple, set)) else options
        return F.col(self.name).isin(list(values))

    __hash__ = None


def collection_property(name: str) -> Property:
    return Property(name)


class FilterOps(CubeBase):
    def filter_temporal(self, extent=None, end=None, dimension: str | None = None):
        """Keep ``start <= t < end``; either side may be None."""
        t = self.schema.only("temporal", dimension)
        start, stop = dates.extent(extent, end)
        df = self.df
        if start:
            df = df.where(F.col(t) >= dates.ntz(start))
        if stop:
            df = df.where(F.col(t) < dates.ntz(stop))
        return self._new(df)

    def filter_bbox(self, extent, crs: int | None = None):
        box = bbox_dict(extent, crs)
        x, y = self.schema.xy
        z = "z" if self.schema.has("z") else None
        source = self.schema.dim(x).crs
        if box.get("crs") and source and box["crs"] != source:
            from .projection import bbox_to

            box = bbox_to(box, source)
        return self._new(self.df.where(bbox_condition(box, x, y, z, self._between)))

    def filter_spatial(self, geometries):
        """Limit to the bounding box of all geometries, buffers included; pixels inside it stay as they are."""
        x, y = self.schema.xy
        (west, east), (south, north) = bounds("minx", "maxx"), bounds("miny", "maxy")
        box = aligned(geometries, self.schema.dim(x).crs).df.agg(F.struct(
            F.min(west).alias("w"), F.max(east).alias("e"), F.min(south).alias("s"), F.max(north).alias("n")))
        return self._new(self.df.where(
            self._between(x, box.scalar()["w"], box.scalar()["e"]) & self._between(y, box.scalar()["s"], box.scalar()["n"])))

    def mask_polygon(self, mask, replacement=None, inside: bool = False):
        """Replace the pixels whose centre lies outside (or inside) all polygons."""
        x, y = self.schema.xy
        flags = pixel_flags(self, mask)
        df = self.df.join(flags, [x, y], "left")
        hit = F.coalesce(F.col("__hit"), F.lit(False))
        keep = ~hit if inside else hit
        return self._new(df.withColumns({v: F.when(keep, F.col(v)).otherwise(replacement) for v in self.schema.values}))

    def mask(self, mask, replacement=None):
        """Replace cells where the mask is not zero; a mask without a dimension holds for all its labels."""
        on = [d for d in mask.schema.dim_names if self.schema.has(d)]
        names = {v: f"__m_{v}" for v in mask.schema.values}
        right = mask.df.select(*on, *[F.col(v).alias(n) for v, n in names.items()])
        df = self.df.join(right, on, "left")

        def masked(v: str) -> Column:
            flag = F.col(names[v] if v in names and mask.schema.band_dim else next(iter(names.values())))
            return F.when(flag.cast("double") != 0, F.lit(replacement)).otherwise(F.col(v))

        return self._new(df.withColumns({v: masked(v) for v in self.schema.values}))
