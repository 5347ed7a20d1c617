"""Cube schema: the small driver-side description that travels with a DataFrame."""

from __future__ import annotations

from dataclasses import dataclass, replace

from .errors import BandNotFound, DimensionExists, DimensionNotAvailable, TooManyDimensions

CONSTANT = "cubeloom_constant"  # in the metadata of a key column with one label, written as a literal
DIM_TYPES = ("spatial", "temporal", "bands", "geometry", "other")


@dataclass(frozen=True)
class Band:
    name: str
    common_name: str | None = None
    wavelength: float | None = None  # micrometres
    aliases: tuple[str, ...] = ()
    gsd: float | None = None


@dataclass(frozen=True)
class Dim:
    """A key column of the cube. ``step`` is the pixel size of a spatial dimension."""

    name: str
    type: str = "other"
    step: float | None = None
    crs: int | None = None


@dataclass(frozen=True)
class CubeSchema:
    """Key dimensions plus value columns.

    A cube in wide form has ``band_dim`` set and one value column per band. Once the
    band dimension is gone there is a single value column (named ``value`` by default).
    """

    dims: tuple[Dim, ...] = ()
    bands: tuple[Band, ...] = (Band("value"),)
    band_dim: str | None = None
    collection_id: str | None = None

    @property
    def dim_names(self) -> list[str]:
        return [d.name for d in self.dims]

    @property
    def values(self) -> list[str]:
        return [b.name for b in self.bands]

    @property
    def all_names(self) -> list[str]:
        return self.dim_names + ([self.band_dim] if self.band_dim else [])

    def dim(self, name: str) -> Dim:
        for d in self.dims:
            if d.name == name:
                return d
        raise DimensionNotAvailable(f"{name!r} not in {self.all_names}")

    def has(self, name: str) -> bool:
        return name in self.all_names

    def only(self, type_: str, name: str | None = None) -> str:
        """The one dimension of a type, or the named one."""
        if name is not None:
            return self.dim(name).name
        found = [d.name for d in self.dims if d.type == type_]
        if not found:
            raise DimensionNotAvailable(f"no {type_} dimension in {self.all_names}")
        if len(found) > 1:
            raise TooManyDimensions(f"{found} are all {type_}")
        return found[0]

    @property
    def xy(self) -> tuple[str, str]:
        """Names of the two horizontal dimensions, x first."""
        found = [d.name for d in self.dims if d.type == "spatial" and d.name != "z"]
        if len(found) != 2:
            raise DimensionNotAvailable(f"need two horizontal dimensions, have {found}")
        return found[0], found[1]

    def others(self, *names: str) -> list[str]:
        """All key dimensions but the given ones."""
        for n in names:
            self.dim(n)
        return [d for d in self.dim_names if d not in names]

    def with_dim(self, dim: Dim) -> "CubeSchema":
        if self.has(dim.name):
            raise DimensionExists(dim.name)
        return replace(self, dims=self.dims + (dim,))

    def without(self, *names: str) -> "CubeSchema":
        return replace(self, dims=tuple(d for d in self.dims if d.name not in names))

    def with_bands(self, bands, band_dim: str | None = "keep") -> "CubeSchema":
        bands = tuple(b if isinstance(b, Band) else Band(b) for b in bands)
        return replace(self, bands=bands, band_dim=self.band_dim if band_dim == "keep" else band_dim)

    def single(self, name: str = "value") -> "CubeSchema":
        """The schema after the band dimension was reduced to one value."""
        return replace(self, bands=(Band(name),), band_dim=None)

    def find_bands(self, key) -> list[str]:
        """Bands for a name, alias, common name or index; the unique name wins."""
        if isinstance(key, int) and not isinstance(key, bool):
            if not 0 <= key < len(self.bands):
                raise BandNotFound(f"index {key} of {self.values}")
            return [self.bands[key].name]
        for match in (
            lambda b: b.name == key,
            lambda b: key in b.aliases,
            lambda b: b.common_name == key,
        ):
            found = [b.name for b in self.bands if match(b)]
            if found:
                return found
        raise BandNotFound(f"{key!r} not in {self.values}")
