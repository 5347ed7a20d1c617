"""The registered queries with their SQL twins."""

from . import arrays, cubes, scalars, space  # noqa: F401  (each fills the registry)
from .base import REGISTRY, Tables

__all__ = ["REGISTRY", "Tables"]
