"""Data-cube analytics as plain Spark DataFrame work."""

from .cube import Cube
from .schema import Band, CubeSchema, Dim
from .session import build_session

__all__ = ["Band", "Cube", "CubeSchema", "Dim", "build_session"]
