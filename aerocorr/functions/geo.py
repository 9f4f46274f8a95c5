"""Planar geometry on (lat, lon) degrees."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def planar_distance(lat1, lon1, lat2, lon2) -> Column:
    """Euclidean distance in degrees, ``sqrt(dlat^2 + dlon^2)``; NULL if any
    input is NULL.  Written with products (not ``pow``) so every engine
    rounds it identically and equal distances stay equal (ties)."""
    dlat = _c(lat1) - _c(lat2)
    dlon = _c(lon1) - _c(lon2)
    return F.sqrt(dlat * dlat + dlon * dlon)


CELL_LIMIT = float(1 << 52)


def grid_cell(coord, cell_size) -> Column:
    """Index of the grid cell of width ``cell_size`` holding ``coord``.
    Coordinates beyond 2**52 cells share the outermost one, so any finite value
    has a cell (clamping never takes two points further apart)."""
    size = cell_size if isinstance(cell_size, Column) else F.lit(float(cell_size))
    ratio = F.least(F.greatest(_c(coord) / size, F.lit(-CELL_LIMIT)), F.lit(CELL_LIMIT))
    return F.floor(ratio)
