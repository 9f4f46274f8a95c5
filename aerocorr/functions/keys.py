"""Composite keys and path pieces."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SEPARATOR = "|"


def coord_key(lat, lon) -> Column:
    """``"<lat>|<lon>"`` text key of a coordinate pair; NULL if a side is."""
    lat = F.col(lat) if isinstance(lat, str) else lat
    lon = F.col(lon) if isinstance(lon, str) else lon
    return F.concat(lat.cast("string"), F.lit(KEY_SEPARATOR), lon.cast("string"))


def split_key(key) -> Column:
    """Inverse of :func:`coord_key`: ``array<double>``; a part that is not a
    number becomes NULL.  The separator is matched literally."""
    key = F.col(key) if isinstance(key, str) else key
    parts = F.split(key, "\\|")
    return F.transform(parts, lambda p: p.try_cast("double"))


def basename(path) -> Column:
    """Last ``/``-separated segment of a path or URL, trailing ``/`` aside."""
    path = F.col(path) if isinstance(path, str) else path
    return F.element_at(F.split(F.regexp_replace(path, "/+$", ""), "/"), -1)
