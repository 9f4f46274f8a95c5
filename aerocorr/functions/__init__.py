"""Column-expression builders (all native Spark expressions, no UDFs)."""

from aerocorr.functions.geo import planar_distance, grid_cell  # noqa: F401
from aerocorr.functions.time import hour_of_day, reading_hour  # noqa: F401
from aerocorr.functions.keys import coord_key, split_key, basename  # noqa: F401
from aerocorr.functions.address import parse_address  # noqa: F401
