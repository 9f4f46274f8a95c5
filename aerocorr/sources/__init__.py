"""Readers, writers and the bindings of the driver's test tables."""

from aerocorr.sources.readings import read_family, read_readings, read_landed  # noqa: F401
from aerocorr.sources.sites import read_sites  # noqa: F401
from aerocorr.sources.cities import read_cities  # noqa: F401
from aerocorr.sources.sinks import materialize, write_parquet, write_sample_csv  # noqa: F401
from aerocorr.sources.landing import land, ledger  # noqa: F401
from aerocorr.sources.versions import expire, fingerprint, open_version, refresh_changed, snapshot  # noqa: F401
from aerocorr.sources.geocode_cache import GeocodeCache  # noqa: F401
from aerocorr.sources.quarantine import Parsed, TooManyRejects, parse_cities, parse_sites, parse_text  # noqa: F401
