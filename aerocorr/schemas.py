"""Canonical schemas of the sensor-network data model.

Fixed values (they must equal the source data model for results to line up):
column names and types of the three device families, of the site file and of
the 19-column gazetteer, and the study defaults below.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: reading families -------------------------------------------
BASE_FIELDS = [
    ("sensor_id", T.LongType()),   # declared int at the source; widened losslessly
    ("sensor_type", T.StringType()),
    ("location", T.IntegerType()),
    ("lat", T.DoubleType()),
    ("lon", T.DoubleType()),
    ("timestamp", T.StringType()),
]
FAMILY_1_EXTRA = [  # sds011, ppd42ns
    ("P1", T.DoubleType()), ("durP1", T.StringType()), ("ratioP1", T.StringType()),
    ("P2", T.DoubleType()), ("durP2", T.StringType()), ("ratioP2", T.StringType()),
]
FAMILY_2_EXTRA = [("P1", T.DoubleType()), ("P2", T.DoubleType())]  # hpm
FAMILY_3_EXTRA = FAMILY_2_EXTRA + [("P0", T.DoubleType())]  # pms3003, pms5003, pms7003

# --- fixed values: study defaults ---------------------------------------------
MAX_VALUE = 5000.0          # outlier bound, strict
DAY_FIRST_HOUR = 6          # daytime = hours 6..17 inclusive
DAY_LAST_HOUR = 17
COUNTRY_CODE = "DE"
COUNTRY_NAME = "Deutschland"
FAILED_LOOKUP = "error"
CITY_RADIUS = 0.05          # degrees, strict
SAMPLE_ROWS = 5000


def _struct(fields, nullable=True):
    return T.StructType([T.StructField(n, t, nullable) for n, t in fields])


FAMILY_SCHEMAS = {
    1: _struct(BASE_FIELDS + FAMILY_1_EXTRA),
    2: _struct(BASE_FIELDS + FAMILY_2_EXTRA),
    3: _struct(BASE_FIELDS + FAMILY_3_EXTRA),
}

# Superset of all families plus the family tag: what unify_families returns.
READING_SCHEMA = _struct(
    BASE_FIELDS + FAMILY_1_EXTRA + [("P0", T.DoubleType()), ("family", T.IntegerType())]
)

SITE_SCHEMA = T.StructType([
    T.StructField("latitude", T.DoubleType(), False),
    T.StructField("longitude", T.DoubleType(), False),
])

# --- fixed values: gazetteer (tab separated, no header), in file order ----------
CITY_FIELDS = [
    ("geonameid", T.IntegerType(), False),
    ("name", T.StringType(), True),
    ("asciiname", T.StringType(), True),
    ("alternatenames", T.StringType(), True),
    ("latitude", T.DoubleType(), False),
    ("longitude", T.DoubleType(), False),
    ("feature_class", T.StringType(), True),
    ("feature_code", T.StringType(), True),
    ("country_code", T.StringType(), False),
    ("cc2", T.StringType(), True),
    ("admin1_code", T.StringType(), True),
    ("admin2_code", T.StringType(), True),
    ("admin3_code", T.StringType(), True),
    ("admin4_code", T.StringType(), True),
    ("population", T.LongType(), False),
    ("elevation", T.IntegerType(), True),
    ("dem", T.IntegerType(), False),
    ("timezone", T.StringType(), True),
    ("modification_date", T.StringType(), True),
]
CITY_SCHEMA = T.StructType([T.StructField(n, t, nl) for n, t, nl in CITY_FIELDS])

# The eight gazetteer columns kept for the nearest-city search (``dem`` is the
# elevation that is used).
CITY_KEEP = ["geonameid", "name", "asciiname", "alternatenames",
             "latitude", "longitude", "population", "dem"]

# --- fixed values: reverse-geocode response ------------------------------------
ADDRESS_FIELDS = ["country_code", "country", "postcode", "state", "county",
                  "city", "suburb", "road"]
GEOCODE_RESPONSE_SCHEMA = T.StructType([
    T.StructField("error", T.StringType()),
    T.StructField("osm_id", T.LongType()),
    T.StructField("osm_type", T.StringType()),
    T.StructField("display_name", T.StringType()),
    T.StructField("address", _struct([(f, T.StringType()) for f in ADDRESS_FIELDS])),
])
