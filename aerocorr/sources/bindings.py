"""Domain relations derived from the driver's test tables.

Fixed values: the arithmetic below places sensors, sites and cities inside the
box spanned by the reference site list (lat 47.5-53.9, lon 6.0-14.6).  The
same expressions appear in the oracle SQL, so both engines compute identical
doubles.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocorr.operators.clean import unify_families

# --- fixed values: coordinate formulas ----------------------------------------
SENSOR_LAT = "47.5e0 + ({k} * 37 % 640) / 100e0"
SENSOR_LON = "6.0e0 + ({k} * 53 % 860) / 100e0"
SITE_LAT = "47.5e0 + ({k} * 71 % 640) / 100e0"
SITE_LON = "6.0e0 + ({k} * 29 % 860) / 100e0"
# event types of each device family
FAMILY_EVENTS = {1: ("click", "view"), 2: ("purchase", "signup"), 3: ("error",)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_readings(events: DataFrame) -> DataFrame:
    """Every event as a reading: ``P1 = value``, ``P2 = props.k``, the
    timestamp as text (the data model's type), the sensor's position."""
    return events.select(
        F.col("event_id").alias("reading_id"),
        F.col("event_type"),
        F.col("user_id").alias("sensor_id"),
        F.expr(SENSOR_LAT.format(k="user_id")).alias("lat"),
        F.expr(SENSOR_LON.format(k="user_id")).alias("lon"),
        F.col("ts").cast("string").alias("timestamp"),
        F.col("value").alias("P1"),
        F.get_json_object("props", "$.k").cast("double").alias("P2"),
    )


def reading_families(spark: SparkSession, sf_dir: str) -> dict[int, DataFrame]:
    """The three device families, split by event type."""
    raw = raw_readings(table(spark, sf_dir, "events"))
    return {fam: raw.where(F.col("event_type").isin(*types)).drop("event_type")
            for fam, types in FAMILY_EVENTS.items()}


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical readings of all families, ``reading_id`` carried along."""
    fams = reading_families(spark, sf_dir)
    return unify_families(fams, keep_extra=True)


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("site_id"),
        F.expr(SITE_LAT.format(k="s_suppkey")).alias("latitude"),
        F.expr(SITE_LON.format(k="s_suppkey")).alias("longitude"),
    )


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gazetteer-shaped cities: ``country`` is the nation name,
    ``population`` the account balance, ``dem`` the key modulo 700."""
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return cust.join(nation, cust["c_nationkey"] == nation["n_nationkey"]).select(
        F.col("c_custkey").alias("geonameid"),
        F.col("c_name").alias("name"),
        F.col("c_name").alias("asciiname"),
        F.col("c_mktsegment").alias("alternatenames"),
        F.expr(SITE_LAT.format(k="c_custkey")).alias("latitude"),
        F.expr(SITE_LON.format(k="c_custkey")).alias("longitude"),
        F.col("n_name").alias("country"),
        F.col("c_acctbal").alias("population"),
        F.expr("c_custkey % 700").alias("dem"),
    )


def geocoded(spark: SparkSession, sf_dir: str, segment: str = "BUILDING") -> DataFrame:
    """Geocode answers already known: customers of one market segment placed
    at sensor coordinates, answered with their nation."""
    cust = table(spark, sf_dir, "customer").where(F.col("c_mktsegment") == F.lit(segment))
    nation = table(spark, sf_dir, "nation")
    return cust.join(nation, cust["c_nationkey"] == nation["n_nationkey"]).select(
        F.expr(SENSOR_LAT.format(k="c_custkey")).alias("lat"),
        F.expr(SENSOR_LON.format(k="c_custkey")).alias("lon"),
        F.col("n_name").alias("country"),
    )
