"""Gazetteer reader: tab separated, no header, 19 declared columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocorr.schemas import CITY_KEEP, CITY_SCHEMA


def read_cities(spark: SparkSession, path: str, country_code: str | None = None) -> DataFrame:
    """The gazetteer is unquoted text: ``quote`` is disabled so a name that
    starts with ``"`` cannot swallow the following fields.  ``country_code``
    keeps one country (pushed into the scan as a filter)."""
    df = (spark.read.option("header", False).option("sep", "\t").option("quote", "")
          .option("mode", "PERMISSIVE").schema(CITY_SCHEMA).csv(path))
    if country_code is not None:
        df = df.where(F.col("country_code") == F.lit(country_code))
    return df


def city_attributes(cities: DataFrame) -> DataFrame:
    """The columns the nearest-city search keeps, ``dem`` renamed to
    ``elevation``."""
    return cities.select(*CITY_KEEP).withColumnRenamed("dem", "elevation")
