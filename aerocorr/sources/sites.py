"""Site list: ``;``-separated text with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from aerocorr.schemas import SITE_SCHEMA


def read_sites(spark: SparkSession, path: str, schema: T.StructType = SITE_SCHEMA,
               sep: str = ";") -> DataFrame:
    """Permissive read with a declared schema: a bad number reads as NULL
    (NULL coordinates never match in the nearest-site search)."""
    return (spark.read.option("header", True).option("sep", sep)
            .option("mode", "PERMISSIVE").schema(schema).csv(path))
