"""Time-of-day helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def hour_of_day(df: DataFrame, column: str = "timestamp") -> Column:
    """Hour (0-23) of ``column``.

    Readings carry their time as text; a malformed string gives NULL instead
    of failing the job under ANSI mode.  Typed timestamps are used as they are.
    Strings with an explicit offset are read in the session time zone."""
    dtype = df.schema[column].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.hour(F.col(column))
    return F.hour(F.try_to_timestamp(F.col(column).cast("string")))


STORED_HOUR = "hour_of_day"


def reading_hour(df: DataFrame, column: str = "timestamp", stored: str = STORED_HOUR) -> Column:
    """The reading's hour: the integer column the landing jobs store once
    (a plain column the Parquet scan can filter on), else computed from
    ``column``."""
    if stored in df.columns:
        return F.col(stored)
    return hour_of_day(df, column)
