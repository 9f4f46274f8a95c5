"""Unifying device families, filters, null policies and de-duplication."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerocorr import schemas
from aerocorr.functions.time import hour_of_day


def canonicalize(df: DataFrame, family: int | None = None,
                 schema: T.StructType = schemas.READING_SCHEMA,
                 keep_extra: bool = False) -> DataFrame:
    """Project ``df`` onto ``schema``: cast the columns it has, NULL for the
    ones it lacks or cannot be cast (malformed text), tag the ``family``.
    Reading the file with its own schema
    and casting afterwards avoids Parquet type-mismatch failures.
    ``keep_extra`` appends the columns ``schema`` does not name."""
    have = set(df.columns)
    cols = []
    for field in schema.fields:
        if field.name == "family" and family is not None:
            cols.append(F.lit(family).cast(field.dataType).alias("family"))
        elif field.name in have:
            cols.append(F.col(field.name).try_cast(field.dataType).alias(field.name))
        else:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
    if keep_extra:
        names = set(schema.fieldNames())
        cols += [F.col(c) for c in df.columns if c not in names]
    return df.select(*cols)


def unify_families(families: Mapping[int, DataFrame], distinct: bool = False,
                   keep_extra: bool = False) -> DataFrame:
    """Bag union (duplicates kept) of the device families on the canonical
    reading schema; ``distinct=True`` gives the set union."""
    frames = [canonicalize(df, fam, keep_extra=keep_extra) for fam, df in sorted(families.items())]
    out = reduce(lambda a, b: a.unionByName(b), frames)
    return out.distinct() if distinct else out


def outlier_filter(df: DataFrame, max_value: float = schemas.MAX_VALUE,
                   columns: Iterable[str] = ("P1", "P2")) -> DataFrame:
    """Keep rows whose ``columns`` are all strictly below ``max_value``.
    NULL and NaN fail the comparison and drop; negative values pass.  Plain
    comparisons, so Parquet scans receive them as pushed filters."""
    cond = reduce(lambda a, b: a & b, [F.col(c) < F.lit(max_value) for c in columns])
    return df.where(cond)


def daytime_filter(df: DataFrame, column: str = "timestamp",
                   first_hour: int = schemas.DAY_FIRST_HOUR,
                   last_hour: int = schemas.DAY_LAST_HOUR,
                   hour_col: str | None = "hour_of_day") -> DataFrame:
    """Keep rows whose hour of day is within ``[first_hour, last_hour]``;
    unparsable or NULL times drop.  ``hour_col`` names the added column
    (``None`` to not keep it).  A table that already stores ``hour_col`` (the
    landed readings) is filtered on it directly, which the Parquet scan can
    push down."""
    if hour_col and hour_col in df.columns:
        return df.where(F.col(hour_col).between(first_hour, last_hour))
    h = hour_of_day(df, column)
    if hour_col:
        out = df.withColumn(hour_col, h)
        return out.where(F.col(hour_col).between(first_hour, last_hour))
    return df.where(h.between(first_hour, last_hour))


def avg_particulates(df: DataFrame, a: str = "P1", b: str = "P2",
                     out: str = "avg_p") -> Column:
    """``(a + b) / 2``; NULL if either side is NULL."""
    return ((F.col(a) + F.col(b)) / F.lit(2.0)).alias(out)


def with_avg_particulates(df: DataFrame, keep: Iterable[str] = ("sensor_id",),
                          out: str = "avg_p") -> DataFrame:
    return df.select(*keep, avg_particulates(df, out=out))


# --- null policies -------------------------------------------------------------

def drop_any_missing(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Drop a row when any of ``columns`` (default: all) is NULL or NaN."""
    return df.na.drop(how="any", subset=list(columns) if columns else None)


def keep_if_any_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep a row when at least one of ``columns`` is non-NULL (NaN counts as
    present)."""
    cond = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in columns])
    return df.where(cond)


def keep_if_all_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep a row when every one of ``columns`` is non-NULL (NaN counts as
    present)."""
    cond = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    return df.where(cond)


def complete_cases(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Keep rows where every one of ``columns`` is neither NULL nor NaN."""
    conds = []
    for c in columns:
        conds.append(F.col(c).isNotNull())
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            conds.append(~F.isnan(F.col(c)))
    return df.where(reduce(lambda a, b: a & b, conds))


# --- de-duplication ---------------------------------------------------------------

def distinct_positions(readings: DataFrame, key: str = "sensor_id",
                       lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Set of ``(key, lat, lon)``; partial aggregation collapses a hot sensor
    map-side before the shuffle."""
    return readings.select(key, lat, lon).distinct()


def dedupe_by_key(df: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """One row per ``key``: the first by ``order`` (ties broken by the remaining
    columns, so the survivor is deterministic).  ``row_number() == 1`` is
    planned as a WindowGroupLimit, which also trims rows before the shuffle."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in df.columns if c not in keys and c not in order]
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).asc_nulls_last() for c in order + rest])
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1).drop("_rn"))
