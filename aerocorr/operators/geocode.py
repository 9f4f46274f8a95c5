"""Country enrichment from a geocode table (the table is the cache).

Positions are matched to already-geocoded coordinates with a join; nothing is
fetched inside a task.  Coordinates with no answer yet form the worklist."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocorr import schemas
from aerocorr.functions.address import parse_address


def parse_responses(df: DataFrame, body: str = "body") -> DataFrame:
    """Add the parsed address columns (see :func:`parse_address`) to ``df``."""
    return df.withColumns(parse_address(body))


def geocode_table(df: DataFrame, lat: str = "lat", lon: str = "lon",
                  country: str = "country") -> DataFrame:
    """One answer per coordinate; conflicting answers resolve to the smallest
    value so the lookup is deterministic."""
    return df.groupBy(lat, lon).agg(F.min(country).alias(country))


def enrich_country(positions: DataFrame, geocode: DataFrame, *, on_missing: str = "keep",
                   lat: str = "lat", lon: str = "lon", country: str = "country",
                   failed: str = schemas.FAILED_LOOKUP, status: str | None = None) -> DataFrame:
    """Add ``country`` to every position.

    ``on_missing`` is for coordinates absent from the table: ``"keep"`` marks
    them with ``failed`` (fail-open), ``"drop"`` removes them, ``"error"`` fails
    the job.  A coordinate answered without a country, and a position without
    coordinates, have a NULL country, which :func:`country_filter` drops.
    ``status`` names an extra column: ``answered``, ``failed`` (the answer is
    ``failed`` or NULL) or ``absent``."""
    if on_missing not in ("keep", "drop", "error"):
        raise ValueError(f"unknown on_missing policy {on_missing!r}")
    table = (geocode_table(geocode.select(lat, lon, country), lat, lon, country)
             .where(F.col(lat).isNotNull() & F.col(lon).isNotNull()).withColumn("_known", F.lit(True)))
    out = positions.join(table, [lat, lon], "inner" if on_missing == "drop" else "left")
    absent = F.col("_known").isNull() & F.col(lat).isNotNull() & F.col(lon).isNotNull()
    answer = F.col(country)
    if status:
        out = out.withColumn(status, F.when(F.col("_known").isNull(), "absent")
                             .when(answer.isNull() | (answer == failed), "failed").otherwise("answered"))
    if on_missing == "keep":
        out = out.withColumn(country, F.when(absent, F.lit(failed)).otherwise(answer))
    elif on_missing == "error":
        out = out.withColumn(country, F.when(absent, F.raise_error(
            F.lit("coordinate missing from geocode table"))).otherwise(answer))
    return out.drop("_known")


def country_filter(df: DataFrame, country: str = schemas.COUNTRY_NAME,
                   failed: str | None = schemas.FAILED_LOOKUP, column: str = "country") -> DataFrame:
    """Keep rows in ``country``, plus rows whose lookup failed (``failed``);
    NULL drops."""
    cond = F.col(column) == F.lit(country)
    if failed is not None:
        cond = cond | (F.col(column) == F.lit(failed))
    return df.where(cond)


def geocode_worklist(positions: DataFrame, geocode: DataFrame, lat: str = "lat",
                     lon: str = "lon") -> DataFrame:
    """Distinct coordinates that still need a lookup."""
    return (positions.select(lat, lon).na.drop().distinct()
            .join(geocode.select(lat, lon), [lat, lon], "left_anti"))
