"""The two studies: remoteness from sites, and nearest-settlement attributes,
each correlated with the particulate readings.

Remoteness (default, ``strategy="pre-aggregate"``)::

    readings --one aggregate per (sensor, position)--> moments   [only full scan]
      moments.positions --grid join--> min_dist per sensor        [small tables]
      moments JOIN min_dist --pooled moments--> 2x2 matrix

Settlement (and remoteness with ``strategy="join"``)::

    readings --distinct--> positions --grid join--> per-sensor attributes
                                                    | materialized (written, re-read)
    readings --filters (pushed to the scan)--> avg_p --broadcast join--+
                                               --> one corr aggregate --> matrix

Per-sensor tables are one row per sensor; they are written once (cutting the
lineage) and broadcast after a bounded row-count probe, so the readings are
never shuffled.  Beyond the broadcast bound the join falls back to a shuffle
join with AQE skew splitting.  The settlement study correlates distinct
``(avg_p, population, elevation)`` triples: readings of sensors without a city
in reach leave at the broadcast join, the others become distinct ``(avg_p,
place)`` pairs, and the cities tied at a place join only where all triples of
an ``avg_p`` are in one task (:mod:`aerocorr.operators.triples`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocorr import schemas
from aerocorr.config import DEFAULT_BROADCAST_ROWS
from aerocorr.operators.clean import (
    avg_particulates, daytime_filter, dedupe_by_key, distinct_positions, drop_any_missing,
    keep_if_all_present, keep_if_any_present, outlier_filter,
)
from aerocorr.operators.geocode import country_filter, enrich_country
from aerocorr.operators.joins import join_attributes
from aerocorr.operators.nearest import min_distance, nearest_within, positions_with_min_distance
from aerocorr.functions.time import reading_hour
from aerocorr.operators.stats import correlation_matrix, grouped_moments, pooled_correlation_matrix
from aerocorr.operators.triples import attached_rows
from aerocorr.sources.sinks import materialize, write_sample_csv
from aerocorr.sources.versions import open_version, refresh_changed

PLACE = ["latitude", "longitude"]


def sensor_positions(readings: DataFrame, geocode: DataFrame | None = None,
                     country: str = schemas.COUNTRY_NAME,
                     failed: str = schemas.FAILED_LOOKUP) -> DataFrame:
    """Distinct ``(sensor_id, lat, lon)``; with a geocode table, only positions
    in ``country`` or whose lookup is missing (fail-open)."""
    pos = distinct_positions(readings)
    if geocode is not None:
        pos = country_filter(enrich_country(pos, geocode, on_missing="keep", failed=failed),
                             country, failed).select("sensor_id", "lat", "lon")
    return pos


def remoteness_table(readings: DataFrame, sites: DataFrame, *, geocode: DataFrame | None = None,
                     country: str = schemas.COUNTRY_NAME, cell: float | None = None,
                     persist: bool = True, path: str | None = None,
                     refresh: bool | str = True) -> DataFrame:
    """Positions with their sensor-wide distance to the nearest site
    ``(sensor_id, lat, lon, min_dist)``, written and re-read when ``persist``.
    With ``path`` the table is kept there in versions; in later runs
    ``refresh=False`` reloads it without building anything and
    ``refresh="changed"`` computes only the sensors whose positions changed
    (:func:`aerocorr.sources.versions.refresh_changed`)."""
    spark = readings.sparkSession
    near = lambda pos: positions_with_min_distance(
        pos, sites.select("latitude", "longitude"), cell=cell)
    if path and refresh is False and (stored := open_version(spark, path)) is not None:
        return stored
    pos = sensor_positions(readings, geocode, country)
    if not (persist or path):
        return near(pos)
    pos = materialize(spark, pos, name="positions")
    if path:
        return refresh_changed(spark, path, pos, sites.select("latitude", "longitude"), near,
                               "sensor_id", f"nearest-site cell={cell}", refresh)
    return materialize(spark, near(pos), name="nearest-site")


def remoteness_readings(readings: DataFrame, near: DataFrame, *,
                        max_value: float = schemas.MAX_VALUE,
                        first_hour: int = schemas.DAY_FIRST_HOUR,
                        last_hour: int = schemas.DAY_LAST_HOUR,
                        keep: tuple[str, ...] = (),
                        max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                        salt_buckets: int = 0) -> DataFrame:
    """Daytime, in-range readings ``(sensor_id, avg_p, min_dist)``: one sensor
    position per sensor (NULL/NaN rows dropped, smallest ``(lat, lon)`` kept),
    rows kept when either value is present."""
    attrs = dedupe_by_key(drop_any_missing(near), "sensor_id", ["lat", "lon"]) \
        .select("sensor_id", "min_dist")
    day = daytime_filter(outlier_filter(readings, max_value), first_hour=first_hour,
                         last_hour=last_hour, hour_col=None)
    avg = day.select("sensor_id", *keep, avg_particulates(day))
    joined = join_attributes(avg, attrs, "sensor_id", max_broadcast_rows,
                             salt_buckets=salt_buckets)
    return keep_if_any_present(joined, ["min_dist", "avg_p"])


def remoteness_study(readings: DataFrame, sites: DataFrame, *, geocode: DataFrame | None = None,
                     country: str = schemas.COUNTRY_NAME, max_value: float = schemas.MAX_VALUE,
                     first_hour: int = schemas.DAY_FIRST_HOUR,
                     last_hour: int = schemas.DAY_LAST_HOUR,
                     cell: float | None = None, digits: int | None = None,
                     persist: bool = True, strategy: str = "pre-aggregate",
                     path: str | None = None, refresh: bool | str = True) -> DataFrame:
    """2x2 Pearson matrix of ``(avg_p, min_dist)`` over every qualifying
    reading (each reading weighs once).

    ``strategy="pre-aggregate"`` (default) scans the readings once: a single
    aggregation per ``(sensor_id, lat, lon)`` yields both the position set and
    the moments of the qualifying ``avg_p`` values, and the correlation is
    pooled from that small table (``min_dist`` is constant per sensor).
    ``strategy="join"`` builds the reading-level rows (what the CSV sample
    exports) and correlates them directly; it scans the readings twice and can
    keep and reload its nearest-site table (``path``, ``refresh``)."""
    if path and strategy != "join":
        raise ValueError("only the join strategy keeps a nearest-site table")
    if strategy == "join":
        near = remoteness_table(readings, sites, geocode=geocode, country=country, cell=cell,
                                persist=persist, path=path, refresh=refresh)
        rows = remoteness_readings(readings, near, max_value=max_value, first_hour=first_hour,
                                   last_hour=last_hour)
        return correlation_matrix(rows, ["avg_p", "min_dist"], digits=digits)
    if strategy != "pre-aggregate":
        raise ValueError(f"unknown strategy {strategy!r}")
    spark = readings.sparkSession
    qualifies = ((F.col("P1") < F.lit(max_value)) & (F.col("P2") < F.lit(max_value))
                 & reading_hour(readings).between(first_hour, last_hour))
    per_pos = grouped_moments(readings, ["sensor_id", "lat", "lon"],
                              avg_particulates(readings), qualifies)
    if persist:
        per_pos = materialize(spark, per_pos, name="position-moments")
    return remoteness_from_moments(per_pos, sites, geocode=geocode, country=country, cell=cell,
                                   digits=digits, persist=persist)


def remoteness_from_moments(moments: DataFrame, sites: DataFrame, *,
                            geocode: DataFrame | None = None,
                            country: str = schemas.COUNTRY_NAME, cell: float | None = None,
                            digits: int | None = None, persist: bool = True) -> DataFrame:
    """The remoteness matrix from a per-position moments table
    ``(sensor_id, lat, lon, _n, _mean, _var)`` of the qualifying ``avg_p``
    values - the table the readings pass writes, or the one the streaming job
    (:func:`aerocorr.streaming.start_position_moments`) keeps current."""
    pos = moments.select("sensor_id", "lat", "lon")
    if geocode is not None:
        pos = country_filter(enrich_country(pos, geocode, on_missing="keep"), country) \
            .select("sensor_id", "lat", "lon")
    # the sensor-wide minimum is what every position of the sensor carries, so
    # the join back to positions + one-position-per-sensor step reduce to it
    # (the search checkpoints its first pass, which usually is the whole
    # answer, so the per-sensor table needs no extra write here)
    attrs = min_distance(pos, sites.select("latitude", "longitude"), cell=cell)
    groups = moments.select("sensor_id", "_n", "_mean", "_var").join(attrs, "sensor_id")
    return pooled_correlation_matrix(groups, "avg_p", "min_dist", digits=digits)


def settlement_table(positions: DataFrame, cities: DataFrame, *,
                     radius: float = schemas.CITY_RADIUS, persist: bool = True,
                     distinct_cities: bool = True, path: str | None = None,
                     refresh: bool | str = True) -> DataFrame:
    """Per sensor, the nearest city (ties kept) when it lies strictly within
    ``radius``: ``(sensor_id, lat, lon, geonameid, name, asciiname,
    alternatenames, latitude, longitude, population, elevation, min_dist)``.
    ``path`` and ``refresh`` as in :func:`remoteness_table`."""
    attrs = cities.select("geonameid", "name", "asciiname", "alternatenames", "latitude",
                          "longitude", "population", F.col("dem").alias("elevation"))
    here = positions.select("sensor_id", "lat", "lon")
    near = lambda pos: nearest_within(
        pos, attrs, radius, dist_col="min_dist", distinct_sites=distinct_cities)
    if path:
        return refresh_changed(positions.sparkSession, path, here, attrs, near, "sensor_id",
                               f"nearest-city {radius} {distinct_cities}", refresh)
    return materialize(positions.sparkSession, near(here), name="nearest-city") if persist else near(here)


def settlement_places(positions: DataFrame, cities: DataFrame, *, radius: float = schemas.CITY_RADIUS,
                      persist: bool = True) -> tuple[DataFrame, DataFrame]:
    """:func:`settlement_table` in two tables that do not grow with the cities
    tied at a place: ``(sensor_id, latitude, longitude)``, the places of each
    sensor's nearest cities, and ``(latitude, longitude, population,
    elevation)``, distinct, of these places."""
    spark = positions.sparkSession
    save = lambda df, name: materialize(spark, df, name=name) if persist else df
    places = save(cities.select(*PLACE).distinct(), "places")
    found = nearest_within(positions.select("sensor_id", "lat", "lon"), places, radius,
                           dist_col="min_dist", distinct_sites=False)
    near = save(found.select("sensor_id", *PLACE).distinct(), "nearest-place")
    attrs = cities.select(*PLACE, "population", F.col("dem").alias("elevation")).distinct()
    return near, save(attrs.join(near.select(*PLACE).distinct(), PLACE, "left_semi"), "place-cities")


def settlement_rows(readings: DataFrame, cities: DataFrame, *,
                    positions: DataFrame | None = None,
                    radius: float = schemas.CITY_RADIUS, max_value: float = schemas.MAX_VALUE,
                    distinct_rows: bool = True, persist: bool = True, strategy: str = "join",
                    one_row_per_sensor: bool | None = None,
                    path: str | None = None, refresh: bool | str = True,
                    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                    salt_buckets: int = 0) -> DataFrame:
    """The rows ``(avg_p, population, elevation)`` of the settlement study.  With
    ``distinct_rows`` (the study's definition) each distinct triple weighs
    once; otherwise each reading does.  ``one_row_per_sensor`` keeps, of tied
    cities and of several positions, the nearest city with the smallest
    ``geonameid``; by default where readings weigh, as a reading would
    otherwise count once per tied city.

    ``strategy="join"`` finds the positions in a pruned scan, then scans the
    readings with pushed filters and broadcasts the matched sensors.
    ``strategy="pre-aggregate"`` scans once, with a distinct over ``(sensor_id,
    lat, lon, avg_p)`` that is shuffled and written: for quantized values only,
    and only with distinct rows and positions from the readings (an error
    otherwise).  ``path`` and ``refresh`` keep and reload the nearest-city table."""
    if strategy == "pre-aggregate" and not (distinct_rows and positions is None):
        raise ValueError("pre-aggregate needs distinct rows and positions from the readings")
    if one_row_per_sensor is None:
        one_row_per_sensor = not distinct_rows
    ok_cond = (F.col("P1") < F.lit(max_value)) & (F.col("P2") < F.lit(max_value))
    if strategy == "pre-aggregate":
        vals = readings.select("sensor_id", "lat", "lon",
                               F.when(ok_cond, avg_particulates(readings)).alias("avg_p")).distinct()
        pos = vals.select("sensor_id", "lat", "lon").distinct()
        if persist:
            vals = materialize(readings.sparkSession, vals, name="position-values")
            # the radius search reads its positions more than once
            pos = materialize(readings.sparkSession,
                              vals.select("sensor_id", "lat", "lon").distinct(), name="positions")
        avg = vals.where(F.col("avg_p").isNotNull()).select("sensor_id", "avg_p")
    elif strategy == "join":
        pos = positions if positions is not None else distinct_positions(readings)
        if persist and positions is None:  # the search reads its positions more than once
            pos = materialize(readings.sparkSession, pos, name="positions")
        ok = readings.where(ok_cond)
        avg = ok.select("sensor_id", avg_particulates(ok))
    else:
        raise ValueError(f"unknown strategy {strategy!r}")
    if distinct_rows and not one_row_per_sensor:
        if path:  # a kept table names each sensor's cities itself
            kept = settlement_table(pos, cities, radius=radius, persist=persist, distinct_cities=False,
                                    path=path, refresh=refresh)
            near = kept.select("sensor_id", *PLACE).distinct()
            attrs = kept.select(*PLACE, "population", "elevation").distinct()
        else:
            near, attrs = settlement_places(pos, cities, radius=radius, persist=persist)
        attrs = keep_if_all_present(attrs, ["population", "elevation"])
        values = join_attributes(avg, near, "sensor_id", max_broadcast_rows, salt_buckets=salt_buckets)
        values = keep_if_all_present(values, ["avg_p"]).select("avg_p", *PLACE).distinct()
        if persist:
            values = materialize(readings.sparkSession, values, name="place-values")
        return attached_rows(values, attrs, PLACE)
    if one_row_per_sensor and not path:  # a place's own first city is all that can count
        first = F.min(F.struct("geonameid", "population", F.col("dem").alias("elevation"))).alias("c")
        near = nearest_within(pos.select("sensor_id", "lat", "lon"),
                              cities.groupBy(*PLACE).agg(first).select(*PLACE, "c.*"),
                              radius, dist_col="min_dist", distinct_sites=False)
        if persist:
            near = materialize(readings.sparkSession, near, name="nearest-city")
    else:
        near = settlement_table(pos, cities, radius=radius, persist=persist,
                                distinct_cities=not distinct_rows, path=path, refresh=refresh)
    attrs = near.select("sensor_id", "population", "elevation")
    if one_row_per_sensor:
        first = F.min(F.struct("min_dist", "geonameid", "population", "elevation")).alias("c")
        attrs = near.groupBy("sensor_id").agg(first).select("sensor_id", "c.population", "c.elevation")
    joined = keep_if_all_present(join_attributes(avg, attrs, "sensor_id", max_broadcast_rows,
                                                 salt_buckets=salt_buckets),
                                 ["population", "elevation", "avg_p"])
    rows = joined.select("avg_p", "population", "elevation")
    return rows.distinct() if distinct_rows else rows


def settlement_study(readings: DataFrame, cities: DataFrame, *, digits: int | None = None,
                     sample_path: str | None = None, sample_rows: int = schemas.SAMPLE_ROWS,
                     **options) -> DataFrame:
    """3x3 Pearson matrix of the study's rows; ``options`` as in
    :func:`settlement_rows`.  ``sample_path`` also exports at most
    ``sample_rows`` of them for plotting, as one ``;`` CSV file."""
    columns = ["avg_p", "population", "elevation"]
    rows = settlement_rows(readings, cities, **options)
    if sample_path:
        if not options.get("distinct_rows", True):  # distinct rows arise anew from their written pairs
            rows = materialize(readings.sparkSession, rows, name="settlement-rows")
        write_sample_csv(rows, sample_path, keys=columns, n=sample_rows)
    return correlation_matrix(rows, columns, digits=digits)
