"""Named queries over the driver's test tables, each with its DuckDB oracle.

Every query reads whole tables (events, supplier, customer, nation, lineitem,
pages) through :mod:`aerocorr.sources.bindings`; outputs alias every computed
column so names and types line up with the SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocorr import schemas
from aerocorr.functions.keys import basename, coord_key, split_key
from aerocorr.operators import clean, geocode, nearest, sampling, stats
from aerocorr.plans import studies
from aerocorr.sources import bindings as B
from aerocorr.sources.sinks import materialize

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

DIGITS = 6
SETTLEMENT_RADIUS = 0.5     # wide enough for the test bindings to match cities
SAMPLE_N = schemas.SAMPLE_ROWS
GEO_COUNTRY = "NATION_3"


def query(name: str, sql: str | None = None):
    def wrap(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return wrap


# --- oracle building blocks -----------------------------------------------------

READINGS_CTE = """
r AS (
  SELECT event_id AS reading_id, user_id AS sensor_id,
         47.5e0 + (user_id * 37 % 640) / 100e0 AS lat,
         6.0e0 + (user_id * 53 % 860) / 100e0 AS lon,
         ts, value AS P1, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS P2,
         CASE WHEN event_type IN ('click', 'view') THEN 1
              WHEN event_type IN ('purchase', 'signup') THEN 2
              WHEN event_type = 'error' THEN 3 END AS family
  FROM events
  WHERE event_type IN ('click', 'view', 'purchase', 'signup', 'error'))"""

POS_CTE = "pos AS (SELECT DISTINCT sensor_id, lat, lon FROM r)"

SITE_CTE = """
site AS (
  SELECT s_suppkey AS site_id,
         47.5e0 + (s_suppkey * 71 % 640) / 100e0 AS latitude,
         6.0e0 + (s_suppkey * 29 % 860) / 100e0 AS longitude
  FROM supplier)"""

CITY_CTE = """
city AS (
  SELECT c_custkey AS geonameid, c_name AS name, c_name AS asciiname,
         c_mktsegment AS alternatenames,
         47.5e0 + (c_custkey * 71 % 640) / 100e0 AS latitude,
         6.0e0 + (c_custkey * 29 % 860) / 100e0 AS longitude,
         n_name AS country, c_acctbal AS population, c_custkey % 700 AS elevation
  FROM customer JOIN nation ON c_nationkey = n_nationkey)"""

DIST = "sqrt((lat - latitude) * (lat - latitude) + (lon - longitude) * (lon - longitude))"

MIN_DIST_CTE = f"md AS (SELECT sensor_id, min({DIST}) AS min_dist FROM pos, site GROUP BY sensor_id)"


def corr_sql(src: str, cols: list[str], digits: int = DIGITS, as_cte: str | None = None) -> str:
    """Tail of a WITH query: long-form matrix over complete cases of ``src``
    (or, with ``as_cte``, the CTEs defining it under that name)."""
    complete = " AND ".join(f"{c} IS NOT NULL AND NOT isnan({c})" for c in cols)
    aggs = ["count(*) AS n"]
    for i, c in enumerate(cols):
        aggs.append(f"var_pop({c}) AS v{i}, stddev_pop({c}) AS s{i}")
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            aggs.append(f"covar_pop({cols[i]}, {cols[j]}) AS c{i}_{j}")
    parts = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                r = f"CASE WHEN v{i} > 0 THEN 1.0 END"
            else:
                lo, hi = min(i, j), max(i, j)
                r = f"round(c{lo}_{hi} / nullif(s{i} * s{j}, 0), {digits})"
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, CAST({r} AS DOUBLE) AS r, n FROM mom")
    head = (f"cc AS (SELECT * FROM {src} WHERE {complete}),\n"
            f"mom AS (SELECT {', '.join(aggs)} FROM cc)")
    if as_cte:
        return head + f",\n{as_cte} AS (" + "\nUNION ALL ".join(parts) + ")"
    return head + "\n" + "\nUNION ALL ".join(parts)


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


# --- helpers ------------------------------------------------------------------------

def _readings(spark, sf):
    return B.readings(spark, sf)


def _positions(spark, sf):
    return clean.distinct_positions(_readings(spark, sf))


def _stored_positions(spark, sf):
    """Positions written once: the unbounded search reads them in both of its
    phases, so they are materialized as the operator's documentation asks."""
    return materialize(spark, _positions(spark, sf), name="positions")


def _city_attrs(spark, sf):
    return B.cities(spark, sf).select("geonameid", "name", "asciiname", "alternatenames",
                                      "latitude", "longitude", "population",
                                      F.col("dem").alias("elevation"))


# --- studies ---------------------------------------------------------------------

REMOTENESS_ROWS_SQL = [
    READINGS_CTE, POS_CTE, SITE_CTE, MIN_DIST_CTE,
    """near AS (SELECT p.sensor_id, p.lat, p.lon, m.min_dist FROM pos p JOIN md m ON p.sensor_id = m.sensor_id)""",
    """clean AS (SELECT * FROM near WHERE sensor_id IS NOT NULL AND lat IS NOT NULL AND NOT isnan(lat)
              AND lon IS NOT NULL AND NOT isnan(lon) AND min_dist IS NOT NULL AND NOT isnan(min_dist))""",
    """attrs AS (SELECT sensor_id, min_dist FROM (
       SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY lat, lon, min_dist) AS rn FROM clean)
     WHERE rn = 1)""",
    """rd AS (SELECT reading_id, sensor_id, (P1 + P2) / 2 AS avg_p FROM r
           WHERE P1 < 5000 AND P2 < 5000 AND hour(ts) BETWEEN 6 AND 17)""",
    """j AS (SELECT reading_id, sensor_id, avg_p, min_dist FROM rd JOIN attrs USING (sensor_id)
          WHERE min_dist IS NOT NULL OR avg_p IS NOT NULL)""",
]


@query("remoteness_corr", with_(*REMOTENESS_ROWS_SQL, corr_sql("j", ["avg_p", "min_dist"])))
def remoteness_corr(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship: Pearson matrix of particulates vs. distance to the nearest site."""
    return studies.remoteness_study(_readings(spark, sf), B.sites(spark, sf), digits=DIGITS)


@query("remoteness_corr_rows", with_(*REMOTENESS_ROWS_SQL, corr_sql("j", ["avg_p", "min_dist"])))
def remoteness_corr_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship through reading-level rows (broadcast join + one corr
    aggregate) instead of pooled per-position moments."""
    return studies.remoteness_study(_readings(spark, sf), B.sites(spark, sf), digits=DIGITS,
                                    strategy="join")


def wide_sql(src: str, cols: list[str]) -> str:
    """Tail of a WITH query: the long-form matrix of ``src`` pivoted wide."""
    picks = ", ".join(f"max(CASE WHEN col_b = '{c}' THEN r END) AS {c}" for c in cols)
    return (corr_sql(src, cols, as_cte="lng")
            + f"\nSELECT col_a, {picks} FROM lng GROUP BY col_a")


REMOTENESS_COUNTRY_SQL = [
    READINGS_CTE, POS_CTE, SITE_CTE, "GEOCTE",
    f"""posg AS (SELECT p.sensor_id, p.lat, p.lon FROM pos p LEFT JOIN geo g USING (lat, lon)
            WHERE coalesce(g.country, 'error') IN ('{GEO_COUNTRY}', 'error'))""",
    f"md AS (SELECT sensor_id, min({DIST}) AS min_dist FROM posg, site GROUP BY sensor_id)",
    """near AS (SELECT p.sensor_id, p.lat, p.lon, m.min_dist FROM posg p JOIN md m ON p.sensor_id = m.sensor_id)""",
] + REMOTENESS_ROWS_SQL[5:]


@query("remoteness_corr_country", None)
def remoteness_corr_country(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship restricted to sensors geocoded in one country, keeping
    sensors whose coordinates have no geocode answer yet (fail-open)."""
    return studies.remoteness_study(_readings(spark, sf), B.sites(spark, sf),
                                    geocode=B.geocoded(spark, sf), country=GEO_COUNTRY,
                                    digits=DIGITS)


@query("remoteness_corr_wide", with_(*REMOTENESS_ROWS_SQL, wide_sql("j", ["avg_p", "min_dist"])))
def remoteness_corr_wide(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship matrix laid out as the printed 2x2 matrix."""
    m = studies.remoteness_study(_readings(spark, sf), B.sites(spark, sf), digits=DIGITS)
    return stats.matrix_wide(m, ["avg_p", "min_dist"])


SETTLEMENT_ROWS_SQL = [
    READINGS_CTE, POS_CTE, CITY_CTE,
    f"""d AS (SELECT sensor_id, geonameid, population, elevation, {DIST} AS dist FROM pos, city)""",
    f"""nc AS (SELECT * FROM (SELECT *, rank() OVER (PARTITION BY sensor_id ORDER BY dist) AS rk FROM d)
           WHERE rk = 1 AND dist < {SETTLEMENT_RADIUS})""",
    """rd AS (SELECT sensor_id, (P1 + P2) / 2 AS avg_p FROM r WHERE P1 < 5000 AND P2 < 5000)""",
    """j AS (SELECT DISTINCT avg_p, population, elevation FROM rd JOIN nc USING (sensor_id)
          WHERE population IS NOT NULL AND elevation IS NOT NULL AND avg_p IS NOT NULL)""",
]


@query("settlement_corr", with_(*SETTLEMENT_ROWS_SQL,
                                corr_sql("j", ["avg_p", "population", "elevation"])))
def settlement_corr(spark: SparkSession, sf: str) -> DataFrame:
    """Pearson matrix of particulates vs. population and elevation of the
    nearest city within the radius (distinct triples)."""
    return studies.settlement_study(_readings(spark, sf), B.cities(spark, sf),
                                    radius=SETTLEMENT_RADIUS, digits=DIGITS)


@query("settlement_corr_rows", with_(*SETTLEMENT_ROWS_SQL,
                                     corr_sql("j", ["avg_p", "population", "elevation"])))
def settlement_corr_rows(spark: SparkSession, sf: str) -> DataFrame:
    """The settlement matrix from distinct values per sensor (one scan)."""
    return studies.settlement_study(_readings(spark, sf), B.cities(spark, sf),
                                    radius=SETTLEMENT_RADIUS, digits=DIGITS, strategy="pre-aggregate")


@query("settlement_corr_weighted", with_(*SETTLEMENT_ROWS_SQL[:6], """
 one AS (SELECT sensor_id, arg_min(population, geonameid) AS population,
                arg_min(elevation, geonameid) AS elevation FROM nc GROUP BY sensor_id)""", """
 j AS (SELECT avg_p, population, elevation FROM rd JOIN one USING (sensor_id)
       WHERE population IS NOT NULL AND elevation IS NOT NULL AND avg_p IS NOT NULL)""",
                                         corr_sql("j", ["avg_p", "population", "elevation"])))
def settlement_corr_weighted(spark: SparkSession, sf: str) -> DataFrame:
    """Every reading weighs once, also of sensors with tied cities."""
    return studies.settlement_study(_readings(spark, sf), B.cities(spark, sf), distinct_rows=False,
                                    radius=SETTLEMENT_RADIUS, digits=DIGITS)


@query("nearest_city_table", with_(READINGS_CTE, POS_CTE, CITY_CTE,
                                   f"d AS (SELECT *, {DIST} AS min_dist FROM pos, city)")
       + f""" SELECT sensor_id, lat, lon, geonameid, name, asciiname, alternatenames, latitude, longitude,
                     population, elevation, min_dist FROM (
                SELECT *, rank() OVER (PARTITION BY sensor_id ORDER BY min_dist) AS rk FROM d)
              WHERE rk = 1 AND min_dist < {SETTLEMENT_RADIUS}""")
def nearest_city_table(spark: SparkSession, sf: str) -> DataFrame:
    """The second study's per-sensor table with every city column."""
    return studies.settlement_table(_stored_positions(spark, sf), B.cities(spark, sf),
                                    radius=SETTLEMENT_RADIUS)


@query("settlement_corr_country", None)
def settlement_corr_country(spark: SparkSession, sf: str) -> DataFrame:
    """The settlement matrix over the sensors of the country-filtered
    nearest-site table (positions with a site distance), as the second study
    takes them from the first."""
    rd = _readings(spark, sf)
    sensors = studies.remoteness_table(rd, B.sites(spark, sf), geocode=B.geocoded(spark, sf),
                                       country=GEO_COUNTRY)
    return studies.settlement_study(rd, B.cities(spark, sf), positions=sensors,
                                    radius=SETTLEMENT_RADIUS, digits=DIGITS)


# --- nearest sites ----------------------------------------------------------------

@query("min_distance_to_site", with_(READINGS_CTE, POS_CTE, SITE_CTE, MIN_DIST_CTE)
       + " SELECT sensor_id, min_dist FROM md")
def min_distance_to_site(spark, sf):
    return nearest.min_distance(_stored_positions(spark, sf), B.sites(spark, sf))


@query("positions_with_min_distance", with_(READINGS_CTE, POS_CTE, SITE_CTE, MIN_DIST_CTE)
       + " SELECT p.sensor_id, p.lat, p.lon, m.min_dist FROM pos p JOIN md m ON p.sensor_id = m.sensor_id")
def positions_with_min_distance(spark, sf):
    return nearest.positions_with_min_distance(_stored_positions(spark, sf), B.sites(spark, sf))


@query("nearest_city_ties", with_(READINGS_CTE, POS_CTE, CITY_CTE,
                                  f"d AS (SELECT sensor_id, geonameid, {DIST} AS dist FROM pos, city)")
       + """ SELECT sensor_id, geonameid, dist FROM (
               SELECT *, rank() OVER (PARTITION BY sensor_id ORDER BY dist) AS rk FROM d)
             WHERE rk = 1""")
def nearest_city_ties(spark, sf):
    """Every nearest city per sensor, unbounded, ties kept."""
    # gazetteer rows are keyed by geonameid: no identical rows to collapse
    near = nearest.nearest_sites(_stored_positions(spark, sf), _city_attrs(spark, sf),
                                 distinct_sites=False)
    return near.select("sensor_id", "geonameid", "dist")


@query("nearest_city_within", with_(READINGS_CTE, POS_CTE, CITY_CTE,
                                    f"d AS (SELECT sensor_id, geonameid, {DIST} AS dist FROM pos, city)")
       + f""" SELECT sensor_id, geonameid, dist FROM (
                SELECT *, rank() OVER (PARTITION BY sensor_id ORDER BY dist) AS rk FROM d)
              WHERE rk = 1 AND dist < {schemas.CITY_RADIUS}""")
def nearest_city_within(spark, sf):
    near = nearest.nearest_within(_stored_positions(spark, sf), _city_attrs(spark, sf), schemas.CITY_RADIUS)
    return near.select("sensor_id", "geonameid", "dist")


@query("nearest_site_radius", with_(READINGS_CTE, POS_CTE, SITE_CTE,
                                    f"d AS (SELECT sensor_id, site_id, {DIST} AS dist FROM pos, site)")
       + f""" SELECT sensor_id, site_id, dist FROM (
                SELECT *, rank() OVER (PARTITION BY sensor_id ORDER BY dist) AS rk FROM d)
              WHERE rk = 1 AND dist < {SETTLEMENT_RADIUS}""")
def nearest_site_radius(spark, sf):
    near = nearest.nearest_within(_stored_positions(spark, sf), B.sites(spark, sf), SETTLEMENT_RADIUS)
    return near.select("sensor_id", "site_id", "dist")


# --- unions, filters, projections -------------------------------------------------

@query("union_families", with_(READINGS_CTE)
       + " SELECT reading_id, sensor_id, family, lat, lon, P1, P2, CAST(NULL AS DOUBLE) AS P0 FROM r")
def union_families(spark, sf):
    return _readings(spark, sf).select("reading_id", "sensor_id", "family", "lat", "lon",
                                       "P1", "P2", "P0")


@query("distinct_positions", with_(READINGS_CTE) + " SELECT DISTINCT sensor_id, lat, lon FROM r")
def distinct_positions(spark, sf):
    return clean.unify_families(B.reading_families(spark, sf), distinct=True) \
        .select("sensor_id", "lat", "lon").distinct()


@query("daytime_readings", with_(READINGS_CTE)
       + """ SELECT reading_id, sensor_id, CAST(hour(ts) AS INTEGER) AS hour_of_day FROM r
             WHERE hour(ts) BETWEEN 6 AND 17""")
def daytime_readings(spark, sf):
    day = clean.daytime_filter(_readings(spark, sf))
    return day.select("reading_id", "sensor_id", "hour_of_day")


@query("outlier_filter", """
SELECT l_orderkey, l_linenumber, l_quantity AS P1, l_extendedprice AS P2 FROM lineitem
WHERE l_quantity < 5000 AND l_extendedprice < 5000""")
def outlier_filter(spark, sf):
    li = B.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_quantity").alias("P1"),
        F.col("l_extendedprice").alias("P2"))
    return clean.outlier_filter(li)


@query("avg_particulates", with_(READINGS_CTE)
       + " SELECT reading_id, sensor_id, (P1 + P2) / 2 AS avg_p FROM r")
def avg_particulates(spark, sf):
    rd = _readings(spark, sf)
    return rd.select("reading_id", "sensor_id", clean.avg_particulates(rd))


NULLS_CTE = """
nv AS (
  SELECT event_id AS reading_id,
         nullif(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS x,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS DOUBLE) = 1 THEN CAST('NaN' AS DOUBLE)
              WHEN CAST(json_extract_string(props, '$.k') AS DOUBLE) = 2 THEN NULL
              ELSE value END AS y,
         CAST(hour(ts) AS DOUBLE) AS h
  FROM events)"""


def _null_values(spark, sf):
    ev = B.table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    return ev.select(
        F.col("event_id").alias("reading_id"),
        F.when(k == 0, F.lit(None).cast("double")).otherwise(k).alias("x"),
        F.when(k == 1, F.lit(float("nan"))).when(k == 2, F.lit(None).cast("double"))
         .otherwise(F.col("value")).alias("y"),
        F.hour("ts").cast("double").alias("h"),
    )


@query("null_policy_any", with_(NULLS_CTE)
       + " SELECT reading_id, x, y FROM nv WHERE x IS NOT NULL AND NOT isnan(x) AND y IS NOT NULL AND NOT isnan(y)")
def null_policy_any(spark, sf):
    return clean.drop_any_missing(_null_values(spark, sf).select("reading_id", "x", "y"))


@query("null_policy_either", with_(NULLS_CTE)
       + " SELECT reading_id, x, y FROM nv WHERE x IS NOT NULL OR y IS NOT NULL")
def null_policy_either(spark, sf):
    return clean.keep_if_any_present(_null_values(spark, sf).select("reading_id", "x", "y"), ["x", "y"])


@query("null_policy_columns", with_(NULLS_CTE)
       + " SELECT reading_id, x, y FROM nv WHERE x IS NOT NULL AND y IS NOT NULL")
def null_policy_columns(spark, sf):
    return clean.keep_if_all_present(_null_values(spark, sf).select("reading_id", "x", "y"), ["x", "y"])


MOVING_SQL = """
mv AS (SELECT DISTINCT user_id AS sensor_id,
              47.5e0 + ((user_id * 37 + length(event_type)) % 640) / 100e0 AS lat,
              6.0e0 + (user_id * 53 % 860) / 100e0 AS lon
       FROM events)"""


@query("dedupe_by_key", with_(MOVING_SQL) + """
 SELECT sensor_id, lat, lon FROM (
   SELECT *, row_number() OVER (PARTITION BY sensor_id ORDER BY lat, lon) AS rn FROM mv) WHERE rn = 1""")
def dedupe_by_key(spark, sf):
    """A sensor seen at several positions keeps its smallest ``(lat, lon)``."""
    ev = B.table(spark, sf, "events")
    moving = ev.select(
        F.col("user_id").alias("sensor_id"),
        F.expr("47.5e0 + ((user_id * 37 + length(event_type)) % 640) / 100e0").alias("lat"),
        F.expr(B.SENSOR_LON.format(k="user_id")).alias("lon")).distinct()
    return clean.dedupe_by_key(moving, "sensor_id", ["lat", "lon"])


@query("sorted_sensors", with_(READINGS_CTE) + " SELECT DISTINCT sensor_id FROM r ORDER BY sensor_id")
def sorted_sensors(spark, sf):
    return _readings(spark, sf).select("sensor_id").distinct().orderBy("sensor_id")


@query("country_cities", with_(CITY_CTE) + f"""
 SELECT geonameid, name, asciiname, alternatenames, latitude, longitude, population, elevation
 FROM city WHERE country = '{GEO_COUNTRY}'""")
def country_cities(spark, sf):
    c = B.cities(spark, sf).where(F.col("country") == F.lit(GEO_COUNTRY))
    return c.select(*schemas.CITY_KEEP).withColumnRenamed("dem", "elevation")


# --- geocode --------------------------------------------------------------------------

GEO_CTE = """
geo AS (SELECT lat, lon, min(country) AS country FROM (
  SELECT 47.5e0 + (c_custkey * 37 % 640) / 100e0 AS lat, 6.0e0 + (c_custkey * 53 % 860) / 100e0 AS lon,
         n_name AS country
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_mktsegment = 'BUILDING') GROUP BY lat, lon)"""


@query("geocode_enrich_keep", with_(READINGS_CTE, POS_CTE, GEO_CTE) + f"""
 SELECT sensor_id, lat, lon, coalesce(g.country, 'error') AS country
 FROM pos LEFT JOIN geo g USING (lat, lon)
 WHERE coalesce(g.country, 'error') IN ('{GEO_COUNTRY}', 'error')""")
def geocode_enrich_keep(spark, sf):
    """Fail-open: positions in the country, or with no geocode answer yet."""
    enriched = geocode.enrich_country(_positions(spark, sf), B.geocoded(spark, sf), on_missing="keep")
    return geocode.country_filter(enriched, GEO_COUNTRY).select("sensor_id", "lat", "lon", "country")


@query("geocode_enrich_drop", with_(READINGS_CTE, POS_CTE, GEO_CTE)
       + " SELECT sensor_id, lat, lon, g.country FROM pos JOIN geo g USING (lat, lon)")
def geocode_enrich_drop(spark, sf):
    enriched = geocode.enrich_country(_positions(spark, sf), B.geocoded(spark, sf), on_missing="drop")
    return enriched.select("sensor_id", "lat", "lon", "country")


@query("geocode_worklist", with_(READINGS_CTE, POS_CTE, GEO_CTE)
       + " SELECT DISTINCT lat, lon FROM pos ANTI JOIN geo USING (lat, lon)")
def geocode_worklist(spark, sf):
    return geocode.geocode_worklist(_positions(spark, sf), B.geocoded(spark, sf))


BODY_SQL = """
CASE WHEN event_type = 'error' THEN '{"error": "Unable to geocode"}'
     WHEN event_type = 'signup' THEN '{"osm_id": ' || CAST(event_id AS VARCHAR)
          || ', "osm_type": "way", "display_name": "' || event_type
          || '", "address": {"city": "c' || CAST(user_id AS VARCHAR) || '"}}'
     ELSE '{"osm_id": ' || CAST(event_id AS VARCHAR) || ', "osm_type": "node", "display_name": "'
          || event_type || '", "address": {"country_code": "n' || CAST(user_id % 25 AS VARCHAR)
          || '", "country": "NATION_' || CAST(user_id % 25 AS VARCHAR)
          || '", "road": "r' || json_extract_string(props, '$.k') || '"}}' END"""


def _body():
    eid, uid = F.col("event_id").cast("string"), F.col("user_id").cast("string")
    nat = (F.col("user_id") % 25).cast("string")
    return (F.when(F.col("event_type") == "error", F.lit('{"error": "Unable to geocode"}'))
             .when(F.col("event_type") == "signup",
                   F.concat(F.lit('{"osm_id": '), eid, F.lit(', "osm_type": "way", "display_name": "'),
                            F.col("event_type"), F.lit('", "address": {"city": "c'), uid, F.lit('"}}')))
             .otherwise(F.concat(F.lit('{"osm_id": '), eid,
                                 F.lit(', "osm_type": "node", "display_name": "'), F.col("event_type"),
                                 F.lit('", "address": {"country_code": "n'), nat,
                                 F.lit('", "country": "NATION_'), nat, F.lit('", "road": "r'),
                                 F.get_json_object("props", "$.k"), F.lit('"}}'))))


def _field(path):
    return f"CASE WHEN ok THEN coalesce(json_extract_string(body, '{path}'), '') ELSE '' END"


@query("geocode_parse", f"""
WITH b AS (SELECT event_id AS reading_id, {BODY_SQL} AS body FROM events),
p AS (SELECT reading_id, body, json_extract(body, '$.error') IS NULL AS ok FROM b)
SELECT reading_id,
       CASE WHEN ok THEN coalesce(CAST(json_extract(body, '$.osm_id') AS BIGINT), -1) ELSE -1 END AS osm_id,
       {_field('$.osm_type')} AS osm_type, {_field('$.display_name')} AS display_name,
       {_field('$.address.country_code')} AS country_code, {_field('$.address.country')} AS country,
       {_field('$.address.city')} AS city, {_field('$.address.road')} AS road, ok AS geocode_ok
FROM p""")
def geocode_parse(spark, sf):
    ev = B.table(spark, sf, "events").select(F.col("event_id").alias("reading_id"), _body().alias("body"))
    parsed = geocode.parse_responses(ev, "body")
    return parsed.select("reading_id", "osm_id", "osm_type", "display_name", "country_code",
                         "country", "city", "road", "geocode_ok")


# --- keys and paths --------------------------------------------------------------------

@query("coord_key_roundtrip", """
WITH k AS (SELECT s_suppkey, concat_ws('|', CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS VARCHAR)) AS coord_key
           FROM supplier)
SELECT s_suppkey, coord_key, CAST(split_part(coord_key, '|', 1) AS DOUBLE) AS a,
       CAST(split_part(coord_key, '|', 2) AS DOUBLE) AS b FROM k""")
def coord_key_roundtrip(spark, sf):
    k = B.table(spark, sf, "supplier").select(
        "s_suppkey", coord_key("s_suppkey", "s_nationkey").alias("coord_key"))
    parts = split_key("coord_key")
    return k.select("s_suppkey", "coord_key", parts[0].alias("a"), parts[1].alias("b"))


@query("file_basename", "SELECT page_id, regexp_extract(url, '([^/]*)/*$', 1) AS file FROM pages")
def file_basename(spark, sf):
    return B.table(spark, sf, "pages").select("page_id", basename("url").alias("file"))


# --- samples and statistics ------------------------------------------------------------

@query("exact_sample", with_(READINGS_CTE) + f"""
 SELECT reading_id, sensor_id, P1 FROM r
 ORDER BY md5(CAST(reading_id AS VARCHAR)), reading_id LIMIT {SAMPLE_N}""")
def exact_sample(spark, sf):
    rd = _readings(spark, sf).select("reading_id", "sensor_id", "P1")
    return sampling.exact_sample(rd, SAMPLE_N, ["reading_id"])


@query("random_sample_bound", with_(READINGS_CTE) + f"""
 SELECT true AS within_bound, true AS members, true AS repeatable, true AS near_expected,
        least({SAMPLE_N}, count(*)) AS bound FROM r""")
def random_sample_bound(spark, sf):
    """Facts about the random sample: rows within the bound, every row a
    reading and none twice, the same rows for the same seed, and a size
    within six standard deviations of the bound."""
    rd = materialize(spark, _readings(spark, sf).select("reading_id", "sensor_id", "P1"), name="sampled")
    one = materialize(spark, sampling.random_sample(rd, SAMPLE_N, seed=7), name="sample")
    two = sampling.random_sample(rd, SAMPLE_N, seed=7)
    total = rd.agg(F.count(F.lit(1)).alias("total"))
    size = one.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("reading_id").alias("ids"))
    found = one.join(rd, ["reading_id", "sensor_id", "P1"], "left_semi").agg(F.count(F.lit(1)).alias("found"))
    same = one.join(two, ["reading_id", "sensor_id", "P1"], "left_semi").agg(F.count(F.lit(1)).alias("same"))
    facts = total.crossJoin(size).crossJoin(found).crossJoin(same)  # one row each
    bound = F.least(F.lit(SAMPLE_N).cast("long"), F.col("total"))
    return facts.select(
        (F.col("n") <= bound).alias("within_bound"),
        ((F.col("found") == F.col("n")) & (F.col("ids") == F.col("n"))).alias("members"),
        (F.col("same") == F.col("n")).alias("repeatable"),
        (F.col("n") >= bound - 6 * F.sqrt(bound.cast("double"))).alias("near_expected"),
        bound.alias("bound"))


@query("ml_corr_matrix", with_(NULLS_CTE, corr_sql("nv", ["x", "y", "h"])))
def ml_corr_matrix(spark, sf):
    """Matrix over rows with every input present and not NaN (assembler skip)."""
    return stats.correlation_matrix(_null_values(spark, sf), ["x", "y", "h"], digits=DIGITS)


ORACLE["remoteness_corr_country"] = with_(
    *[GEO_CTE if c == "GEOCTE" else c for c in REMOTENESS_COUNTRY_SQL],
    corr_sql("j", ["avg_p", "min_dist"]))


ORACLE["settlement_corr_country"] = with_(
    *[GEO_CTE if c == "GEOCTE" else c for c in REMOTENESS_COUNTRY_SQL[:7]],
    CITY_CTE,
    f"""d AS (SELECT p.sensor_id, geonameid, population, elevation, {DIST} AS dist
          FROM near p, city)""",
    *SETTLEMENT_ROWS_SQL[4:],
    corr_sql("j", ["avg_p", "population", "elevation"]))


def queries() -> dict[str, QueryFn]:
    # connectors register themselves on import
    from aerocorr.plans import connectors  # noqa: F401
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from aerocorr.plans import connectors  # noqa: F401
    return dict(ORACLE)
