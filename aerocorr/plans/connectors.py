"""Named queries for readers and writers: each writes tables derived from the
test data in its source format to the shared work folder and reads them back
through the library's readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerocorr import schemas
from aerocorr.config import work_dir
from aerocorr.operators.clean import distinct_positions
from aerocorr.operators.geocode import geocode_table
from aerocorr.plans import studies
from aerocorr.plans.catalog import (
    CITY_CTE, DIGITS, DIST, GEO_COUNTRY, GEO_CTE, corr_sql, MIN_DIST_CTE, POS_CTE, READINGS_CTE, REMOTENESS_ROWS_SQL,
    SAMPLE_N, SETTLEMENT_RADIUS, SETTLEMENT_ROWS_SQL, SITE_CTE, query, with_,
)
from aerocorr.sources import bindings as B
from aerocorr.sources.cities import read_cities
from aerocorr.sources.geocode_cache import GeocodeCache
from aerocorr.sources.landing import land, ledger
from aerocorr.sources.quarantine import parse_cities, parse_sites
from aerocorr.sources.readings import read_family, read_landed, read_readings
from aerocorr.sources.sinks import materialize, write_sample_csv
from aerocorr.sources.sites import read_sites

LANDED_SCHEMA = T.StructType(schemas.READING_SCHEMA.fields + [
    T.StructField("hour_of_day", T.IntegerType()), T.StructField("month", T.StringType()),
    T.StructField("source_file", T.StringType())])
SAMPLE_SCHEMA = "reading_id BIGINT, sensor_id BIGINT, avg_p DOUBLE, min_dist DOUBLE"


@query("csv_export_roundtrip", with_(*REMOTENESS_ROWS_SQL) + f"""
 SELECT reading_id, sensor_id, avg_p, min_dist FROM j
 ORDER BY md5(CAST(reading_id AS VARCHAR)), reading_id LIMIT {SAMPLE_N}""")
def csv_export_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Bounded plotting sample of the remoteness rows: one ``;`` CSV with a
    header, read back."""
    rd = B.readings(spark, sf)
    near = studies.remoteness_table(rd, B.sites(spark, sf))
    rows = studies.remoteness_readings(rd, near, keep=("reading_id",))
    path = work_dir(spark, "sample-csv")
    write_sample_csv(rows.select("reading_id", "sensor_id", "avg_p", "min_dist"), path,
                     keys=["reading_id"], n=SAMPLE_N)
    return (spark.read.option("header", True).option("sep", ";")
            .schema(SAMPLE_SCHEMA).csv(path))


@query("settlement_csv_export", with_(*SETTLEMENT_ROWS_SQL, """
 k AS (SELECT avg_p, population, elevation, CAST(floor(avg_p * 1000000) AS BIGINT) AS avg_key,
              CAST(floor(population * 1000000) AS BIGINT) AS pop_key FROM j)""") + f"""
 SELECT * FROM k
 ORDER BY md5(concat_ws('|', CAST(avg_key AS VARCHAR), CAST(pop_key AS VARCHAR), CAST(elevation AS VARCHAR))),
          avg_key, pop_key, elevation LIMIT {SAMPLE_N}""")
def settlement_csv_export(spark: SparkSession, sf: str) -> DataFrame:
    """Bounded plotting sample of the settlement rows: one ``;`` CSV with a
    header, read back.  Sampled by whole numbers, as engines print doubles
    differently."""
    rows = studies.settlement_rows(B.readings(spark, sf), B.cities(spark, sf), radius=SETTLEMENT_RADIUS)
    rows = rows.select(
        "avg_p", "population", "elevation", F.floor(F.col("avg_p") * 1000000).cast("long").alias("avg_key"),
        F.floor(F.col("population") * 1000000).cast("long").alias("pop_key"))
    path = work_dir(spark, "settlement-csv")
    write_sample_csv(rows, path, keys=["avg_key", "pop_key", "elevation"], n=SAMPLE_N)
    return (spark.read.option("header", True).option("sep", ";").schema(
        "avg_p DOUBLE, population DOUBLE, elevation BIGINT, avg_key BIGINT, pop_key BIGINT").csv(path))


@query("parquet_materialize", with_(READINGS_CTE, POS_CTE, SITE_CTE, MIN_DIST_CTE)
       + " SELECT p.sensor_id, p.lat, p.lon, m.min_dist FROM pos p JOIN md m ON p.sensor_id = m.sensor_id")
def parquet_materialize(spark, sf):
    """The nearest-site table built once, written, and served from the files."""
    path = work_dir(spark, "nearest-site")
    studies.remoteness_table(B.readings(spark, sf), B.sites(spark, sf), path=path)
    # served from the files: the second call reads no sites at all
    return studies.remoteness_table(B.readings(spark, sf), B.sites(spark, sf).limit(0), path=path,
                                    refresh=False)


@query("site_csv_scan", with_(SITE_CTE) + " SELECT latitude, longitude FROM site")
def site_csv_scan(spark, sf):
    path = work_dir(spark, "sites-csv")
    (B.sites(spark, sf).select("latitude", "longitude").write
        .option("header", True).option("sep", ";").csv(path))
    return read_sites(spark, path)


# --- damage written into text files: every so many rows hold a word for a number ---
DAMAGED_SITE, DAMAGED_CITY = 7, 13


@query("site_csv_rejects", f"""
SELECT s_suppkey % {DAMAGED_SITE} = 0 AS rejected,
       CASE WHEN s_suppkey % {DAMAGED_SITE} <> 0 THEN 47.5e0 + (s_suppkey * 71 % 640) / 100e0 END AS latitude,
       CASE WHEN s_suppkey % {DAMAGED_SITE} <> 0 THEN 6.0e0 + (s_suppkey * 29 % 860) / 100e0 END AS longitude,
       CASE WHEN s_suppkey % {DAMAGED_SITE} = 0 THEN 'n/a;' || s_suppkey END AS line FROM supplier""")
def site_csv_rejects(spark, sf):
    """A damaged site file: the rows that parse, and the lines that do not."""
    path = work_dir(spark, "damaged-sites")
    bad = F.col("site_id") % DAMAGED_SITE == 0
    (B.sites(spark, sf).select(
        F.when(bad, "n/a").otherwise(F.col("latitude").cast("string")).alias("latitude"),
        F.when(bad, F.col("site_id").cast("string")).otherwise(F.col("longitude").cast("string")).alias("longitude"))
        .write.option("header", True).option("sep", ";").csv(path))
    good, rejects = parse_sites(spark, path, max_share=0.5)
    return good.select(F.lit(False).alias("rejected"), "*", F.lit(None).cast("string").alias("line")).unionByName(
        rejects.select(F.lit(True).alias("rejected"), "line"), allowMissingColumns=True)


@query("city_tsv_rejects", f"""
SELECT c_custkey % {DAMAGED_CITY} = 0 AS rejected, CAST(c_custkey AS INTEGER) AS geonameid,
       CASE WHEN c_custkey % {DAMAGED_CITY} <> 0 THEN c_custkey * 10 END AS population,
       CASE WHEN c_custkey % {DAMAGED_CITY} = 0 THEN 19 END AS fields
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_name = '{GEO_COUNTRY}' OR c_custkey % {DAMAGED_CITY} = 0""")
def city_tsv_rejects(spark, sf):
    """A damaged gazetteer: one country's rows, and the rejected lines of all."""
    path = work_dir(spark, "damaged-cities")
    bad = F.col("geonameid") % DAMAGED_CITY == 0
    (_gazetteer(spark, sf)
        .withColumn("population", F.when(bad, "many").otherwise(F.col("population").cast("string")))
        .write.option("header", False).option("sep", "\t").option("quote", "").option("nullValue", "").csv(path))
    good, rejects = parse_cities(spark, path, GEO_COUNTRY, max_share=0.5)
    fields = F.split("line", "\t")
    return good.select(F.lit(False).alias("rejected"), "geonameid", "population",
                       F.lit(None).cast("int").alias("fields")).unionByName(
        rejects.select(F.lit(True).alias("rejected"), fields[0].cast("int").alias("geonameid"),
                       F.lit(None).cast("long").alias("population"), F.size(fields).alias("fields")))


def _gazetteer(spark, sf) -> DataFrame:
    """Cities laid out as the 19-column gazetteer."""
    c = B.cities(spark, sf)
    return c.select(
        F.col("geonameid").cast("int"), "name", "asciiname", "alternatenames", "latitude",
        "longitude", F.lit("P").alias("feature_class"), F.lit("PPL").alias("feature_code"),
        F.col("country").alias("country_code"), *[F.lit(None).cast("string").alias(n) for n in
                                                   ("cc2", "admin1_code", "admin2_code",
                                                    "admin3_code", "admin4_code")],
        (F.col("geonameid") * 10).alias("population"), F.lit(None).cast("int").alias("elevation"),
        F.col("dem").cast("int"), F.lit("Europe/Berlin").alias("timezone"),
        F.lit("2019-01-01").alias("modification_date"))


@query("city_tsv_scan", f"""
SELECT CAST(c_custkey AS INTEGER) AS geonameid, c_name AS name,
       47.5e0 + (c_custkey * 71 % 640) / 100e0 AS latitude,
       6.0e0 + (c_custkey * 29 % 860) / 100e0 AS longitude,
       n_name AS country_code, c_custkey * 10 AS population, CAST(c_custkey % 700 AS INTEGER) AS dem
FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name = '{GEO_COUNTRY}'""")
def city_tsv_scan(spark, sf):
    path = work_dir(spark, "cities-tsv")
    (_gazetteer(spark, sf).write.option("header", False).option("sep", "\t")
        .option("quote", "").option("nullValue", "").csv(path))
    cities = read_cities(spark, path, country_code=GEO_COUNTRY)
    return cities.select("geonameid", "name", "latitude", "longitude", "country_code",
                         "population", "dem")


# --- fixed values: sensor types written into each family's files --------------
FAMILY_SENSOR_TYPE = {1: "sds011", 2: "hpm", 3: "pms5003"}


def _write_families(spark, sf) -> dict[int, str]:
    """Each family's readings written with that family's own file schema."""
    out = {}
    base = work_dir(spark, "families")
    for fam, df in B.reading_families(spark, sf).items():
        cols = {
            "sensor_id": F.col("sensor_id").cast("int"),
            "sensor_type": F.lit(FAMILY_SENSOR_TYPE[fam]),
            "location": (F.col("sensor_id") % 100).cast("int"),
            "lat": F.col("lat"), "lon": F.col("lon"), "timestamp": F.col("timestamp"),
            "P1": F.col("P1"), "P2": F.col("P2"), "P0": F.col("P1") / 2,
        }
        fields = schemas.FAMILY_SCHEMAS[fam].fields
        sel = [(cols[f.name] if f.name in cols else F.lit(None)).cast(f.dataType).alias(f.name)
               for f in fields]
        path = f"{base}/schema{fam}"
        df.select(*sel).write.parquet(path)
        out[fam] = path
    return out


FAMILY_SQL = with_(READINGS_CTE) + """
 SELECT sensor_id, family, lat, lon, P1, P2, CASE WHEN family = 3 THEN P1 / 2 END AS P0 FROM r"""


@query("family_parquet_scan", FAMILY_SQL)
def family_parquet_scan(spark, sf):
    paths = _write_families(spark, sf)
    return read_readings(spark, paths).select("sensor_id", "family", "lat", "lon", "P1", "P2", "P0")


@query("land_manifest", with_(READINGS_CTE)
       + " SELECT sensor_id, family, '2024-01' AS month, P1, P2 FROM r")
def land_manifest(spark, sf):
    """Every fetched file listed twice in the manifest; each lands once."""
    paths = _write_families(spark, sf)
    entries = []
    for fam, p in paths.items():
        for f in spark.read.parquet(p).inputFiles():  # file names only
            entries += [(f, fam, "2024-01")] * 2
    manifest = spark.createDataFrame(entries, "path string, family int, month string")
    out = work_dir(spark, "landed")
    land(spark, manifest, out)
    landed = read_landed(spark, out, schema=LANDED_SCHEMA)
    return landed.select("sensor_id", "family", "month", "P1", "P2")


@query("land_incremental", with_(READINGS_CTE)
       + """ SELECT sensor_id, family, '2024-0' || (1 + sensor_id % 2) AS month, P1, P2 FROM r""")
def land_incremental(spark, sf):
    """Two calls that land files of the same family and month: the second one
    adds its files, lists some of the first again, and erases nothing."""
    base, out = work_dir(spark, "months"), work_dir(spark, "landed")
    calls = ([], [])
    for fam, df in B.reading_families(spark, sf).items():
        for month in (1, 2):
            rows = df.where(F.col("sensor_id") % 2 == month - 1)
            for call in (0, 1):
                path = f"{base}/{fam}/{month}/call {call}"
                rows.where(F.col("reading_id") % 2 == call).select(
                    F.col("sensor_id").cast("int"), "lat", "lon", "timestamp", "P1", "P2").write.parquet(path)
                calls[call].append((path, fam, f"2024-0{month}"))
    for entries in (calls[0], calls[1] + calls[0][:1]):
        land(spark, spark.createDataFrame(entries, "path string, family int, month string"), out)
    return read_landed(spark, out, schema=LANDED_SCHEMA).select("sensor_id", "family", "month", "P1", "P2")


def _rename(spark, folder: str, name: str) -> str:
    """Give the one Parquet file in ``folder`` a name; its path."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    part = next(s.getPath() for s in fs.listStatus(path) if s.getPath().getName().endswith(".parquet"))
    fs.rename(part, jvm.org.apache.hadoop.fs.Path(folder, name))
    return f"{folder}/{name}"


def _two_folders(spark, sf) -> str:
    """Readings of each family in two folders, as files of one name; landed by
    a call for each folder and a third that lists the first again."""
    base, out = work_dir(spark, "same-names"), work_dir(spark, "landed")
    calls = ([], [])
    for fam, df in B.reading_families(spark, sf).items():
        for call in (0, 1):
            folder = f"{base}/{'ab'[call]}/{fam}"
            df.where(F.col("reading_id") % 3 == call).select(
                F.col("sensor_id").cast("int"), "lat", "lon", "timestamp", "P1", "P2").coalesce(1).write.parquet(folder)
            calls[call].append((_rename(spark, folder, "data.parquet"), fam, "2024-01"))
    for entries in (calls[0], calls[1], calls[0]):
        land(spark, spark.createDataFrame(entries, "path string, family int, month string"), out)
    return out


@query("land_same_names", with_(READINGS_CTE)
       + " SELECT sensor_id, family, '2024-01' AS month, P1, P2 FROM r WHERE reading_id % 3 < 2")
def land_same_names(spark, sf):
    """Files of one name from two folders, landed in two calls, all keep their rows."""
    return read_landed(spark, _two_folders(spark, sf), schema=LANDED_SCHEMA).select(
        "sensor_id", "family", "month", "P1", "P2")


@query("land_ledger", with_(READINGS_CTE) + """
 SELECT family, '2024-01' AS month, CASE reading_id % 3 WHEN 0 THEN 'a' ELSE 'b' END AS folder,
        count(*) AS rows, CAST(1 + reading_id % 3 AS INTEGER) AS call
 FROM r WHERE reading_id % 3 < 2 GROUP BY ALL""")
def land_ledger(spark, sf):
    """The ledger of those calls: the third one landed nothing."""
    path = F.element_at(F.split("file_path", "/"), -3)
    return ledger(spark, _two_folders(spark, sf)).select("family", "month", path.alias("folder"), "rows", "call")


@query("nearest_refresh_changed", with_(READINGS_CTE, POS_CTE, SITE_CTE, MIN_DIST_CTE)
       + " SELECT p.sensor_id, p.lat, p.lon, m.min_dist FROM pos p JOIN md m ON p.sensor_id = m.sensor_id")
def nearest_refresh_changed(spark, sf):
    """The nearest-site table of a third of the readings, then refreshed with
    all of them: only sensors with new positions are searched again."""
    path = work_dir(spark, "nearest-site")
    rd = B.readings(spark, sf)
    for part in (rd.where("sensor_id % 3 = 0"), rd):
        near = studies.remoteness_table(part, B.sites(spark, sf), path=path, refresh="changed")
    return near


@query("geocode_cache_rounds", with_(READINGS_CTE, POS_CTE, GEO_CTE) + """
 SELECT lat, lon, coalesce(country, 'error') AS country,
        CAST(CASE WHEN country IS NOT NULL AND CAST(round(lat * 100) AS INTEGER) % 2 = 0 THEN 1 ELSE 2 END
             AS INTEGER) AS attempt
 FROM (SELECT DISTINCT lat, lon FROM pos WHERE lat IS NOT NULL AND lon IS NOT NULL) p
 LEFT JOIN geo USING (lat, lon)""")
def geocode_cache_rounds(spark, sf):
    """Two rounds of worklist, lookup and append.  The first round answers half
    of the known coordinates, failed ones are asked once more."""
    positions = distinct_positions(B.readings(spark, sf))
    known = geocode_table(B.geocoded(spark, sf))
    cache = GeocodeCache(spark, work_dir(spark, "geocode-cache"), max_attempts=2)
    for late in (False, True):
        asked = cache.worklist(positions).join(known, ["lat", "lon"], "left")
        served = F.col("country").isNotNull() & (F.lit(late) | (F.round(F.col("lat") * 100).cast("int") % 2 == 0))
        cache.add(asked.select("lat", "lon", F.when(served, F.to_json(F.struct(
            F.lit(7).alias("osm_id"), F.struct("country").alias("address"))))
            .otherwise(F.lit('{"error": "Unable to geocode"}')).alias("body")))
    out = materialize(spark, cache.entries().join(cache.answers().withColumnRenamed("country", "answer"), ["lat", "lon"])
                      .select("lat", "lon", F.col("answer").alias("country"), "attempt"), name="geocoded")
    cache.close()
    return out


@query("family_mixed_schema", with_(READINGS_CTE) + """
 SELECT sensor_id, lat, lon, P1, CASE WHEN sensor_id % 2 = 0 THEN P2 END AS P2 FROM r WHERE family = 2""")
def family_mixed_schema(spark, sf):
    """One family whose older files lack a column and hold narrower integers."""
    base = work_dir(spark, "mixed")
    rows = B.reading_families(spark, sf)[2]
    rows.where("sensor_id % 2 = 1").select(F.col("sensor_id").cast("int"), "lat", "lon", "timestamp",
                                           "P1").write.parquet(f"{base}/old")
    rows.where("sensor_id % 2 = 0").select(F.col("sensor_id").cast("long"), "lat", "lon", "timestamp",
                                           "P1", "P2").write.parquet(f"{base}/new")
    return read_family(spark, [f"{base}/old", f"{base}/new"], 2).select("sensor_id", "lat", "lon", "P1", "P2")


# --- streaming ----------------------------------------------------------------------

@query("streaming_landing", with_(READINGS_CTE)
       + " SELECT sensor_id, family, strftime(ts, '%Y-%m') AS month, P1, P2 FROM r")
def streaming_landing(spark, sf):
    """Family folders landed by the streaming job (exactly-once file source)."""
    from aerocorr.streaming import start_landing
    paths = _write_families(spark, sf)
    out = work_dir(spark, "stream-landed")
    q = start_landing(spark, paths, out)
    q.awaitTermination()
    landed = read_landed(spark, out, schema=LANDED_SCHEMA)
    return landed.select("sensor_id", "family", "month", "P1", "P2")


@query("streaming_position_moments", with_(READINGS_CTE) + """
 SELECT sensor_id, lat, lon, count(avg_q) AS n, round(sum(avg_q), 4) AS sum_avg_p,
        round(sum(avg_q * avg_q), 6) AS sumsq_avg_p
 FROM (SELECT *, CASE WHEN P1 < 5000 AND P2 < 5000 AND hour(ts) BETWEEN 6 AND 17
                      THEN (P1 + P2) / 2 END AS avg_q FROM r)
 GROUP BY sensor_id, lat, lon""")
def streaming_position_moments(spark, sf):
    """Running per-position moments maintained by a streaming aggregation."""
    from aerocorr.streaming import read_snapshot, start_position_moments, stream_readings
    paths = _write_families(spark, sf)
    out = work_dir(spark, "stream-moments")
    q = start_position_moments(spark, stream_readings(spark, paths, max_files_per_trigger=2), out)
    q.awaitTermination()
    m = read_snapshot(spark, out)
    # sums sit on exact decimal grids (avg_p is a multiple of 0.005), so
    # rounding them compares engines without float-noise ties
    n, mean, var = F.col("_n"), F.col("_mean"), F.col("_var")
    return m.select("sensor_id", "lat", "lon", n.alias("n"),
                    F.round(n * mean, 4).alias("sum_avg_p"),
                    F.round(n * var + n * mean * mean, 6).alias("sumsq_avg_p"))


@query("streaming_remoteness_corr", with_(*REMOTENESS_ROWS_SQL, corr_sql("j", ["avg_p", "min_dist"])))
def streaming_remoteness_corr(spark, sf):
    """The flagship matrix computed from the moments the streaming job keeps
    current (several micro-batches merged in its state)."""
    from aerocorr.streaming import read_snapshot, start_position_moments, stream_readings
    paths = _write_families(spark, sf)
    out = work_dir(spark, "stream-moments")
    q = start_position_moments(spark, stream_readings(spark, paths, max_files_per_trigger=2), out)
    q.awaitTermination()
    return studies.remoteness_from_moments(read_snapshot(spark, out), B.sites(spark, sf), digits=DIGITS)


@query("remoteness_corr_landed", with_(*REMOTENESS_ROWS_SQL, corr_sql("j", ["avg_p", "min_dist"])))
def remoteness_corr_landed(spark, sf):
    """Land once, study many: the flagship over the landed, partitioned table,
    filtering on the hour stored at landing."""
    paths = _write_families(spark, sf)
    entries = [(f, fam, "2024-01") for fam, p in paths.items() for f in spark.read.parquet(p).inputFiles()]
    out = work_dir(spark, "landed")
    land(spark, spark.createDataFrame(entries, "path string, family int, month string"), out)
    readings = read_landed(spark, out, schema=LANDED_SCHEMA)
    return studies.remoteness_study(readings, B.sites(spark, sf), digits=DIGITS)


# --- studies kept current by streams ------------------------------------------------

PART_FILE_ROWS = 100_000


def _in_parts(df: DataFrame, by: str, name: str, parts: int = 3) -> DataFrame:
    """A stream over ``df`` written in ``parts`` parts by ``by`` modulo their
    number, a part a micro-batch: each as the same number of files, one where
    there are few rows."""
    spark, path = df.sparkSession, work_dir(df.sparkSession, name)
    part = F.pmod(F.col(by), F.lit(parts))
    sizes = {r.part: r["count"] for r in df.groupBy(part.alias("part")).count().collect()}
    files = max(1, min((sizes.get(i, 0) for i in range(parts))) // PART_FILE_ROWS)
    for i in range(parts):
        rows = df.where(part == i)
        # a repartition scans in many tasks; few rows need none, and an empty part still has its file
        rows = rows.repartition(files) if sizes.get(i, 0) > PART_FILE_ROWS // 10 else rows.coalesce(1)
        rows.write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", files).parquet(path)


@query("streaming_nearest_city", with_(READINGS_CTE, POS_CTE, CITY_CTE,
                                       f"d AS (SELECT sensor_id, geonameid, {DIST} AS dist FROM pos, city)")
       + """ SELECT sensor_id, geonameid, dist FROM (
               SELECT *, rank() OVER (PARTITION BY sensor_id ORDER BY dist) AS rk FROM d)
             WHERE rk = 1""")
def streaming_nearest_city(spark, sf):
    """The nearest cities of every sensor after three micro-batches that each
    bring new sensors and new cities."""
    from aerocorr.streaming import read_nearest, start_nearest
    out = work_dir(spark, "stream-nearest")
    sensors = _in_parts(B.readings(spark, sf).select("sensor_id", "lat", "lon"), "sensor_id", "stream-sensors")
    cities = _in_parts(B.cities(spark, sf).select("geonameid", "latitude", "longitude"), "geonameid", "stream-cities")
    start_nearest(spark, sensors, cities, out).awaitTermination()
    return read_nearest(spark, out).select("sensor_id", "geonameid", "dist")


@query("streaming_settlement_corr", with_(*SETTLEMENT_ROWS_SQL, corr_sql("j", ["avg_p", "population", "elevation"])))
def streaming_settlement_corr(spark, sf):
    """The settlement matrix from merged moments of distinct triples, the
    readings arriving in three micro-batches."""
    from aerocorr.streaming import settlement_matrix, start_settlement
    out = work_dir(spark, "stream-settlement")
    rd = B.readings(spark, sf)
    near, cities = studies.settlement_places(materialize(spark, distinct_positions(rd), name="positions"),
                                             B.cities(spark, sf), radius=SETTLEMENT_RADIUS)
    stream = _in_parts(rd.select("reading_id", "sensor_id", "P1", "P2"), "reading_id", "stream-readings")
    start_settlement(spark, stream, near, out, cities=cities).awaitTermination()
    return settlement_matrix(spark, out, digits=DIGITS)


@query("settlement_corr_key_filter", with_(*SETTLEMENT_ROWS_SQL, corr_sql("j", ["avg_p", "population", "elevation"])))
def settlement_corr_key_filter(spark, sf):
    """The settlement matrix with the broadcast ruled out: readings pass a
    filter of the matched sensors before the join shuffles them."""
    return studies.settlement_study(B.readings(spark, sf), B.cities(spark, sf), radius=SETTLEMENT_RADIUS,
                                    digits=DIGITS, max_broadcast_rows=0)
