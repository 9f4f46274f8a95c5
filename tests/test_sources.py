import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from aerocorr import schemas
from aerocorr.functions.keys import basename, coord_key, split_key
from aerocorr.sources import land, materialize, read_cities, read_family, read_landed, read_sites, write_parquet, write_sample_csv


def test_read_sites_permissive(spark, tmp_path):
    p = tmp_path / "sites.csv"
    p.write_text("latitude;longitude\n49.636;8.618\nabc;7.1\n51.294;7.199\n")
    rows = [tuple(r) for r in read_sites(spark, str(p)).collect()]
    assert rows == [(49.636, 8.618), (None, 7.1), (51.294, 7.199)]


def test_read_cities_unquoted(spark, tmp_path):
    base = ["1", '"Quoted Town', "Quoted Town", "", "50.1", "7.2", "P", "PPL", "DE", "", "", "", "", "",
            "1200", "", "80", "Europe/Berlin", "2019-01-01"]
    other = ["2", "Ville", "Ville", "", "48.0", "2.0", "P", "PPL", "FR", "", "", "", "", "",
             "500", "35", "40", "Europe/Paris", "2019-01-01"]
    p = tmp_path / "cities.txt"
    p.write_text("\t".join(base) + "\n" + "\t".join(other) + "\n")
    de = read_cities(spark, str(p), country_code="DE").collect()
    assert len(de) == 1 and de[0].name == '"Quoted Town' and de[0].dem == 80 and de[0].population == 1200
    assert read_cities(spark, str(p)).count() == 2


def test_landing_dedupes_basename_and_is_idempotent(spark, tmp_path):
    raw = str(tmp_path / "raw")
    spark.createDataFrame([(1, 50.0, 7.0, "2018-01-01 06:00:00", 3.0, 4.0)],
                          "sensor_id int, lat double, lon double, timestamp string, P1 double, P2 double"
                          ).coalesce(1).write.parquet(raw)
    f = spark.read.parquet(raw).inputFiles()[0]
    manifest = spark.createDataFrame([(f, 2, "2018-01"), (f, 2, "2018-01")],
                                     "path string, family int, month string")
    out = str(tmp_path / "landed")
    schema = schemas.READING_SCHEMA.__class__(schemas.READING_SCHEMA.fields + [
        schemas.T.StructField("month", schemas.T.StringType())])
    land(spark, manifest, out)
    land(spark, manifest, out)
    got = read_landed(spark, out, schema=schema)
    assert got.count() == 1
    r = got.collect()[0]
    assert (r.family, r.month, r.P1) == (2, "2018-01", 3.0)
    assert os.path.isdir(os.path.join(out, "family=2", "month=2018-01"))


def test_materialize_reads_back_and_reloads(spark, tmp_path):
    path = str(tmp_path / "m")
    df = materialize(spark, spark.range(5), path)
    assert "Scan parquet" in df._jdf.queryExecution().executedPlan().toString()
    assert "Range" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.count() == 5
    again = materialize(spark, lambda: spark.range(100), path, refresh=False)
    assert again.count() == 5  # reloaded, not rebuilt
    assert materialize(spark, lambda: spark.range(7), path, refresh=True).count() == 7


def test_sample_csv_single_file(spark, tmp_path):
    path = str(tmp_path / "s")
    write_sample_csv(spark.range(50).withColumn("v", F.col("id") * 0.5), path, keys=["id"], n=10)
    files = [f for f in os.listdir(path) if f.endswith(".csv")]
    assert len(files) == 1
    text = open(os.path.join(path, files[0])).read().splitlines()
    assert text[0] == "id;v" and len(text) == 11


def test_keys_and_basename(spark):
    df = spark.createDataFrame([(49.636, 8.618, "https://a.example/x/2018-01/part-0.parquet")],
                               "lat double, lon double, url string")
    r = df.select(coord_key("lat", "lon").alias("k"), basename("url").alias("b")).first()
    assert r.k == "49.636|8.618" and r.b == "part-0.parquet"
    back = df.select(split_key(coord_key("lat", "lon")).alias("v")).first().v
    assert back == [49.636, 8.618]
    bad = spark.createDataFrame([("1.5|x",)], "k string").select(split_key("k").alias("v")).first().v
    assert bad == [1.5, None]


def test_sample_csv_bernoulli_bounded(spark, tmp_path):
    path = str(tmp_path / "b")
    write_sample_csv(spark.range(500), path, keys=["id"], n=20, method="bernoulli", seed=1)
    back = spark.read.option("header", True).csv(path)
    assert 0 < back.count() <= 20


def test_materialize_rebuilds_an_uncommitted_table(spark, tmp_path):
    from aerocorr.sources.sinks import committed
    path = str(tmp_path / "partial")
    os.makedirs(os.path.join(path, "_temporary"))  # a write that never committed
    assert not committed(spark, path)
    assert materialize(spark, lambda: spark.range(3), path, refresh=False).count() == 3
    assert committed(spark, path)


def test_landed_hour_is_stored_and_pruned(spark, tmp_path):
    from aerocorr.operators.clean import daytime_filter
    raw = str(tmp_path / "raw")
    spark.createDataFrame([(1, 50.0, 7.0, "2018-01-01 05:00:00", 3.0, 4.0),
                           (1, 50.0, 7.0, "2018-01-01 07:00:00", 5.0, 6.0)],
                          "sensor_id int, lat double, lon double, timestamp string, P1 double, P2 double"
                          ).coalesce(1).write.parquet(raw)
    files = spark.read.parquet(raw).inputFiles()
    manifest = spark.createDataFrame([(f, 1, "2018-01") for f in files], "path string, family int, month string")
    out = str(tmp_path / "landed")
    land(spark, manifest, out)
    landed = read_landed(spark, out)
    assert sorted(r.hour_of_day for r in landed.collect()) == [5, 7]
    day = daytime_filter(landed.where("month = '2018-01'"))
    assert [r.P1 for r in day.collect()] == [5.0]
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan
    assert "GreaterThanOrEqual(hour_of_day,6)" in plan  # pushed to the Parquet scan


def test_materialize_empty(spark, tmp_path):
    df = materialize(spark, spark.range(0).withColumn("x", F.col("id") * 1.0), str(tmp_path / "e"))
    assert df.count() == 0 and df.columns == ["id", "x"]


def test_read_family_glob_and_canonical_types(spark, tmp_path):
    from aerocorr.sources import read_family
    for month in ("2018-01", "2018-02"):
        spark.createDataFrame([(7, "hpm", 50.0, 8.0, f"{month}-03 10:00:00", 1.0, 2.0)],
                              "sensor_id int, sensor_type string, lat double, lon double, timestamp string, "
                              "P1 double, P2 double").write.parquet(str(tmp_path / month / "hpm"))
    df = read_family(spark, str(tmp_path / "*" / "hpm"), 2)
    assert df.count() == 2
    assert dict(df.dtypes)["sensor_id"] == "bigint" and dict(df.dtypes)["family"] == "int"
    assert df.where("P0 IS NULL AND durP1 IS NULL").count() == 2


READING = "sensor_id int, lat double, lon double, timestamp string, P1 double, P2 double"


def _file(spark, path, sensor, schema=READING):
    row = (sensor, 50.0, 7.0, "2018-01-01 06:00:00", 3.0, 4.0)[:len(schema.split(", "))]
    spark.createDataFrame([row], schema).coalesce(1).write.parquet(path)
    return path


def test_landing_grows_a_month_file_by_file(spark, tmp_path):
    """Same family and month twice, the same basename in two months, blanks and
    per cent signs in names, a folder as a path: every row lands once."""
    entries = [(_file(spark, str(tmp_path / f"m{m}" / "part a%20b.parquet"), 10 * m + k), 3, f"2018-0{m}")
               for m, k in ((1, 0), (2, 0))]
    more = [(_file(spark, str(tmp_path / "late" / "x y.parquet"), 77), 3, "2018-01")]
    out, schema = str(tmp_path / "landed"), "path string, family int, month string"
    for call in (entries, more, more):
        landed = land(spark, spark.createDataFrame(call, schema), out)
    got = sorted((r.sensor_id, str(r.month)) for r in landed.select("sensor_id", "month").collect())
    assert got == [(10, "2018-01"), (20, "2018-02"), (77, "2018-01")]


def test_landing_an_empty_manifest(spark, tmp_path):
    got = land(spark, spark.createDataFrame([], "path string, family int, month string"), str(tmp_path / "none"))
    assert got.count() == 0 and {"family", "month", "P1"} <= set(got.columns)


def test_files_of_one_family_may_differ(spark, tmp_path):
    """A late column, int and bigint, text instead of a number."""
    a = _file(spark, str(tmp_path / "a"), 1, "sensor_id int, lat double, lon double, timestamp string, P1 double")
    b = _file(spark, str(tmp_path / "b"), 2, READING.replace("sensor_id int", "sensor_id bigint"))
    c = str(tmp_path / "c")
    spark.createDataFrame([(3, 50.0, 7.0, "2018-01-01 06:00:00", "unknown", "4.5")],
                          READING.replace("P1 double, P2 double", "P1 string, P2 string")).write.parquet(c)
    got = {r.sensor_id: (r.P1, r.P2) for r in read_family(spark, [a, b, c], 2).collect()}
    assert got == {1: (3.0, None), 2: (3.0, 4.0), 3: (None, 4.5)}


def _named(spark, tmp_path, folder, keys, name="data.parquet"):
    """One Parquet file of a given name holding a row for each key."""
    import glob
    spark.createDataFrame([(k, 50.0, 7.0, "2018-01-01 06:00:00", 3.0, 4.0) for k in keys], READING) \
        .coalesce(1).write.mode("overwrite").parquet(str(tmp_path / "w"))
    os.makedirs(tmp_path / folder, exist_ok=True)
    path = str(tmp_path / folder / name)
    os.replace(glob.glob(str(tmp_path / "w" / "*.parquet"))[0], path)
    return path


def test_ledger_keeps_files_of_one_name_apart(spark, tmp_path):
    """Two folders, one file name, two calls: all rows; a re-run adds nothing;
    a changed file replaces its own rows; a new file of a known folder lands."""
    from aerocorr.sources import ledger
    a, b = _named(spark, tmp_path, "a", range(10)), _named(spark, tmp_path, "b", range(100, 107))
    out, schema = str(tmp_path / "landed"), "path string, family int, month string"
    call = lambda *paths: land(spark, spark.createDataFrame([(p, 2, "2018-01") for p in paths], schema), out)
    assert call(a).count() == 10
    assert call(b).count() == 17
    before = {(r.file_path, r.rows, r.call) for r in ledger(spark, out).collect()}
    assert {(r, c) for _, r, c in before} == {(10, 1), (7, 2)}
    assert call(a, b, str(tmp_path / "a")).count() == 17
    assert {(r.file_path, r.rows, r.call) for r in ledger(spark, out).collect()} == before
    _named(spark, tmp_path, "a", range(4))
    _named(spark, tmp_path, "a", [50], "more.parquet")
    got = sorted(r.sensor_id for r in call(str(tmp_path / "a")).select("sensor_id").collect())
    assert got == [0, 1, 2, 3, 50, *range(100, 107)]
    assert sorted((r.rows, r.call) for r in ledger(spark, out).collect()) == [(1, 3), (4, 3), (7, 2)]
    other = land(spark, spark.createDataFrame([(a, 2, "2018-02")], schema), out)
    assert other.groupBy("month").count().count() == 2


def test_a_broken_call_is_landed_again(spark, tmp_path, monkeypatch):
    """Data written, ledger not: the next call lands the same files once."""
    from aerocorr.sources import landing
    a = _named(spark, tmp_path, "a", range(5))
    out, manifest = str(tmp_path / "landed"), spark.createDataFrame([(a, 2, "m")], "path string, family int, month string")
    monkeypatch.setattr(landing, "materialize", lambda *_, **__: 1 / 0)
    try:
        land(spark, manifest, out)
    except ZeroDivisionError:
        pass
    monkeypatch.undo()
    assert spark.read.parquet(out).count() == 5 and landing.ledger(spark, out).count() == 0
    assert land(spark, manifest, out).count() == 5 and landing.ledger(spark, out).count() == 1


def test_write_parquet_keeps_what_stands(spark, tmp_path):
    """The sink refuses a path in use unless told otherwise, and leaves it as it was."""
    path = str(tmp_path / "t")
    assert write_parquet(spark.range(6).withColumn("m", F.col("id") % 2), path, partition_by=["m"]) == path
    assert os.path.isdir(os.path.join(path, "m=1"))
    with pytest.raises(AnalysisException, match="already exists"):
        write_parquet(spark.range(1), path)
    assert spark.read.parquet(path).count() == 6
    write_parquet(spark.range(2), path, mode="overwrite")
    assert spark.read.parquet(path).count() == 2
