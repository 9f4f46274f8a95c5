import math

from pyspark.sql import functions as F

from aerocorr import schemas
from aerocorr.operators import clean

NAN = float("nan")


def test_outlier_filter_bound(spark):
    df = spark.createDataFrame([(1, 4999.99), (2, 5000.0), (3, None), (4, NAN), (5, -1.0)],
                               "id int, P1 double")
    df = df.withColumn("P2", F.lit(1.0))
    kept = sorted(r.id for r in clean.outlier_filter(df).collect())
    assert kept == [1, 5]


def test_outlier_filter_is_pushed_to_scan(spark, tmp_path):
    p = str(tmp_path / "r")
    spark.range(10).select(F.col("id").cast("double").alias("P1"),
                           F.col("id").cast("double").alias("P2")).write.parquet(p)
    plan = clean.outlier_filter(spark.read.parquet(p))._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "LessThan(P1,5000.0)" in plan


def test_daytime_filter_hours(spark):
    rows = [(1, "2018-01-01 05:59:59"), (2, "2018-01-01 06:00:00"), (3, "2018-01-01T17:59:59"),
            (4, "2018-01-01 18:00:00"), (5, "not a time"), (6, None)]
    df = spark.createDataFrame(rows, "id int, timestamp string")
    out = clean.daytime_filter(df).collect()
    assert sorted((r.id, r.hour_of_day) for r in out) == [(2, 6), (3, 17)]


def test_daytime_filter_typed_timestamp(spark):
    df = spark.createDataFrame([(1, "2018-01-01 06:00:00"), (2, "2018-01-01 18:00:00")],
                               "id int, t string").select("id", F.to_timestamp("t").alias("timestamp"))
    assert [r.id for r in clean.daytime_filter(df, hour_col=None).collect()] == [1]


def test_avg_particulates_null(spark):
    df = spark.createDataFrame([(1.0, 3.0), (None, 3.0)], "P1 double, P2 double")
    vals = [r.avg_p for r in df.select(clean.avg_particulates(df)).collect()]
    assert vals[0] == 2.0 and vals[1] is None


POLICY_ROWS = [(1, None, 1.0), (2, 1.0, None), (3, None, None), (4, 1.0, 1.0), (5, NAN, 1.0)]


def _policy_df(spark):
    return spark.createDataFrame(POLICY_ROWS, "id int, a double, b double")


def test_null_policy_any(spark):
    assert sorted(r.id for r in clean.drop_any_missing(_policy_df(spark)).collect()) == [4]


def test_null_policy_either(spark):
    out = clean.keep_if_any_present(_policy_df(spark), ["a", "b"]).collect()
    assert sorted(r.id for r in out) == [1, 2, 4, 5]


def test_null_policy_columns(spark):
    out = clean.keep_if_all_present(_policy_df(spark), ["a", "b"]).collect()
    assert sorted(r.id for r in out) == [4, 5]


def test_complete_cases_drops_nan(spark):
    out = clean.complete_cases(_policy_df(spark), ["a", "b"]).collect()
    assert [r.id for r in out] == [4]


def test_dedupe_by_key_keeps_smallest_position(spark):
    df = spark.createDataFrame([(1, 50.0, 7.0), (1, 49.0, 9.0), (1, 49.0, 8.0), (2, 51.0, 6.0)],
                               "sensor_id long, lat double, lon double")
    out = sorted(tuple(r) for r in clean.dedupe_by_key(df, "sensor_id", ["lat", "lon"]).collect())
    assert out == [(1, 49.0, 8.0), (2, 51.0, 6.0)]


def test_unify_families_schema_and_bag_semantics(spark):
    f1 = spark.createDataFrame([(1, 50.0, 7.0, 1.0, "x", 2.0)],
                               "sensor_id int, lat double, lon double, P1 double, durP1 string, P2 double")
    f2 = spark.createDataFrame([(2, 51.0, 8.0, 3.0, 4.0)] * 2,
                               "sensor_id int, lat double, lon double, P1 double, P2 double")
    f3 = spark.createDataFrame([(3, 52.0, 9.0, 5.0, 6.0, 0.5)],
                               "sensor_id bigint, lat double, lon double, P1 double, P2 double, P0 double")
    u = clean.unify_families({1: f1, 2: f2, 3: f3})
    assert [(f.name, f.dataType) for f in u.schema] == \
        [(f.name, f.dataType) for f in schemas.READING_SCHEMA]
    rows = u.collect()
    assert len(rows) == 4
    by = {r.family: r for r in rows}
    assert by[1].durP1 == "x" and by[2].P0 is None and by[3].P0 == 0.5
    assert clean.unify_families({1: f1, 2: f2, 3: f3}, distinct=True).count() == 3


def test_distinct_positions(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, 5.0), (1, 1.0, 2.0, 6.0), (1, 1.5, 2.0, 6.0)],
                               "sensor_id long, lat double, lon double, P1 double")
    assert clean.distinct_positions(df).count() == 2
    assert not any(math.isnan(r.lat) for r in clean.distinct_positions(df).collect())
