import pytest
from pyspark.sql import functions as F

from aerocorr.operators import joins


@pytest.mark.parametrize("kind", ["int", "bigint", "string", "decimal(12,0)"])
def test_key_filter_keeps_every_match_and_few_others(spark, kind):
    big = spark.range(0, 40_000, 1, 4).select(F.col("id").cast(kind).alias("k"), "id")
    keys = big.where("id % 20 = 3").select("k").union(spark.range(1).select(F.lit(None).cast(kind).alias("k")))
    got = joins.key_filter(big, keys, "k")
    assert got.join(keys, "k", "left_semi").count() == 2_000
    assert got.count() < 2_000 + 0.03 * 38_000


def test_key_filter_over_no_keys_one_key_and_nulls(spark):
    big = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "k int, v string")
    none = spark.createDataFrame([], "k int")
    assert joins.key_filter(big, none, "k").count() == 0
    one = spark.createDataFrame([(2,), (2,)], "k int")
    assert [r.v for r in joins.key_filter(big, one, "k").collect()] == ["b"]


def test_key_filter_leaves_keys_alone_whose_hashes_may_differ(spark):
    big = spark.createDataFrame([(0.0,), (-0.0,), (5.0,)], "k double")
    assert joins.key_filter(big, spark.createDataFrame([(0.0,)], "k double"), "k").count() == 3
    assert joins.key_filter(big, spark.createDataFrame([(0,)], "k int"), "k").count() == 3




def test_join_beyond_the_bound_filters_before_it_shuffles(spark):
    big = spark.range(0, 5_000, 1, 4).select((F.col("id") % 500).alias("k"), F.col("id").alias("v"))
    attrs = spark.range(25).select(F.col("id").alias("k"), F.lit("x" * 50).alias("a"))
    want = sorted(tuple(r) for r in big.join(attrs, "k").collect())
    for bounds in ({"max_broadcast_rows": 0}, {"max_broadcast_bytes": 100}, {"max_broadcast_rows": 0, "salt_buckets": 4}):
        out = joins.join_attributes(big, attrs, "k", **bounds)
        assert sorted(tuple(r) for r in out.collect()) == want
        assert "getbit" in out._jdf.queryExecution().optimizedPlan().toString().lower()
    left = joins.join_attributes(big, attrs, "k", max_broadcast_rows=0, how="left")
    assert left.count() == 5_000  # unmatched rows stay


def test_broadcast_bound_counts_bytes(spark):
    wide = spark.range(100).select("id", F.repeat(F.lit("é"), 1_000).alias("s"),
                                   F.array(F.lit("ab"), F.lit("cd")).alias("l"))
    n, size = joins.probe_size(wide, 1_000)
    assert n == 100 and 200_000 < size < 220_000
    hinted = lambda df: "hint" in df._jdf.queryExecution().logical().toString().lower()
    assert hinted(joins.size_checked_broadcast(wide, max_bytes=1 << 20))
    assert not hinted(joins.size_checked_broadcast(wide, max_bytes=1 << 16))
    assert joins.probe_size(spark.createDataFrame([], "k int"), 5) == (0, 0)
