import pytest
from pyspark.sql import functions as F

from aerocorr.operators import sampling


@pytest.mark.parametrize("total,n", [(0, 5), (3, 5), (5, 5), (200, 5), (2000, 37)])
def test_exact_sample_equals_full_sort(spark, total, n):
    df = spark.range(total).withColumnRenamed("id", "k").withColumn("v", F.col("k") * 2)
    got = [r.k for r in sampling.exact_sample(df, n, ["k"]).collect()]
    want = [r.k for r in df.orderBy(sampling.sample_hash(["k"]), "k").limit(n).collect()]
    assert sorted(got) == sorted(want)
    assert len(got) == min(n, total)


def test_exact_sample_plan_never_sorts_everything(spark):
    df = spark.range(5000).withColumnRenamed("id", "k")
    out = sampling.exact_sample(df, 10, ["k"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Scan ExistingRDD" in plan and "Range" not in plan  # orders the checkpointed slice only
    assert sampling.exact_sample(df, 10, ["k"], expected_rows=50).count() == 10  # bad estimate: still exact


@pytest.mark.parametrize("total", [0, 3, 5000])
def test_random_sample_bounded(spark, total):
    df = spark.range(total)
    out = sampling.random_sample(df, 100, seed=3)
    assert out.count() == min(100, total)
    assert sampling.random_sample(df, 100, seed=3).count() == out.count()  # seeded


def test_random_sample_favours_no_partition(spark):
    """Over many seeds the first and the last of eight partitions give alike."""
    df = spark.range(0, 8_000, 1, 8)
    first = last = 0
    for seed in range(30):
        ids = [r.id for r in sampling.random_sample(df, 80, seed=seed).collect()]
        assert len(set(ids)) == 80
        first += sum(i < 1_000 for i in ids)
        last += sum(i >= 7_000 for i in ids)
    assert 220 < first < 380 and 220 < last < 380  # 300 each, standard deviation 16
