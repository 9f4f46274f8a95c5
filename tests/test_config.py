from aerocorr.config import cluster_conf, ensure_checkpoint_dir, work_dir


def test_cluster_conf_scales_with_input():
    small = cluster_conf(10 << 30, 64)
    big = cluster_conf(100 << 40, 8000)
    assert int(big["_expected_scan_tasks"]) == 204800
    assert int(big["spark.sql.shuffle.partitions"]) == 409_600
    assert int(small["spark.sql.shuffle.partitions"]) == 192
    assert big["spark.sql.adaptive.skewJoin.enabled"] == "true"


def test_work_dir_under_checkpoint_dir(spark):
    base = ensure_checkpoint_dir(spark)
    a, b = work_dir(spark, "t"), work_dir(spark, "t")
    assert a.startswith(base) and a != b
