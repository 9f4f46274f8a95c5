import pytest
from pyspark.sql import functions as F

from aerocorr import schemas
from aerocorr.operators.stats import grouped_moments
from aerocorr.streaming import read_snapshot, start_landing, start_position_moments, stream_readings


def _write(spark, path, rows):
    schema = schemas.FAMILY_SCHEMAS[2]
    df = spark.createDataFrame(
        [(s, "hpm", 1, lat, 7.0, ts, p1, p2) for s, lat, ts, p1, p2 in rows], schema)
    df.coalesce(1).write.mode("append").parquet(path)


def test_moments_accumulate_across_runs(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "m"), str(tmp_path / "ck")
    first = [(1, 50.0, "2018-01-01 07:00:00", 10.0, 20.0), (1, 50.0, "2018-01-01 03:00:00", 1.0, 1.0),
             (2, 51.0, "2018-01-01 12:00:00", 6000.0, 2.0)]
    second = [(1, 50.0, "2018-01-02 08:00:00", 30.0, 40.0), (3, 52.0, "2018-01-02 09:00:00", 5.0, 5.0)]
    _write(spark, src, first)
    start_position_moments(spark, stream_readings(spark, {2: src}), out, ckpt).awaitTermination()
    snap1 = {r.sensor_id: (r._n, r._mean) for r in read_snapshot(spark, out).collect()}
    assert snap1 == {1: (1, 15.0), 2: (0, None)}
    _write(spark, src, second)
    start_position_moments(spark, stream_readings(spark, {2: src}), out, ckpt).awaitTermination()
    got = {r.sensor_id: (r._n, r._mean, r._var) for r in read_snapshot(spark, out).collect()}
    assert got[1][:2] == (2, 25.0) and got[1][2] == pytest.approx(100.0)
    assert got[3][:2] == (1, 5.0) and got[2][0] == 0


def test_landing_stream_exactly_once(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "landed"), str(tmp_path / "ck")
    _write(spark, src, [(1, 50.0, "2018-01-01 07:00:00", 10.0, 20.0)])
    start_landing(spark, {2: src}, out, ckpt).awaitTermination()
    start_landing(spark, {2: src}, out, ckpt).awaitTermination()  # nothing new: no duplicates
    _write(spark, src, [(1, 50.0, "2018-02-01 07:00:00", 11.0, 21.0)])
    start_landing(spark, {2: src}, out, ckpt).awaitTermination()
    landed = spark.read.parquet(out)
    assert sorted((r.month, r.P1) for r in landed.select("month", "P1").collect()) == \
        [("2018-01", 10.0), ("2018-02", 11.0)]
    assert set(r.family for r in landed.select("family").collect()) == {2}


def test_stream_and_batch_moments_agree(spark, tmp_path):
    src, out, ckpt = str(tmp_path / "src"), str(tmp_path / "m"), str(tmp_path / "ck")
    rows = [(i % 4, 50.0 + i % 2, f"2018-01-01 {6 + i % 12:02d}:00:00", float(i), float(2 * i))
            for i in range(40)]
    _write(spark, src, rows)
    start_position_moments(spark, stream_readings(spark, {2: src}), out, ckpt,
                           daytime=False).awaitTermination()
    batch = grouped_moments(spark.read.parquet(src), ["sensor_id", "lat", "lon"],
                            (F.col("P1") + F.col("P2")) / 2)
    want = sorted((r.sensor_id, r.lat, r._n, round(r._mean, 9)) for r in batch.collect())
    got = sorted((r.sensor_id, r.lat, r._n, round(r._mean, 9)) for r in read_snapshot(spark, out).collect())
    assert got == want


def _feed(spark, path, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


POS, SITE = "sensor_id int, lat double, lon double", "site int, latitude double, longitude double"


def _batch_nearest(spark, positions, sites):
    from aerocorr.operators.nearest import nearest_sites
    near = nearest_sites(spark.createDataFrame(positions, POS).distinct(), spark.createDataFrame(sites, SITE))
    return sorted((r.sensor_id, r.lat, r.lon, r.site, r.dist) for r in near.collect())


def test_nearest_stream_equals_batch_after_every_batch(spark, tmp_path):
    """Sensors that come, move, repeat or lack a position; sites that come
    before, with and after them, tie, repeat, beat few keys or lie far away."""
    import random
    from aerocorr.streaming import read_nearest, start_nearest
    rnd, nan = random.Random(5), float("nan")
    p, s, out, ck = (str(tmp_path / d) for d in ("p", "s", "out", "ck"))
    steps = [
        ([], [(1, 50.0, 8.0), (2, 52.0, 9.0), (2, 52.0, 9.0), (3, None, 9.0)]),
        ([(i, 48.0 + rnd.random() * 6, 6.0 + rnd.random() * 8) for i in range(40)] + [(90, nan, 7.0)], []),
        ([(3, 47.0, 6.0), (3, 47.0, 6.0), (41, 51.0, 8.5)], [(4, 51.0, 8.0), (5, 51.0, 9.0)]),
        ([], [(100 + i, 48.0 + rnd.random() * 6, 6.0 + rnd.random() * 8) for i in range(90)]),
        ([(42, -60.0, 170.0)], [(300, -50.0, 100.0), (301, 1e9, 1e9)]),
        ([], []),
    ]
    seen_p, seen_s = [], []
    for positions, sites in steps:
        _feed(spark, p, positions, POS)
        _feed(spark, s, sites, SITE)
        seen_p, seen_s = seen_p + positions, seen_s + sites
        start_nearest(spark, spark.readStream.schema(POS).parquet(p), spark.readStream.schema(SITE).parquet(s),
                      out, ck).awaitTermination()
        got = read_nearest(spark, out)
        assert sorted((r.sensor_id, r.lat, r.lon, r.site, r.dist) for r in got.collect()) == \
            _batch_nearest(spark, seen_p, seen_s)


def test_nearest_stream_rewrites_only_touched_keys_and_skips_a_replay(spark, tmp_path):
    from aerocorr.sources.commits import read_commit, versions
    from aerocorr.streaming import read_nearest, start_nearest
    p, s, out, ck = (str(tmp_path / d) for d in ("p", "s", "out", "ck"))
    run = lambda c=ck: start_nearest(
        spark, spark.readStream.schema(POS).parquet(p), spark.readStream.schema(SITE).parquet(s), out, c).awaitTermination()
    _feed(spark, p, [(i, 48.0 + i / 10, 8.0) for i in range(50)], POS)
    _feed(spark, s, [(1, 48.0, 8.1), (2, 53.0, 8.1)], SITE)
    run()
    _feed(spark, s, [(3, 50.0, 8.0)], SITE)
    run()
    last = read_commit(spark, out)["nearest"][-1]
    touched = {r.sensor_id for r in spark.read.parquet(f"{out}/{last}").collect()}
    assert 20 in touched and 0 not in touched and 49 not in touched and len(touched) < 40
    before, known = sorted(map(tuple, read_nearest(spark, out).collect())), versions(spark, out)
    run(str(tmp_path / "replay"))  # batch 0 again, from another checkpoint: already committed
    assert sorted(map(tuple, read_nearest(spark, out).collect())) == before and versions(spark, out) == known


def test_nearest_stream_compacts_and_drops_old_folders(spark, tmp_path, monkeypatch):
    import os
    from aerocorr.sources.commits import read_commit
    from aerocorr.streaming import nearest as N
    monkeypatch.setattr(N, "COMPACT", 2)
    p, s, out, ck = (str(tmp_path / d) for d in ("p", "s", "out", "ck"))
    seen = []
    _feed(spark, s, [(1, 48.0, 8.1), (2, 53.0, 8.1)], SITE)
    for i in range(4):
        _feed(spark, p, [(i, 48.0 + i, 8.0)], POS)
        seen.append((i, 48.0 + i, 8.0))
        N.start_nearest(spark, spark.readStream.schema(POS).parquet(p), spark.readStream.schema(SITE).parquet(s),
                        out, ck).awaitTermination()
    state = read_commit(spark, out)
    assert all(len(state[part]) <= 2 for part in N.PARTS)
    got = sorted((r.sensor_id, r.lat, r.lon, r.site, r.dist) for r in N.read_nearest(spark, out).collect())
    assert got == _batch_nearest(spark, seen, [(1, 48.0, 8.1), (2, 53.0, 8.1)])
    named = {f for v in (state["version"], state["version"] - 1) for part in N.PARTS
             for f in read_commit(spark, out, v)[part]}
    assert {f for f in os.listdir(out) if not f.startswith("_")} == named


def test_settlement_stream_equals_the_matrix_of_distinct_rows(spark, tmp_path):
    from aerocorr.operators.stats import correlation_matrix
    from aerocorr.streaming import settlement_matrix, start_settlement
    src, out, ck = (str(tmp_path / d) for d in ("src", "out", "ck"))
    schema = "sensor_id int, P1 double, P2 double"
    near = spark.createDataFrame([(1, 1000, 20), (1, 500, None), (2, 90000, 5), (2, 80000, 7), (3, 7, 300)],
                                 "sensor_id int, population long, elevation int")
    parts = [[(1, 0.0, -0.0), (1, -0.0, -0.0), (2, 3.0, 4.0)], [(2, 3.0, 4.0), (3, 9.0, 8.0), (9, 1.0, 1.0)], [],
             [(3, 6000.0, 1.0), (3, None, 1.0), (3, float("nan"), 1.0), (1, 30.0, 41.0)]]
    seen = []
    for rows in parts:
        _feed(spark, src, rows, schema)
        seen += rows
        start_settlement(spark, spark.readStream.schema(schema).parquet(src), near, out, ck).awaitTermination()
        ok = spark.createDataFrame(seen, schema).where("P1 < 5000 AND P2 < 5000")
        triples = (ok.select("sensor_id", ((F.col("P1") + F.col("P2")) / 2 + 0.0).alias("avg_p")).join(near, "sensor_id")
                   .select("avg_p", "population", "elevation").distinct())
        want = {(r.col_a, r.col_b): (r.r, r.n) for r in
                correlation_matrix(triples, ["avg_p", "population", "elevation"]).collect()}
        got = {(r.col_a, r.col_b): (r.r, r.n) for r in settlement_matrix(spark, out).collect()}
        assert got.keys() == want.keys()
        for k, (r, n) in want.items():
            assert got[k][1] == n and got[k][0] == (pytest.approx(r, abs=1e-12) if r is not None else None)


def test_merged_moments_equal_whole(spark):
    from aerocorr.operators.stats import co_moments, merge_moments
    rows = [(float(i % 7), 1e6 + i * i, -float(i)) for i in range(60)]
    cols = ["a", "b", "c"]
    df = lambda part: spark.createDataFrame(part, "a double, b double, c double")
    whole = co_moments(df(rows), cols)
    merged = co_moments(df([]), cols)
    for at in (0, 1, 20, 59):
        merged = merge_moments(merged, co_moments(df(rows[at:{0: 1, 1: 20, 20: 59, 59: 60}[at]]), cols))
    assert merged["n"] == 60 and merged["mean"] == pytest.approx(whole["mean"])
    for x, y in zip(merged["m"], whole["m"]):
        assert x == pytest.approx(y, rel=1e-9, abs=1e-6)
