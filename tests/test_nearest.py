import random

import pytest
from pyspark.sql import functions as F, Window

from aerocorr.functions.geo import planar_distance
from aerocorr.operators import nearest


def brute_force(pos, sites, radius=None, key="sensor_id"):
    """Test oracle only: every pair, then rank per key."""
    d = pos.crossJoin(sites).withColumn(
        "dist", planar_distance("lat", "lon", "latitude", "longitude")).where(F.col("dist").isNotNull())
    w = Window.partitionBy(key).orderBy("dist")
    top = d.withColumn("_rk", F.rank().over(w)).where("_rk = 1").drop("_rk")
    if radius is not None:
        top = top.where(F.col("dist") < radius)
    return top


def rows(df, cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def lattice(spark, seed, n_pos, n_sites, step=0.25, span=12):
    rnd = random.Random(seed)
    pos = []
    for i in range(n_pos):
        sid = rnd.randrange(max(1, n_pos // 2))  # moved sensors: several positions
        lat = None if rnd.random() < 0.05 else rnd.randrange(-span, span) * step
        pos.append((sid, lat, rnd.randrange(-span, span) * step))
    sites = [(j, rnd.randrange(-span, span) * step, rnd.randrange(-span, span) * step)
             for j in range(n_sites)]
    sites += sites[:3]  # duplicated site rows
    p = spark.createDataFrame(pos, "sensor_id long, lat double, lon double").distinct()
    s = spark.createDataFrame(sites, "site_id long, latitude double, longitude double")
    return p, s


@pytest.mark.parametrize("seed", range(6))
def test_grid_nearest_equals_brute_force(spark, seed):
    p, s = lattice(spark, seed, 60, 25)
    cols = ["sensor_id", "lat", "lon", "site_id", "dist"]
    want = rows(brute_force(p, s.distinct()), cols)
    got = rows(nearest.nearest_sites(p, s), cols)
    assert got == want
    # a deliberately tiny cell forces most sensors through phase 1
    assert rows(nearest.nearest_sites(p, s, cell=0.01), cols) == want


@pytest.mark.parametrize("seed", range(4))
def test_grid_within_equals_brute_force(spark, seed):
    p, s = lattice(spark, 100 + seed, 80, 40)
    cols = ["sensor_id", "lat", "lon", "site_id", "dist"]
    for r in (0.25, 0.6, 1.0):
        assert rows(nearest.nearest_within(p, s, r), cols) == rows(brute_force(p, s.distinct(), r), cols)


def test_radius_is_strict(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 1.0), (3, 0.0, 2.0)],
                              "sensor_id long, lat double, lon double")
    s = spark.createDataFrame([(9, 0.0625, 0.0), (8, 0.0, 1.03125), (7, 0.0, 2.125)],
                              "site_id long, latitude double, longitude double")
    out = rows(nearest.nearest_within(p, s, 0.0625), ["sensor_id", "site_id"])
    assert out == [(2, 8)]  # 0.0625 is not < 0.0625; 0.03125 is; 0.125 is not


def test_ties_kept(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0)], "sensor_id long, lat double, lon double")
    s = spark.createDataFrame([(1, 1.0, 0.0), (2, -1.0, 0.0), (3, 0.0, 2.0)],
                              "site_id long, latitude double, longitude double")
    assert rows(nearest.nearest_sites(p, s), ["site_id"]) == [(1,), (2,)]


def test_moved_sensor_min_over_positions_and_join_back(spark):
    p = spark.createDataFrame([(1, 0.0, 0.0), (1, 5.0, 5.0), (2, None, 1.0)],
                              "sensor_id long, lat double, lon double")
    s = spark.createDataFrame([(5.0, 6.0), (0.0, 3.0)], "latitude double, longitude double")
    md = rows(nearest.min_distance(p, s), ["sensor_id", "min_dist"])
    assert md == [(1, 1.0)]  # sensor 2 only has a NULL position: absent
    jb = rows(nearest.positions_with_min_distance(p, s), ["sensor_id", "lat", "min_dist"])
    assert jb == [(1, 0.0, 1.0), (1, 5.0, 1.0)]


def test_duplicate_sites_do_not_change_min(spark):
    p, s = lattice(spark, 7, 40, 15)
    once = rows(nearest.min_distance(p, s.distinct()), ["sensor_id", "min_dist"])
    twice = rows(nearest.min_distance(p, s.unionByName(s)), ["sensor_id", "min_dist"])
    assert once == twice


def test_adding_a_site_never_increases_min(spark):
    p, s = lattice(spark, 8, 40, 15)
    before = dict(rows(nearest.min_distance(p, s), ["sensor_id", "min_dist"]))
    more = s.unionByName(spark.createDataFrame([(99, 0.1, 0.1)], s.schema))
    after = dict(rows(nearest.min_distance(p, more), ["sensor_id", "min_dist"]))
    assert all(after[k] <= before[k] for k in before)


def test_far_away_sensor_and_empty_sites(spark):
    p = spark.createDataFrame([(1, 1000.0, -2000.0), (2, 0.5, 0.5)],
                              "sensor_id long, lat double, lon double")
    s = spark.createDataFrame([(1, 0.0, 0.0), (2, 1.0, 1.0), (3, 0.0, 1.0)],
                              "site_id long, latitude double, longitude double")
    cols = ["sensor_id", "site_id", "dist"]
    assert rows(nearest.nearest_sites(p, s), cols) == rows(brute_force(p, s), cols)
    empty = s.where("false")
    assert nearest.nearest_sites(p, empty).count() == 0
    assert nearest.nearest_within(p, empty, 1.0).count() == 0


def test_no_cross_join_in_plan(spark):
    p, s = lattice(spark, 3, 30, 10)
    for df in (nearest.nearest_sites(p, s), nearest.nearest_within(p, s, 0.5)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_clustered_sites_and_far_sensors(spark):
    rnd = random.Random(42)
    sites = [(i, 50.0 + rnd.randrange(40) * 0.01, 8.0 + rnd.randrange(40) * 0.01) for i in range(300)]
    sites += [(900, 10.0, -20.0), (901, -30.0, 60.0)]  # isolated sites far from the cluster
    pos = [(k, rnd.uniform(-40, 70), rnd.uniform(-30, 80)) for k in range(40)]
    pos += [(100, 10.5, -19.0), (101, 50.2, 8.1)]
    p = spark.createDataFrame(pos, "sensor_id long, lat double, lon double")
    s = spark.createDataFrame(sites, "site_id long, latitude double, longitude double")
    cols = ["sensor_id", "site_id", "dist"]
    assert rows(nearest.nearest_sites(p, s), cols) == rows(brute_force(p, s), cols)
    got = rows(nearest.min_distance(p, s), ["sensor_id", "min_dist"])
    want = rows(brute_force(p, s).select("sensor_id", F.col("dist").alias("min_dist")).distinct(),
                ["sensor_id", "min_dist"])
    assert got == want


@pytest.mark.parametrize("seed", range(3))
def test_points_on_cell_edges(spark, seed):
    """Lattice step == cell width: every point sits exactly on grid lines."""
    p, s = lattice(spark, 200 + seed, 60, 30, step=0.25, span=8)
    cols = ["sensor_id", "lat", "lon", "site_id", "dist"]
    want = rows(brute_force(p, s.distinct()), cols)
    assert rows(nearest.nearest_sites(p, s, cell=0.25), cols) == want
    assert rows(nearest.nearest_sites(p, s, cell=0.5), cols) == want
    for r in (0.25, 0.5):  # radius equal to lattice distances: strict bound at the edge
        assert rows(nearest.nearest_within(p, s, r), cols) == rows(brute_force(p, s.distinct(), r), cols)


def test_capped_cell_splits_a_hot_cluster(spark):
    rnd = random.Random(9)
    sites = [(i, 50.0 + rnd.random() * 0.05, 8.0 + rnd.random() * 0.05) for i in range(600)]
    sites += [(1000 + i, rnd.uniform(45, 55), rnd.uniform(5, 15)) for i in range(60)]
    s = spark.createDataFrame(sites, "site_id long, latitude double, longitude double")
    prof = nearest.site_profile(s, "latitude", "longitude")
    assert prof["n"] == 660
    start = nearest.auto_cell(prof["n"], prof["lat0"], prof["lat1"], prof["lon0"], prof["lon1"])
    c = nearest.base_cell(s, "latitude", "longitude", prof)
    assert c < start / 2  # the uncapped width would put the cluster in one cell
    occ = (s.groupBy(F.floor(F.col("latitude") / c), F.floor(F.col("longitude") / c)).count()
            .agg(F.max("count")).first()[0])
    assert occ <= nearest.CELL_CAP
    p = spark.createDataFrame([(k, 50.0 + rnd.uniform(-1, 1), 8.0 + rnd.uniform(-1, 1)) for k in range(30)],
                              "sensor_id long, lat double, lon double")
    cols = ["sensor_id", "site_id", "dist"]
    assert rows(nearest.nearest_sites(p, s), cols) == rows(brute_force(p, s), cols)


def test_radius_search_adapts_to_a_dense_cluster(spark):
    rnd = random.Random(17)
    sites = [(i, 50.0 + rnd.random() * 0.05, 8.0 + rnd.random() * 0.05) for i in range(500)]
    sites += [(1000 + i, rnd.uniform(45, 55), rnd.uniform(5, 15)) for i in range(40)]
    s = spark.createDataFrame(sites, "site_id long, latitude double, longitude double")
    p = spark.createDataFrame([(k, 50.0 + rnd.uniform(-2, 2), 8.0 + rnd.uniform(-2, 2)) for k in range(40)],
                              "sensor_id long, lat double, lon double")
    cols = ["sensor_id", "site_id", "dist"]
    assert nearest.base_cell(s, "latitude", "longitude",
                             nearest.site_profile(s, "latitude", "longitude")) < 0.1
    for r in (0.05, 0.7, 3.0):
        assert rows(nearest.nearest_within(p, s, r), cols) == rows(brute_force(p, s, r), cols)


def test_no_positions(spark):
    p = spark.createDataFrame([], "sensor_id long, lat double, lon double")
    s = spark.createDataFrame([(1.0, 2.0)], "latitude double, longitude double")
    assert nearest.min_distance(p, s).count() == 0
    assert nearest.nearest_sites(p, s).count() == 0
    assert nearest.nearest_within(p, s, 0.5).count() == 0


def _pairs_met(spark, monkeypatch, positions, sites):
    """Rows (position, fine cell) the descent leaves, weighted by the cell's sites."""
    met = []
    plain = nearest._descend

    def watched(asked, st, c0, ext, keys, lat, lon, site_lat, site_lon):
        out = plain(asked, st, c0, ext, keys, lat, lon, site_lat, site_lon)
        met.append(out.join(nearest._with_cell(st, c0, site_lat, site_lon), ["_cx", "_cy"]).count())
        return out
    monkeypatch.setattr(nearest, "_descend", watched)
    p = spark.createDataFrame(positions, "sensor_id long, lat double, lon double")
    s = spark.createDataFrame(sites, "site_id long, latitude double, longitude double")
    got = {}
    for r in nearest.nearest_sites(p, s).collect():
        got.setdefault(r.sensor_id, set()).add(r.site_id)
    for i, a, b in positions:
        d = {j: ((a - y) * (a - y) + (b - x) * (b - x)) ** 0.5 for j, y, x in sites}
        assert got[i] == {j for j in d if d[j] == min(d.values())}
    return sum(met)


@pytest.mark.parametrize("case", ["far sensors", "stray site", "huge coordinates"])
def test_far_geometry_meets_few_pairs(spark, monkeypatch, case):
    rng = random.Random(4)
    sites = [(i, 47.5 + 6.4 * rng.random(), 6 + 8.6 * rng.random()) for i in range(1000)]
    positions = [(i, 47.5 + 6.4 * rng.random(), 6 + 8.6 * rng.random()) for i in range(100)]
    if case == "far sensors":
        positions = [(i, 40 + rng.random(), -75 + rng.random()) for i in range(100)]
    elif case == "stray site":
        sites.append((5000, 99999.0, 99999.0))
    else:
        positions += [(900, 1e20, 3.0), (901, -1e16, 1e16)]
    assert _pairs_met(spark, monkeypatch, positions, sites) < 0.05 * len(sites) * len(positions)
