import random

import pytest

from aerocorr.plans import studies


def _m(df):
    return {(r.col_a, r.col_b): (r.r, r.n) for r in df.collect()}


def test_remoteness_strategies_agree_on_moved_sensors(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(400):
        s = rnd.randrange(25)
        lat = None if rnd.random() < 0.03 else 48 + (s % 5) + rnd.choice([0.0, 0.5])
        ts = f"2018-01-01 {rnd.randrange(24):02d}:00:00" if rnd.random() > 0.02 else "garbage"
        p1 = rnd.choice([rnd.uniform(0, 100), 6000.0, None])
        rows.append((s, lat, 7.0 + s % 3, ts, p1, rnd.uniform(0, 100)))
    rd = spark.createDataFrame(rows, "sensor_id long, lat double, lon double, timestamp string, "
                                     "P1 double, P2 double")
    sites = spark.createDataFrame([(48.2, 7.1), (50.9, 8.3), (52.0, 9.9)],
                                  "latitude double, longitude double")
    a = _m(studies.remoteness_study(rd, sites, strategy="pre-aggregate"))
    b = _m(studies.remoteness_study(rd, sites, strategy="join"))
    for k in b:
        assert a[k][1] == b[k][1]
        assert (a[k][0] is None and b[k][0] is None) or a[k][0] == pytest.approx(b[k][0], abs=1e-12)


def test_settlement_weights(spark):
    """Ten readings of a sensor between two tied cities weigh ten, not twenty."""
    rd = spark.createDataFrame([(1, 50.0, 7.0, "2018-01-01 08:00:00", float(i), 2.0) for i in range(10)]
                               + [(2, 60.0, 7.0, "2018-01-01 08:00:00", float(i), 3.0) for i in range(4)],
                               "sensor_id long, lat double, lon double, timestamp string, P1 double, P2 double")
    cities = spark.createDataFrame([(5, 50.25, 100, 10), (4, 49.75, 200, 20), (6, 60.0, 300, 30)],
                                   "geonameid int, latitude double, population long, dem int").selectExpr(
        "geonameid", "'n' AS name", "'n' AS asciiname", "'' AS alternatenames", "latitude", "7.0D AS longitude",
        "population", "dem")
    n = lambda **k: _m(studies.settlement_study(rd, cities, radius=0.5, **k))[("avg_p", "population")][1]
    assert n(distinct_rows=False) == 14 and n(distinct_rows=False, one_row_per_sensor=False) == 24
    assert n() == n(strategy="pre-aggregate") == 24
    with pytest.raises(ValueError):
        studies.settlement_study(rd, cities, distinct_rows=False, strategy="pre-aggregate")


def test_saved_tables_are_reloaded_not_rebuilt(spark, tmp_path):
    rd = spark.createDataFrame([(1, 50.0, 7.0, "2018-01-01 08:00:00", 1.0, 2.0)],
                               "sensor_id long, lat double, lon double, timestamp string, P1 double, P2 double")
    sites = spark.createDataFrame([(50.0, 8.0)], "latitude double, longitude double")
    other = spark.createDataFrame([(50.0, 7.5)], "latitude double, longitude double")
    path = str(tmp_path / "near")
    dist = lambda s, **k: studies.remoteness_table(rd, s, path=path, **k).first().min_dist
    assert dist(sites, refresh=False) == 1.0  # nothing there yet: built
    assert dist(other, refresh=False) == 1.0  # reloaded
    assert dist(other) == 0.5


def test_settlement_sample_serves_the_matrix_too(spark, tmp_path):
    """The exported sample holds the study's rows; the matrix is the same with it."""
    rd = spark.createDataFrame([(s, 50.0 + s, 7.0, "2018-01-01 08:00:00", float(i), 2.0)
                                for s in range(4) for i in range(10)],
                               "sensor_id long, lat double, lon double, timestamp string, P1 double, P2 double")
    cities = spark.createDataFrame([(s, "c", "c", "", 50.01 + s, 7.0, float(100 * s + s * s), 10 + s) for s in range(4)],
                                   "geonameid long, name string, asciiname string, alternatenames string, "
                                   "latitude double, longitude double, population double, dem long")
    path = str(tmp_path / "sample")
    got = _m(studies.settlement_study(rd, cities, sample_path=path, sample_rows=15))
    assert got == _m(studies.settlement_study(rd, cities))
    rows = {tuple(r) for r in studies.settlement_rows(rd, cities).collect()}
    sample = spark.read.option("header", True).option("sep", ";").schema(
        "avg_p double, population double, elevation long").csv(path)
    found = [tuple(r) for r in sample.collect()]
    assert len(rows) == 40 and len(found) == 15 == len(set(found)) and set(found) <= rows
