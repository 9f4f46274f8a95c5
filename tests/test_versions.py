"""Versioned tables, commits and the geocode cache."""

import pytest
from pyspark.sql import functions as F

from aerocorr.plans import studies
from aerocorr.sources import GeocodeCache, expire, fingerprint, open_version, refresh_changed
from aerocorr.sources.commits import read_commit, versions, write_commit


def test_commits_are_numbered_and_guarded(spark, tmp_path):
    root = str(tmp_path / "t")
    assert versions(spark, root) == [] and read_commit(spark, root) is None
    assert write_commit(spark, root, {"folder": "a"}, 0) == 1
    assert write_commit(spark, root, {"folder": "b"}, 1) == 2
    with pytest.raises(RuntimeError):  # another writer was faster
        write_commit(spark, root, {"folder": "c"}, 1)
    assert read_commit(spark, root) == {"folder": "b", "version": 2}
    assert read_commit(spark, root, 1)["folder"] == "a"
    with pytest.raises(ValueError):
        read_commit(spark, root, 9)


def test_fingerprint_is_of_the_bag(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "k int, v string")
    assert fingerprint(a) == fingerprint(a.repartition(3).select("v", "k"))
    assert len({fingerprint(d) for d in (a, a.distinct(), a.limit(0), a.na.fill("x"))}) == 4


def _refresh(spark, path, rows, side, seen, **how):
    def compute(df):
        seen.append(sorted({r.k for r in df.collect()}, key=str))
        return df.crossJoin(side.agg(F.sum("s").alias("s"))).withColumn("y", F.col("v") + F.col("s")).drop("s")
    df = refresh_changed(spark, path, spark.createDataFrame(rows, "k int, v int"), side, compute, "k", **how)
    return df, sorted((tuple(r) for r in df.collect()), key=str)


def test_only_changed_keys_are_computed(spark, tmp_path):
    path, seen = str(tmp_path / "t"), []
    side, other = (spark.createDataFrame([(s,)], "s int") for s in (10, 20))
    old, got = _refresh(spark, path, [(1, 1), (1, 2), (2, 5), (3, 7)], side, seen)
    assert got == [(1, 1, 11), (1, 2, 12), (2, 5, 15), (3, 7, 17)] and seen == [[1, 2, 3]]
    _, got = _refresh(spark, path, [(3, 7), (2, 5), (1, 2), (1, 1), (1, 1)], side, seen)  # the same rows
    assert len(got) == 4 and len(seen) == 1 and versions(spark, path) == [1]
    _, got = _refresh(spark, path, [(1, 1), (2, 5), (4, 9)], side, seen)  # one row less, a key gone, a new one
    assert got == [(1, 1, 11), (2, 5, 15), (4, 9, 19)] and seen[1:] == [[1, 4]]
    assert sorted(tuple(r) for r in old.collect()) == [(1, 1, 11), (1, 2, 12), (2, 5, 15), (3, 7, 17)]  # a reader in the meantime
    _, got = _refresh(spark, path, [(1, 1)], other, seen)  # the other side changed: all
    assert got == [(1, 1, 21)] and seen[2:] == [[1]]
    _, got = _refresh(spark, path, [(8, 8)], other, seen, refresh=False)
    assert got == [(1, 1, 21)]
    assert open_version(spark, path, 1).count() == 4
    assert expire(spark, path, keep=1) == [1, 2] and open_version(spark, path).count() == 1


def test_null_keys_and_empty_tables(spark, tmp_path):
    path, seen = str(tmp_path / "t"), []
    side = spark.createDataFrame([(1,)], "s int")
    assert _refresh(spark, path, [], side, seen)[1] == []
    assert _refresh(spark, path, [(None, 3)], side, seen)[1] == [(None, 3, 4)]
    assert _refresh(spark, path, [(None, 3), (1, None)], side, seen)[1] == [(1, None, None), (None, 3, 4)]
    assert seen[1:] == [[None], [1]]


def test_nearest_table_searches_changed_sensors_only(spark, tmp_path, monkeypatch):
    schema = "sensor_id long, lat double, lon double, timestamp string, P1 double, P2 double"
    row = lambda i, lon: (i, 50.0, lon, "2018-01-01 08:00:00", 1.0, 2.0)
    sites = spark.createDataFrame([(50.0, 8.0)], "latitude double, longitude double")
    path, seen = str(tmp_path / "near"), []
    search = studies.positions_with_min_distance
    monkeypatch.setattr(studies, "positions_with_min_distance", lambda pos, *a, **k: (
        seen.append(pos.select("sensor_id").distinct().count()), search(pos, *a, **k))[1])
    table = lambda rows, **k: sorted(tuple(r) for r in studies.remoteness_table(
        spark.createDataFrame(rows, schema), sites, path=path, refresh="changed", **k).collect())
    first = [row(i, 7.0 + i / 8) for i in range(4)]
    assert table(first) == [(i, 50.0, 7.0 + i / 8, 1 - i / 8) for i in range(4)]
    moved = first + [row(2, 8.5), row(9, 6.0)]
    assert table(moved) == sorted([(i, 50.0, 7.0 + i / 8, 1 - i / 8) for i in (0, 1, 3)]
                                  + [(2, 50.0, 7.25, 0.5), (2, 50.0, 8.5, 0.5), (9, 50.0, 6.0, 2.0)])
    assert table(moved) and seen == [4, 2]


GOOD = '{"osm_id": 7, "address": {"country": "%s"}}'


def _ask(spark, cache, answers):
    cache.add(spark.createDataFrame(answers, "lat double, lon double, body string"))
    return sorted((r.lat, r.ok, r.country, r.attempt) for r in cache.entries().collect())


def test_cache_answers_once_and_retries_failures(spark, tmp_path):
    pos = spark.createDataFrame([(1.0, 1.0), (2.0, 1.0), (2.0, 1.0), (3.0, 1.0), (None, 1.0)], "lat double, lon double")
    cache = GeocodeCache(spark, str(tmp_path / "c"), max_attempts=2, buckets=2, fan=3)
    todo = lambda c: sorted(r.lat for r in c.worklist(pos).collect())
    assert todo(cache) == [1.0, 2.0, 3.0] and cache.answers().count() == 0
    got = _ask(spark, cache, [(1.0, 1.0, GOOD % "DE"), (2.0, 1.0, '{"error": "x"}'), (2.0, 1.0, None), (None, 1.0, GOOD % "DE")])
    assert got == [(1.0, True, "DE", 1), (2.0, False, None, 1)] and todo(cache) == [2.0, 3.0]
    # an answered coordinate stays as it is; a failed one is tried again; conflicting answers: the smallest
    got = _ask(spark, cache, [(1.0, 1.0, GOOD % "FR"), (2.0, 1.0, "no json"), (3.0, 1.0, GOOD % "NL"), (3.0, 1.0, GOOD % "BE")])
    assert got == [(1.0, True, "DE", 1), (2.0, False, None, 2), (3.0, True, "BE", 1)] and todo(cache) == []
    cache.close()
    later = GeocodeCache(spark, str(tmp_path / "c"), max_attempts=3, fan=3)  # another session, one more try
    assert todo(later) == [2.0]
    got = _ask(spark, later, [(2.0, 1.0, GOOD % "")])  # answered, without a country
    assert got[1] == (2.0, True, None, 3) and len(later.state["batches"]) == 1  # merged
    assert sorted((r.lat, r.country) for r in later.answers().collect()) == [(1.0, "DE"), (2.0, None), (3.0, "BE")]
    later.close()


def test_failed_for_good_is_kept_open(spark, tmp_path):
    cache = GeocodeCache(spark, str(tmp_path / "c"), max_attempts=1)
    _ask(spark, cache, [(1.0, 1.0, "{")])
    assert [tuple(r) for r in cache.answers().collect()] == [(1.0, 1.0, "error")]
    cache.close()
