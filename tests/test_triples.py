import itertools
import random
import re

import pytest

from aerocorr.operators.triples import attached_rows
from aerocorr.plans import catalog, studies

RD = "sensor_id long, lat double, lon double, timestamp string, P1 double, P2 double"
CITY = ("geonameid long, name string, asciiname string, alternatenames string, latitude double, longitude double, "
        "population double, dem long")


def _tables(spark, ties=30):
    """Sensors beside places that hold ``ties`` cities each, some of them alike in two places."""
    rnd = random.Random(3)
    rd = [(s, 50.0 + s, 7.0, "2018-01-01 08:00:00", float(rnd.randrange(6)), rnd.choice([2.0, 3.0, 6000.0, None]))
          for s in range(6) for _ in range(12)]
    cities = [(100 * s + t, "c", "c", "", 50.01 + s, 7.0, None if t == 3 else float(t % 20 + s % 2), t % 7)
              for s in range(6) for t in range(ties)] * 2
    return spark.createDataFrame(rd, RD), spark.createDataFrame(cities, CITY), rd, cities


def _want(rd, cities):
    ok = [((p + q) / 2, lat) for _, lat, _, _, p, q in rd if q is not None and q < 5000]
    return {(a, c[6], c[7]) for (a, lat), c in itertools.product(ok, cities)
            if abs(c[4] - lat) < 0.1 and c[6] is not None}


def _exchanges(df):
    """Keys of the exchanges of the final plan."""
    return re.findall(r"hashpartitioning\(([^)]*)\)", df._jdf.queryExecution().executedPlan().toString())


@pytest.mark.parametrize("options", [{}, {"strategy": "pre-aggregate"}, {"max_broadcast_rows": 0}, {"persist": False}])
def test_triples_are_not_shuffled(spark, options):
    rd, cities, *raw = _tables(spark)
    rows = studies.settlement_rows(rd, cities, radius=0.5, **options)
    got = [tuple(r) for r in rows.collect()]
    assert len(got) == len(set(got)) and set(got) == _want(*raw)
    assert not [k for k in _exchanges(rows) if "population" in k and "avg_p" in k]


def test_sample_is_taken_from_rows_that_are_not_written(spark, tmp_path, monkeypatch):
    rd, cities, *raw = _tables(spark)
    written, save = [], studies.materialize
    monkeypatch.setattr(studies, "materialize", lambda s, df, **k: written.append(save(s, df, **k)) or written[-1])
    path = str(tmp_path / "sample")
    studies.settlement_study(rd, cities, radius=0.5, sample_path=path, sample_rows=40).collect()
    assert all(t.count() < 0.5 * len(_want(*raw)) for t in written if "avg_p" in t.columns)
    assert spark.read.option("header", True).option("sep", ";").csv(path).count() == 40


def test_export_writes_no_rows_but_the_sample(spark, monkeypatch):
    from aerocorr.plans import connectors
    names, save = [], connectors.materialize
    monkeypatch.setattr(connectors, "materialize", lambda s, df, **k: names.append(k.get("name")) or save(s, df, **k))
    catalog.QUERIES["settlement_csv_export"](spark, "/root/testdata/sf0.001").count()
    assert "settlement-rows" not in names


def test_attributes_in_blocks_and_known_pairs(spark):
    values = spark.createDataFrame([(float(v), k) for v in range(5) for k in range(4)], "avg_p double, k int")
    attrs = spark.createDataFrame([(k, float(a % 9), a % 4) for k in range(4) for a in range(k, k + 10)],
                                  "k int, population double, elevation int").distinct()
    want = {(v, r.population, r.elevation) for v in range(5) for r in attrs.collect()}
    whole = [tuple(r) for r in attached_rows(values, attrs, ["k"]).collect()]
    cut = [tuple(r) for r in attached_rows(values, attrs, ["k"], max_broadcast_rows=7).collect()]
    assert sorted(whole) == sorted(cut) == sorted(want)
    old, new = values.where("(avg_p + k) % 3 = 0"), values.where("(avg_p + k) % 3 <> 0")
    first = {tuple(r) for r in attached_rows(old, attrs, ["k"]).collect()}
    then = [tuple(r) for r in attached_rows(new, attrs, ["k"], known=old).collect()]
    assert len(then) == len(set(then)) and set(then) == want - first
