import pytest
from pyspark.sql.utils import AnalysisException  # noqa: F401

from aerocorr.operators import geocode

GOOD = '{"osm_id": 7, "osm_type": "node", "display_name": "X", "address": {"country": "Deutschland", "country_code": "de", "city": "Bonn"}}'
NO_COUNTRY = '{"osm_id": 8, "osm_type": "way", "display_name": "Y", "address": {"road": "Main"}}'
ERROR = '{"error": "Unable to geocode"}'
MALFORMED = '{"osm_id": 9, "addr'


def test_parse_responses(spark):
    df = spark.createDataFrame([(1, GOOD), (2, NO_COUNTRY), (3, ERROR), (4, MALFORMED), (5, None)],
                               "id int, body string")
    out = {r.id: r for r in geocode.parse_responses(df).collect()}
    assert (out[1].osm_id, out[1].country, out[1].city, out[1].road, out[1].geocode_ok) == \
        (7, "Deutschland", "Bonn", "", True)
    assert (out[2].osm_id, out[2].country, out[2].road, out[2].geocode_ok) == (8, "", "Main", True)
    for i in (3, 4, 5):
        assert (out[i].osm_id, out[i].country, out[i].osm_type, out[i].geocode_ok) == (-1, "", "", False)


def _tables(spark):
    pos = spark.createDataFrame([(1, 50.0, 7.0), (2, 51.0, 8.0), (3, 52.0, 9.0), (4, 50.0, 7.0)],
                                "sensor_id long, lat double, lon double")
    geo = spark.createDataFrame([(50.0, 7.0, "Deutschland"), (51.0, 8.0, "France"),
                                 (51.0, 8.0, "Belgique")], "lat double, lon double, country string")
    return pos, geo


def test_enrich_policies_and_worklist(spark):
    pos, geo = _tables(spark)
    keep = {r.sensor_id: r.country for r in geocode.enrich_country(pos, geo).collect()}
    assert keep == {1: "Deutschland", 2: "Belgique", 3: "error", 4: "Deutschland"}
    drop = {r.sensor_id for r in geocode.enrich_country(pos, geo, on_missing="drop").collect()}
    assert drop == {1, 2, 4}
    filt = geocode.country_filter(geocode.enrich_country(pos, geo))
    assert sorted(r.sensor_id for r in filt.collect()) == [1, 3, 4]
    work = [tuple(r) for r in geocode.geocode_worklist(pos, geo).collect()]
    assert work == [(52.0, 9.0)]
    with pytest.raises(Exception):
        geocode.enrich_country(pos, geo, on_missing="error").collect()


def test_answered_without_country_failed_and_absent_are_told_apart(spark):
    pos = spark.createDataFrame([(1, 1.0, 1.0), (2, 2.0, 2.0), (3, 3.0, 3.0), (4, 4.0, 4.0), (5, None, 8.0)],
                                "sensor_id int, lat double, lon double")
    known = spark.createDataFrame([(1.0, 1.0, "Deutschland"), (2.0, 2.0, None), (3.0, 3.0, "error")],
                                  "lat double, lon double, country string")
    got = geocode.enrich_country(pos, known, status="status")
    assert {r.sensor_id: (r.country, r.status) for r in got.collect()} == {
        1: ("Deutschland", "answered"), 2: (None, "failed"), 3: ("error", "failed"),
        4: ("error", "absent"), 5: (None, "absent")}
    assert sorted(r.sensor_id for r in geocode.country_filter(got).collect()) == [1, 3, 4]
    assert [(r.lat, r.lon) for r in geocode.geocode_worklist(pos, known).collect()] == [(4.0, 4.0)]
