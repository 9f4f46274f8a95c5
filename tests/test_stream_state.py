"""State of the streams: no more than the pairs it is named for."""

from pyspark.sql import functions as F

from aerocorr.plans import studies
from aerocorr.sources.commits import read_commit
from test_triples import RD, _tables


def test_settlement_stream_keeps_pairs_not_triples(spark, tmp_path, monkeypatch):
    from aerocorr.operators.stats import correlation_matrix
    from aerocorr.streaming import settlement as S
    monkeypatch.setattr(S, "COMPACT", 2)
    rd, cities, raw, _ = _tables(spark)
    near, attrs = studies.settlement_places(rd.select("sensor_id", "lat", "lon").distinct(), cities, radius=0.5)
    src, out, ck = (str(tmp_path / d) for d in ("src", "out", "ck"))
    for part in range(4):
        spark.createDataFrame(raw[part::4], RD).coalesce(1).write.mode("append").parquet(src)
        S.start_settlement(spark, spark.readStream.schema(RD).parquet(src), near, out, ck, cities=attrs).awaitTermination()
    state = read_commit(spark, out)
    assert len(state["pairs"]) <= 2
    assert sum(spark.read.parquet(f"{out}/{f}").count() for f in state["pairs"]) == len(
        {((p + q) / 2, s) for s, _, _, _, p, q in raw if q is not None and q < 5000})
    columns = ["avg_p", "population", "elevation"]
    want = correlation_matrix(studies.settlement_rows(rd, cities, radius=0.5), columns, digits=9)
    assert sorted(map(tuple, S.settlement_matrix(spark, out, digits=9).collect())) == sorted(map(tuple, want.collect()))


def test_nearest_stream_keeps_places_not_tied_sites(spark, tmp_path):
    from aerocorr.streaming import read_nearest, start_nearest
    pos, site = "sensor_id int, lat double, lon double", "site int, latitude double, longitude double"
    p, s, out, ck = (str(tmp_path / d) for d in ("p", "s", "out", "ck"))
    seen = []
    for batch in range(2):
        more = [(20 * batch + i, 50.0 + i % 2, 7.0) for i in range(20)]
        seen += more
        spark.createDataFrame([(batch, 50.0 + batch, 7.1)], pos).write.mode("append").parquet(p)
        spark.createDataFrame(more, site).coalesce(1).write.mode("append").parquet(s)
        start_nearest(spark, spark.readStream.schema(pos).parquet(p), spark.readStream.schema(site).parquet(s),
                      out, ck).awaitTermination()
    state = read_commit(spark, out)
    assert sum(spark.read.parquet(f"{out}/{f}").count() for f in state["nearest"]) == 2
    got = read_nearest(spark, out)
    assert got.columns == ["sensor_id", "lat", "lon", "site", "latitude", "longitude", "dist"]
    assert sorted((r.sensor_id, r.site) for r in got.collect()) == [
        (k, i) for k in range(2) for i, lat, _ in sorted(seen) if lat == 50.0 + k]


def test_parts_of_a_stream_are_files_of_one_micro_batch(spark, tmp_path, monkeypatch):
    from aerocorr.plans import connectors
    monkeypatch.setattr(connectors, "PART_FILE_ROWS", 100)
    df = spark.range(3000).withColumn("v", F.col("id") * 2)
    got = []
    stream = connectors._in_parts(df, "id", "parts")
    (stream.writeStream.foreachBatch(lambda b, _: got.append(sorted(r.id for r in b.collect())))
     .option("checkpointLocation", str(tmp_path))
     .trigger(availableNow=True).start().awaitTermination())
    assert got == [list(range(i, 3000, 3)) for i in range(3)]
