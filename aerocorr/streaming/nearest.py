"""Nearest sites kept current as sensors and sites arrive.

The state under ``out`` is three tables named by a commit log
(:mod:`aerocorr.sources.commits`): the known positions, the known sites and the
nearest pairs of positions and places.  A place is a site's coordinates; sites
that share one are told apart when the pairs are read, so neither the search nor
the stored pairs grow with the sites tied at a place.  A micro-batch searches
only what it brings:

* new positions meet all places (:func:`aerocorr.operators.nearest.nearest_sites`);
* known positions meet the new places only, bounded by the distance they have
  (:func:`aerocorr.operators.nearest.nearest_below`), so a place corrects just
  the keys that it beats or ties.

The pairs found are merged with the stored ones of the same keys and appended
with the batch's number; a key's last number counts.  Every ``COMPACT`` folders
a table is rewritten as one.  A batch writes its folders first and its commit
last and a committed batch is skipped, so a replayed one changes nothing and
readers see whole batches.

Rows without finite coordinates are left out; repeated rows count once; a key
with several positions keeps the nearest sites over all of them, as in batch.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerocorr.config import work_dir
from aerocorr.operators.nearest import closest_rows, nearest_below, nearest_sites
from aerocorr.sources.commits import drop_unnamed, read_commit, remove, write_commit

COMPACT = 8
PARTS = ("positions", "sites", "nearest")
PLACE = ["latitude", "longitude"]


def _same(columns: list[str], suffix: str = "_old") -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(c + suffix)) for c in columns])


def _unseen(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    """Distinct finite rows that are not known yet."""
    rows = rows.distinct()
    if known is None:
        return rows
    old = known.select(*[F.col(c).alias(c + "_old") for c in rows.columns])
    return rows.join(old, _same(rows.columns), "left_anti")


def _finite(df: DataFrame, *columns: str) -> DataFrame:
    inf = F.lit(float("inf"))
    ok = [F.col(c).isNotNull() & ~F.isnan(F.col(c)) & (F.abs(F.col(c)) < inf) for c in columns]
    return df.where(reduce(lambda a, b: a & b, ok))


def _current(pairs: DataFrame, key: str) -> DataFrame:
    """Of each key the rows that its last batch wrote."""
    last = Window.partitionBy(key).orderBy(F.col("_batch").desc())
    return pairs.withColumn("_age", F.rank().over(last)).where("_age = 1").drop("_age")


def _pairs(pairs: DataFrame, key: str) -> DataFrame:
    """The current pairs; distinct, as pairs stored by an earlier form of this
    table name the sites of a place each."""
    return _current(pairs, key).select(key, "lat", "lon", *PLACE, "dist").distinct()


def start_nearest(spark: SparkSession, positions: DataFrame, sites: DataFrame, out: str,
                  checkpoint: str | None = None, *, key: str = "sensor_id",
                  available_now: bool = True) -> StreamingQuery:
    """Keep the nearest sites of every key under ``out``, which belongs to this
    ``checkpoint``; :func:`read_nearest` reads them.  ``positions``: a stream
    with ``key``, ``lat``, ``lon`` (readings will do); ``sites``: a stream with
    ``latitude``, ``longitude`` and further columns, named otherwise."""
    here, there = [key, "lat", "lon"], sites.columns
    if set(here) & set(there):
        raise ValueError(f"positions and sites share column names {sorted(set(here) & set(there))}")
    tagged = positions.select(*here, F.lit(True).alias("_sensor")).unionByName(
        sites.withColumn("_sensor", F.lit(False)), allowMissingColumns=True)

    def advance(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = read_commit(spark, out) or {"version": 0, "batch": -1, **{p: [] for p in PARTS}}
        if state["batch"] >= batch_id:
            return
        folders, made = {p: list(state[p]) for p in PARTS}, []

        def stored(part):
            return spark.read.parquet(*[f"{out}/{f}" for f in folders[part]]) if folders[part] else None

        def write(part, df):
            """``df`` as a further folder of ``part``; the rows written."""
            folder = f"{part}-{batch_id:09d}-{uuid.uuid4().hex[:8]}"
            df.write.parquet(f"{out}/{folder}")
            folders[part].append(folder)
            made.append(folder)
            return spark.read.parquet(f"{out}/{folder}")

        old = {p: stored(p) for p in PARTS}
        new_sites = write("sites", _unseen(_finite(
            batch.where(~F.col("_sensor")).select(*there), "latitude", "longitude"), old["sites"]))
        new_positions = write("positions", _unseen(_finite(
            batch.where(F.col("_sensor")).select(*here), "lat", "lon"), old["positions"]))
        pairs = None if old["nearest"] is None else _pairs(old["nearest"], key)
        found = nearest_sites(new_positions, stored("sites").select(*PLACE).distinct(), key=key, distinct_sites=False)
        new_places = _unseen(new_sites.select(*PLACE), None if old["sites"] is None else old["sites"].select(*PLACE))
        if old["positions"] is not None and not new_places.isEmpty():
            has = pairs.groupBy(F.col(key).alias("_k")).agg(F.min("dist").alias("_has"))
            known = old["positions"].join(has, F.col(key).eqNullSafe(F.col("_k")), "left").drop("_k")
            found = found.unionByName(nearest_below(known, new_places, "_has", key=key))
        if pairs is not None:
            found = write("nearest", found.withColumn("_batch", F.lit(-1).cast("long"))).drop("_batch")
            folders["nearest"].pop()  # not part of the state, written only to be read twice
            keys = found.select(F.col(key).alias("_k")).distinct()
            found = found.unionByName(pairs.join(keys, F.col(key).eqNullSafe(F.col("_k")), "left_semi"))
        write("nearest", closest_rows(found, key).withColumn("_batch", F.lit(batch_id).cast("long")))
        for part in PARTS:
            if len(folders[part]) > COMPACT:
                whole = stored(part)
                folders[part] = []
                write(part, _current(whole, key) if part == "nearest" else whole)
        write_commit(spark, out, {**folders, "batch": batch_id}, state["version"])
        for folder in set(made).difference(*folders.values()):
            remove(spark, f"{out}/{folder}")
        drop_unnamed(spark, out, PARTS)

    writer = (tagged.writeStream.foreachBatch(advance)
              .option("checkpointLocation", checkpoint or work_dir(spark, "nearest-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_nearest(spark: SparkSession, out: str, key: str = "sensor_id") -> DataFrame:
    """The nearest pairs as of the last committed batch: position and site
    columns and ``dist``."""
    state = read_commit(spark, out)
    if state is None:
        raise FileNotFoundError(f"no committed batch under {out}")
    pairs, sites = (spark.read.parquet(*[f"{out}/{f}" for f in state[part]]) for part in ("nearest", "sites"))
    return _pairs(pairs, key).join(sites, PLACE).select(key, "lat", "lon", *sites.columns, "dist")
