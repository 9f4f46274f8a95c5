"""The settlement study kept current as readings arrive.

The state under ``out`` is a table of the distinct ``(avg_p, place)`` pairs seen
so far, in folders named by a commit log (:mod:`aerocorr.sources.commits`), and
the co-moments of the distinct ``(avg_p, population, elevation)`` triples.  A
micro-batch appends its new pairs; the triples they give and no earlier pair
gave are reduced to co-moments (one aggregate) and merged into the stored ones,
a few numbers in the commit.  Triples are neither stored nor shuffled
(:mod:`aerocorr.operators.triples`).  Every ``COMPACT`` folders the pairs are
rewritten as one.  A committed batch is skipped when it is replayed.

The state grows with the distinct pairs, never faster than the readings and the
places their sensors are nearest to.  The sensors' cities are the tables handed
in: after they changed, start anew with another checkpoint.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from aerocorr import schemas
from aerocorr.config import work_dir
from aerocorr.operators.clean import avg_particulates, keep_if_all_present
from aerocorr.operators.joins import size_checked_broadcast
from aerocorr.operators.stats import co_moments, matrix_of_moments, merge_moments
from aerocorr.operators.triples import attached_rows
from aerocorr.sources.commits import drop_unnamed, read_commit, remove, write_commit

COLUMNS = ["avg_p", "population", "elevation"]
COMPACT = 8


def start_settlement(spark: SparkSession, readings: DataFrame, near: DataFrame, out: str,
                     checkpoint: str | None = None, *, cities: DataFrame | None = None,
                     max_value: float = schemas.MAX_VALUE, available_now: bool = True) -> StreamingQuery:
    """Keep the moments of the settlement study's rows under ``out``, which
    belongs to this ``checkpoint``.  ``near`` and ``cities``: the two tables of
    :func:`aerocorr.plans.studies.settlement_places`; without ``cities``,
    ``near`` is a nearest-city table
    (:func:`aerocorr.plans.studies.settlement_table`)."""
    if cities is None:
        place = ["sensor_id"]
        attrs = near.select("sensor_id", "population", "elevation").distinct()
        near = near.select("sensor_id").distinct()
    else:
        place = [c for c in cities.columns if c not in COLUMNS]
        attrs, near = cities, near.select("sensor_id", *place)
    attrs = keep_if_all_present(attrs, COLUMNS[1:])
    ok = readings.where((F.col("P1") < F.lit(max_value)) & (F.col("P2") < F.lit(max_value)))
    # adding 0 makes one value of both zeros
    avg = ok.select("sensor_id", (avg_particulates(ok) + F.lit(0.0)).alias("avg_p"))
    pairs = keep_if_all_present(avg.join(size_checked_broadcast(near), "sensor_id"), ["avg_p"]) \
        .select("avg_p", *place)

    def advance(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = read_commit(spark, out) or {"version": 0, "batch": -1, "moments": None, "pairs": []}
        if state["batch"] >= batch_id:
            return
        if "pairs" not in state:
            raise ValueError(f"{out} was kept without its pairs: start anew")
        folders = list(state["pairs"])

        def write(df):
            folder = f"pairs-{batch_id:09d}-{uuid.uuid4().hex[:8]}"
            df.write.parquet(f"{out}/{folder}")
            folders.append(folder)
            return spark.read.parquet(f"{out}/{folder}")

        known = spark.read.parquet(*[f"{out}/{f}" for f in folders]) if folders else None
        new = batch.distinct()
        if known is not None:
            new = new.join(known, ["avg_p", *place], "left_anti")
        new = write(new)
        moments = co_moments(attached_rows(new, attrs, place, known=known), COLUMNS)
        if state["moments"]:
            moments = merge_moments(state["moments"], moments)
        merged = []
        if len(folders) > COMPACT:
            merged, whole = folders[-1:], spark.read.parquet(*[f"{out}/{f}" for f in folders])
            folders.clear()
            write(whole)
        write_commit(spark, out, {"batch": batch_id, "moments": moments, "pairs": folders}, state["version"])
        for folder in merged:
            remove(spark, f"{out}/{folder}")
        drop_unnamed(spark, out, ["pairs"])

    writer = (pairs.writeStream.foreachBatch(advance)
              .option("checkpointLocation", checkpoint or work_dir(spark, "settlement-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def settlement_matrix(spark: SparkSession, out: str, digits: int | None = None) -> DataFrame:
    """The study's 3x3 matrix as of the last committed batch."""
    state = read_commit(spark, out)
    if state is None:
        raise FileNotFoundError(f"no committed batch under {out}")
    return matrix_of_moments(spark, state["moments"], COLUMNS, digits=digits)
