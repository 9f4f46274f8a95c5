"""Incremental landing and incremental per-position moments.

New monthly files arrive in the family folders over time.  Two Structured
Streaming jobs keep the derived tables current without re-reading history:

* :func:`start_landing` - file source per family -> canonical schema ->
  Parquet partitioned by ``family``/``month`` (exactly once through the
  checkpoint; files already processed are never read again).
* :func:`start_position_moments` - a running aggregation per
  ``(sensor_id, lat, lon)`` of the qualifying ``avg_p`` values (count, mean,
  population variance; mergeable state), published after every micro-batch
  as a complete snapshot.  The remoteness study pools its correlation from
  exactly this table (:func:`aerocorr.operators.stats.pooled_correlation_matrix`).

State is one row per sensor position, so it stays small however many readings
stream through; checkpoints live under the shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from aerocorr import schemas
from aerocorr.config import work_dir
from aerocorr.functions.time import reading_hour
from aerocorr.operators.clean import avg_particulates, canonicalize
from aerocorr.operators.stats import grouped_moments
from aerocorr.sources.landing import with_stored_hour
from aerocorr.sources.sinks import committed


def stream_readings(spark: SparkSession, sources: Mapping[int, str],
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming union of the family folders on the canonical schema.  A folder
    that holds files is read with their merged schema, as in batch, so physical
    timestamps or wider integers work; an empty one with the family's declared
    schema."""
    frames = []
    for fam, path in sorted(sources.items()):
        reader = spark.readStream.schema(file_schema(spark, path, fam))
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
        frames.append(canonicalize(reader.parquet(path), fam))
    return reduce(lambda a, b: a.unionByName(b), frames)


def file_schema(spark: SparkSession, path: str, family: int) -> T.StructType:
    try:
        return spark.read.option("mergeSchema", "true").parquet(path).schema
    except PySparkException:  # nothing there yet
        return schemas.FAMILY_SCHEMAS[family]


def with_month(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """``month`` = ``yyyy-MM`` of the reading time (NULL when unparsable)."""
    return df.withColumn("month", F.date_format(F.try_to_timestamp(F.col(column)), "yyyy-MM"))


def start_landing(spark: SparkSession, sources: Mapping[int, str], out: str,
                  checkpoint: str | None = None, available_now: bool = True) -> StreamingQuery:
    """Landed rows carry ``month`` (the partition) and the integer
    ``hour_of_day`` parsed once, like :func:`aerocorr.sources.landing.land`."""
    stream = with_stored_hour(with_month(stream_readings(spark, sources)))
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .partitionBy("family", "month")
              .option("checkpointLocation", checkpoint or work_dir(spark, "landing-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(out)


def start_position_moments(spark: SparkSession, readings: DataFrame, out: str,
                           checkpoint: str | None = None, *,
                           max_value: float = schemas.MAX_VALUE,
                           first_hour: int = schemas.DAY_FIRST_HOUR,
                           last_hour: int = schemas.DAY_LAST_HOUR,
                           daytime: bool = True, available_now: bool = True) -> StreamingQuery:
    """Maintain ``(sensor_id, lat, lon, _n, _mean, _var)`` under ``out``: one
    folder a micro-batch, which :func:`read_snapshot` reads once it is
    committed, so readers never see a snapshot that is being written."""
    qualifies = (F.col("P1") < F.lit(max_value)) & (F.col("P2") < F.lit(max_value))
    if daytime:
        qualifies = qualifies & reading_hour(readings).between(first_hour, last_hour)
    moments = grouped_moments(readings, ["sensor_id", "lat", "lon"], avg_particulates(readings),
                              qualifies)

    def publish(batch: DataFrame, batch_id: int) -> None:
        # complete snapshot of the state: replaying a batch rewrites the same rows
        batch.write.mode("overwrite").parquet(f"{out}/batch-{batch_id:012d}")

    writer = (moments.writeStream.outputMode("complete").foreachBatch(publish)
              .option("checkpointLocation", checkpoint or work_dir(spark, "moments-ckpt")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def read_snapshot(spark: SparkSession, out: str) -> DataFrame:
    """The latest snapshot under ``out`` whose write is complete."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out}/batch-*")
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    folders = sorted((s.getPath().toString() for s in fs.globStatus(path) or []), reverse=True)
    for folder in folders:
        if committed(spark, folder):
            return spark.read.parquet(folder)
    raise FileNotFoundError(f"no complete snapshot under {out}")
