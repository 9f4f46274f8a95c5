"""Landing raw monthly files into one canonical, partitioned table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocorr.functions.time import STORED_HOUR, hour_of_day
from aerocorr.operators.clean import canonicalize
from aerocorr.schemas import READING_SCHEMA
from aerocorr.sources.readings import merged_reads
from aerocorr.sources.sinks import committed, materialize

LANDED_COLUMNS = READING_SCHEMA.fieldNames()
PARTITIONS = ["family", "month", "source_file"]
LEDGER = "_ledger"  # hidden from readers of the table
LEDGER_SCHEMA = ("family INT, month STRING, file_path STRING, bytes BIGINT, modified BIGINT, "
                 "source_file STRING, rows BIGINT, call INT")
SOURCE_FILE = "concat(_metadata.file_name, '-', substr(sha2(_metadata.file_path, 256), 1, 12))"


def with_stored_hour(df: DataFrame) -> DataFrame:
    """Add the integer ``hour_of_day`` parsed once from ``timestamp``."""
    return df.withColumn(STORED_HOUR, hour_of_day(df, "timestamp"))


def dedupe_manifest(manifest: DataFrame, path_col: str = "path") -> DataFrame:
    """One entry per (family, month, path): a file or folder listed twice lands
    once, files of the same name in two folders or months all land."""
    return manifest.select(F.col("family").cast("int").alias("family"),
                           F.col("month").cast("string").alias("month"), path_col).distinct()


def ledger(spark: SparkSession, out: str) -> DataFrame:
    """The landed files of the table at ``out``, one row each: family, month,
    file_path (the full source path), bytes, modified (microseconds), source_file
    (its partition), rows and the call that landed it last."""
    path = f"{out.rstrip('/')}/{LEDGER}"
    entries = (spark.read.schema(LEDGER_SCHEMA).parquet(path) if committed(spark, path)
               else spark.createDataFrame([], LEDGER_SCHEMA))
    value = F.max_by(F.struct("bytes", "modified", "source_file", "rows", "call"), "call").alias("v")
    return entries.groupBy("family", "month", "file_path").agg(value).select(
        "family", "month", "file_path", "v.*")


def _listed(spark: SparkSession, entries: DataFrame, path_col: str) -> DataFrame | None:
    """The files behind the manifest's paths (folders and globs included) with
    their sizes; contents are not read."""
    groups: dict[tuple[int, str], list[str]] = {}
    for row in entries.collect():  # a file list, not data
        groups.setdefault((row["family"], row["month"]), []).append(row[path_col])
    found = [spark.read.format("binaryFile").load(paths).select(
        F.lit(family).alias("family"), F.lit(month).alias("month"), "path",
        F.col("_metadata.file_path").alias("file_path"), F.col("length").alias("bytes"),
        F.unix_micros("modificationTime").alias("modified")) for (family, month), paths in sorted(groups.items())]
    return reduce(DataFrame.unionByName, found) if found else None


def land(spark: SparkSession, manifest: DataFrame, out: str, path_col: str = "path") -> DataFrame:
    """Read every already-fetched file named in ``manifest`` (columns
    ``path``, ``family``, ``month``; a path may be a folder), cast it to the
    canonical reading schema and write it under ``out`` partitioned by
    ``family``, ``month`` and ``source_file``.

    A file is known by its full path, size and time of change.  A ledger beside
    the data (:func:`ledger`) holds the landed ones; the listed files meet it in
    an anti-join, and only new or changed ones are read.  ``source_file`` is the
    file's name with a hash of its path, so files of one name from two folders
    stay apart and a changed file replaces its own rows and nothing else.  The
    ledger is written last: a call that broke off lands its files again, into
    the same partitions.  A changed file without rows leaves its old rows.

    Files may differ in columns and types.  The hour of day is parsed once here
    and stored as an integer column, and each file is sorted by sensor and time,
    which tightens Parquet statistics and compression.  Before the ledger is
    written the rows of every new file are counted on both sides (no columns are
    read); a difference fails the call.

    Only the manifest and the new files' names (one row per file) reach the
    driver, to name the files for the reader; the readings are read and written
    by the executors."""
    listed = _listed(spark, dedupe_manifest(manifest, path_col), path_col)
    known = ledger(spark, out)
    last = known.agg(F.max("call")).first()[0] or 0
    same = ["family", "month", "file_path", "bytes", "modified"]
    new = (listed.dropDuplicates(["family", "month", "file_path"]).join(known.select(*same), same, "left_anti")
           .select(*listed.columns).collect() if listed is not None else [])  # one row per new file
    if not new:
        if last:
            return spark.read.parquet(out)
        empty = with_stored_hour(spark.createDataFrame([], READING_SCHEMA))
        return empty.withColumns({"month": F.lit(""), "source_file": F.lit("")})
    groups: dict[tuple[int, str], list[str]] = {}
    for row in new:
        groups.setdefault((row["family"], row["month"]), []).append(row["path"])
    parts, counts = [], []
    for (family, month), paths in sorted(groups.items()):
        for raw in merged_reads(spark, sorted(paths)):
            raw = raw.withColumns({"month": F.lit(month), "source_file": F.expr(SOURCE_FILE)})
            parts.append(canonicalize(raw, family, keep_extra=True)
                         .select(*LANDED_COLUMNS, "month", "source_file"))
            counts.append(raw.select(F.lit(family).alias("family"), "month", "source_file",
                                     F.col("_metadata.file_path").alias("file_path")))
    union = lambda dfs: reduce(DataFrame.unionByName, dfs)
    (with_stored_hour(union(parts))
        .sortWithinPartitions(*PARTITIONS, "sensor_id", "timestamp")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*PARTITIONS).parquet(out))
    tally = union(counts).groupBy(*PARTITIONS, "file_path").agg(F.count(F.lit(1)).alias("rows"))
    names = spark.createDataFrame([tuple(r) for r in new], listed.schema)
    entry = names.join(tally, ["family", "month", "file_path"], "left").select(
        "family", "month", "file_path", "bytes", "modified", "source_file",
        F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), F.lit(last + 1).alias("call"))
    entry = materialize(spark, entry, name="landed-files")
    landed = (spark.read.schema("sensor_id BIGINT, family INT, month STRING, source_file STRING").parquet(out)
              .join(entry.select(*PARTITIONS), PARTITIONS, "left_semi")
              .groupBy(*PARTITIONS).agg(F.count(F.lit(1)).alias("landed")))
    lost = (entry.where("rows > 0").join(landed, PARTITIONS, "left")
            .where("landed IS NULL OR landed <> rows").limit(5).collect())
    if lost:
        raise RuntimeError(f"landed rows differ from the listed files: {lost}")
    entry.coalesce(1).write.mode("append").parquet(f"{out.rstrip('/')}/{LEDGER}")
    if not landed.limit(1).count() and not last:
        return with_stored_hour(spark.createDataFrame([], READING_SCHEMA)).withColumns(
            {"month": F.lit(""), "source_file": F.lit("")})
    return spark.read.parquet(out)
