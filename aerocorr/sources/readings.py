"""Parquet readers for the device families."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from aerocorr.operators.clean import canonicalize
from aerocorr.schemas import READING_SCHEMA


def merged_reads(spark: SparkSession, files: Sequence[str]) -> list[DataFrame]:
    """``files`` as few DataFrames that together hold all columns of all files:
    one read with merged schemas, and where column types conflict the list is
    halved until each part merges (a read costs its footers, not its data)."""
    try:
        return [spark.read.option("mergeSchema", "true").parquet(*files)]
    except (PySparkException, Py4JJavaError):  # footers are merged in a job, whose error is a Java one
        if len(files) == 1:
            raise
    half = len(files) // 2
    return merged_reads(spark, files[:half]) + merged_reads(spark, files[half:])


def files_of(spark: SparkSession, paths: str | Sequence[str]) -> list[str]:
    """The files behind paths, globs and folders, in order (names only; the
    listing percent-encodes them)."""
    listed = [paths] if isinstance(paths, str) else list(paths)
    found = spark.read.schema(READING_SCHEMA).parquet(*listed).inputFiles() if listed else []
    return sorted(map(unquote, found))


def read_family(spark: SparkSession, path: str | list[str], family: int) -> DataFrame:
    """One family's Parquet files (a path, glob or list) on the canonical
    schema.  Files may differ: a column some lack is NULL there, types may
    conflict between files, text that is no number becomes NULL."""
    files = files_of(spark, path)
    if not files:
        return canonicalize(spark.createDataFrame([], READING_SCHEMA), family)
    return reduce(DataFrame.unionByName,
                  [canonicalize(df, family) for df in merged_reads(spark, files)])


def read_readings(spark: SparkSession, paths: Mapping[int, str | list[str]],
                  distinct: bool = False) -> DataFrame:
    """Bag union of every family on the canonical schema."""
    out = reduce(DataFrame.unionByName,
                 [read_family(spark, path, fam) for fam, path in sorted(paths.items())])
    return out.distinct() if distinct else out


def read_landed(spark: SparkSession, base: str, schema: T.StructType | None = None) -> DataFrame:
    """Readings landed by :func:`aerocorr.sources.landing.land`: one canonical
    schema, partitioned by ``family``, ``month`` and ``source_file`` so filters
    on them prune directories.  Passing ``schema`` (with ``month`` as text) pins
    the partition column types instead of inferring them from directory names."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(base)
