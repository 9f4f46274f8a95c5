"""Text readers that keep the rejected lines.

A permissive read turns a bad field into NULL and says nothing.  Here one pass
parses the files and writes two tables side by side: the good rows, and every
line that does not fit the schema (a field of another type, too few or too many
fields) as it stands in its file, with the file's path.  A NULL or empty field
is not a fault.  ``max_share`` is the failure threshold: with more rejected
lines than this share of all lines, the read is an error that names the counts
and the place of the rejects, and no good rows are handed on.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerocorr.config import work_dir
from aerocorr.schemas import CITY_SCHEMA, SITE_SCHEMA


class Parsed(NamedTuple):
    """``good``: rows of the schema; ``rejects``: (line, source_file)."""
    good: DataFrame
    rejects: DataFrame


class TooManyRejects(ValueError):
    """More lines rejected than the threshold allows."""


def _free(name: str, taken) -> str:
    while name in taken:
        name += "_"
    return name


def parse_text(spark: SparkSession, path: str | list[str], schema: T.StructType, *,
               max_share: float = 1.0, store: str | None = None, **options) -> Parsed:
    """Parse delimited text (``options`` of Spark's CSV reader) once.  The two
    tables go to ``store`` (a new folder of the shared work folder if unset), so
    later reads never parse the text again and the two always agree."""
    line, source = _free("line", schema.names), _free("source_file", schema.names)
    rejected = _free("rejected", schema.names)
    rows = (spark.read.options(**options).option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", line)
            .schema(T.StructType([*schema.fields, T.StructField(line, T.StringType())])).csv(path))
    store = store or work_dir(spark, "parsed-text")
    (rows.withColumn(rejected, F.col(line).isNotNull())
         .withColumn(source, F.when(F.col(line).isNotNull(), F.input_file_name()))
         .write.mode("errorifexists").partitionBy(rejected).parquet(store))
    parsed = spark.read.schema(T.StructType([
        *[T.StructField(f.name, f.dataType) for f in schema.fields], T.StructField(line, T.StringType()),
        T.StructField(source, T.StringType()), T.StructField(rejected, T.BooleanType())])).parquet(store)
    good = parsed.where(~F.col(rejected)).select(*schema.names)
    rejects = parsed.where(F.col(rejected)).select(F.col(line).alias("line"), F.col(source).alias("source_file"))
    if max_share < 1.0:
        total, bad = parsed.agg(F.count(F.lit(1)), F.count_if(rejected)).first()
        if bad > max_share * total:
            raise TooManyRejects(f"{bad} of {total} lines rejected, more than {max_share:.2%}; see {store}")
    return Parsed(good, rejects)


def parse_sites(spark: SparkSession, path: str | list[str], *, max_share: float = 1.0,
                store: str | None = None, sep: str = ";") -> Parsed:
    """The site list with its rejected lines."""
    return parse_text(spark, path, SITE_SCHEMA, max_share=max_share, store=store, header=True, sep=sep)


def parse_cities(spark: SparkSession, path: str | list[str], country_code: str | None = None, *,
                 max_share: float = 1.0, store: str | None = None) -> Parsed:
    """The gazetteer with its rejected lines, of whatever country."""
    good, rejects = parse_text(spark, path, CITY_SCHEMA, max_share=max_share, store=store,
                               header=False, sep="\t", quote="")
    if country_code is not None:
        good = good.where(F.col("country_code") == F.lit(country_code))
    return Parsed(good, rejects)
