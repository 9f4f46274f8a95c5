"""Writers: materialized tables and the bounded CSV export."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from aerocorr.config import work_dir
from aerocorr.operators.sampling import exact_sample, random_sample
from aerocorr.schemas import SAMPLE_ROWS


def committed(spark: SparkSession, path: str) -> bool:
    """Whether a complete write sits at ``path`` (Spark's commit protocol
    leaves ``_SUCCESS`` only when every task committed), on whatever file
    system the path names."""
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/_SUCCESS")
    fs = marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(marker))


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists",
                  partition_by: Sequence[str] | None = None) -> str:
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def materialize(spark: SparkSession, build: Callable[[], DataFrame] | DataFrame,
                path: str | None = None, *, name: str = "table", refresh: bool = True,
                ) -> DataFrame:
    """Compute-or-reload: with ``refresh`` (or when nothing is stored at
    ``path``) build the table and write it, then return a DataFrame that
    **reads the written files**, so later actions reuse them and lineage is cut
    (a lost executor re-reads files instead of recomputing the build).
    ``refresh=False`` with an existing table just reloads it.  Tables go to
    the shared folder named by ``spark.checkpoint.dir`` unless ``path`` says
    otherwise."""
    target = path or work_dir(spark, name)
    if not refresh and committed(spark, target):
        return spark.read.parquet(target)
    df = build() if callable(build) else build
    df.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def write_sample_csv(df: DataFrame, path: str, keys: Sequence[str], n: int = SAMPLE_ROWS,
                     sep: str = ";", expected_rows: int | None = None,
                     method: str = "hash", seed: int | None = 42) -> str:
    """At most ``n`` rows as one CSV file with a header.  ``method="hash"``
    takes the reproducible :func:`exact_sample` (exactly ``min(n, count)``
    rows on any engine); ``"bernoulli"`` the seeded fraction sample capped at
    ``n`` (:func:`random_sample`).  Only the bounded sample is collapsed to a
    single partition."""
    if method == "hash":
        sample = exact_sample(df, n, keys, expected_rows=expected_rows)
    elif method == "bernoulli":
        sample = random_sample(df, n, seed=seed)
    else:
        raise ValueError(f"unknown sampling method {method!r}")
    (sample.coalesce(1).write.mode("overwrite")
        .option("header", True).option("sep", sep).csv(path))
    return path
