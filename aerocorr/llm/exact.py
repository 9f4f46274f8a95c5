"""Exact dedup over a persistent digest index.

The index is a Parquet table bucketed and sorted by the SHA-256 of the text
(null counts as empty).  New rows meet it in a sort-merge anti-join on the
digest - the index side needs no shuffle - and what is new is appended.  Texts
never move: only (digest, doc_id) rows are shuffled, and a digest's rows are
combined before the shuffle, so a group holding a third of all rows is one
small aggregate per task.  SQL functions only.

Defined cases: a null text equals the empty text; of equal texts inside one
batch the largest doc_id stays (a null doc_id only if the group has no other);
a text already in the index stays there, so batches arrive in the order of
precedence; rows that repeat a (doc_id, text) are one document, all of them
carry its verdict; an empty batch appends nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocorr.config import work_dir
from aerocorr.llm.common import shuffle_partitions, written


def digested(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest) of every row; the digest is the raw 32 bytes."""
    return docs.select(
        F.col(id_col).alias("doc_id"),
        F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)).alias("digest"))


class DigestIndex:
    """``name``: table name; ``path``: its folder (shared storage); an index
    that exists in the session's catalog is continued with its buckets (give
    their number).  Columns: digest, keep_id (the document that stays), n (rows
    of the batch that brought it).

    The groups come out of their aggregation or anti-join hashed by digest, so
    with as many buckets as shuffle partitions each bucket is one file a batch."""

    def __init__(self, spark: SparkSession, name: str, path: str, buckets: int | None = None):
        self.spark, self.name, self.path = spark, name, path
        self.buckets = buckets or shuffle_partitions(spark)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def new_groups(self, batch: DataFrame) -> DataFrame:
        """One row for each text of ``batch`` (doc_id, digest) that the index lacks."""
        groups = batch.groupBy("digest").agg(F.max("doc_id").alias("keep_id"),
                                             F.count(F.lit(1)).alias("n"))
        if not self.exists():
            return groups
        return groups.join(self.table().select("digest").hint("merge"), "digest", "left_anti")

    def add(self, batch: DataFrame) -> None:
        """Append the new texts; the table stays bucketed and sorted."""
        (self.new_groups(batch)
            .write.mode("append" if self.exists() else "errorifexists").format("parquet")
            .option("path", self.path).bucketBy(self.buckets, "digest").sortBy("digest")
            .saveAsTable(self.name))

    def drop(self) -> None:
        """Forget the table; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def exact_dedup(spark: SparkSession, docs: DataFrame, index: DigestIndex | None = None,
                batches: int = 2) -> DataFrame:
    """One row per row of ``docs``: doc_id, keep_id, group_size, kept,
    text_sha256 (hex).  The rows enter the index in ``batches`` ranges of
    doc_id, largest first, so the largest doc_id of equal texts stays."""
    rows = written(spark, digested(docs), "digests")
    index = index or DigestIndex(spark, f"digest_index_{uuid.uuid4().hex[:12]}",
                                 work_dir(spark, "digests"))
    low, high = rows.agg(F.min("doc_id"), F.max("doc_id")).first()
    if low is None:
        low = high = 0
    cuts = [low + (high - low + 1) * i // batches for i in range(batches)] + [high + 1]
    for i in reversed(range(batches)):
        part = (F.col("doc_id") >= cuts[i]) & (F.col("doc_id") < cuts[i + 1])
        if i == 0:
            part = part | F.col("doc_id").isNull()
        if i == batches - 1 or cuts[i] < cuts[i + 1]:
            index.add(rows.where(part))
    sizes = rows.groupBy("digest").agg(F.count(F.lit(1)).alias("group_size"))
    stays = index.table().select("digest", "keep_id").join(sizes, "digest")
    return rows.join(stays, "digest").select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def drop_copies(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` without the copies, all columns kept.  Rows that repeat a whole
    (doc_id, text) are reduced to one; that second step runs only if there are
    any."""
    verdict = exact_dedup(spark, docs)
    stay = written(spark, verdict.where("kept").groupBy(
        F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__sha2"))
        .agg(F.count(F.lit(1)).alias("__n")), "kept_digests")
    rows = docs.withColumn("__sha", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__sha") == F.col("__sha2"))
    out = rows.join(stay.where("__n = 1"), same, "left_semi").select(*docs.columns)
    if stay.where("__n > 1").limit(1).count():
        again = rows.join(stay.where("__n > 1"), same).dropDuplicates(["__id", "__sha2"])
        out = out.unionByName(again.select(*docs.columns))
    return out
