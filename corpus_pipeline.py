"""Corpus preparation over ``documents``, stage by stage.

Each stage works on all rows its predecessor kept, is written as Parquet in the
shared folder and read again.  All but the last return the columns of
``documents``; extra columns ride along.

1. toxicity: rows that the classifier rejects go, in one pass over the text.
2. exact_dedup: of equal texts the largest doc_id stays.
3. near_dedup: of each group of linked documents the smallest doc_id stays.
4. mixing: every row stays; files and the rows in them follow the schedule.
5. packing: one row per document with its bucket, batch and place; the batches
   of a bucket are cut in the order of the mix.

Toxicity learns from ``labels`` outside the held-out fold.  Nulls, empty
tables and repeated rows are handled as the operators define.  The stages are
learned, iterative or optimising, so no SQL gives run()'s rows; the tests hold
them against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aerocorr.llm.common import table, written
from aerocorr.llm.exact import drop_copies
from aerocorr.llm.jaccard import first_of_each
from aerocorr.llm.mixing import mix_rows
from aerocorr.llm.packing import pack
from aerocorr.llm.toxicity import clean_rows


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return clean_rows(spark, docs, table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_copies(spark, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return first_of_each(spark, docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_rows(spark, docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(spark, docs, in_order=True)


STAGES = [("toxicity", toxicity), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup),
          ("mixing", mixing), ("packing", packing)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(spark, stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
