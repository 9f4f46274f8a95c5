"""Packing into length buckets of minimal padding.

A histogram of the token counts of all documents goes to the driver (bounded:
lengths above 512 are binned at a relative width of 1/256, so even lengths of
2**31 give under 6,500 bins).  A dynamic programme over it chooses the bucket
boundaries that minimise total padding.  Every document then joins the first
bucket that holds it, and batches of at most ``budget`` padded tokens are cut
inside each bucket, in the order of a seeded hash of the document or, with
``in_order``, in the order of the files that hold the documents and of their
rows, so that a mixture written before stays one in every batch.

Defined cases: null or empty text has 0 tokens and is packed like any other; a
document longer than ``budget`` is a batch of its own, whole; repeated rows are
packed each; fewer distinct lengths than ``buckets`` give as many buckets as
lengths; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocorr.llm.common import spread_rank, written

BUDGET = 65_536
BUCKETS = 16
FINE = 512  # lengths up to here have a bin each
TOKEN = r"[\p{L}\p{N}_]+|[^\p{L}\p{N}_\s]"  # a word, or one other character


def token_count(text: Column) -> Column:
    """Words and single punctuation characters of a text."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def length_bin(n: Column) -> Column:
    """Number of the histogram bin of a length; grows with the length."""
    octave = F.floor(F.log2(F.greatest(n, F.lit(FINE)).cast("double"))).cast("long")
    step = F.pow(F.lit(2.0), octave - 8).cast("long")
    base = F.pow(F.lit(2.0), octave.cast("double")).cast("long")
    return F.when(n <= FINE, n).otherwise(
        F.lit(FINE) + (octave - 9) * 256 + F.floor((n - base) / step).cast("long") + 1)


def boundaries(lengths: np.ndarray, rows: np.ndarray, buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` length ranges with the least total
    padding.  ``lengths`` (increasing) are the candidate bounds, ``rows`` the
    documents of each.  cost(i, j) = lengths[j] * rows in i..j is what bucket
    i..j takes padded; the sum of true lengths is constant."""
    m = len(lengths)
    if m == 0:
        return []
    total = np.concatenate([[0.0], np.cumsum(rows.astype(np.float64))])
    tall = lengths.astype(np.float64)
    best = tall * total[1:]
    cut = []
    for _ in range(min(buckets, m) - 1):
        nxt, frm = best.copy(), np.full(m, -1)
        # the best cut moves right with j, so halving j's range bounds the search
        todo = [(0, m - 1, 0, m - 1)]
        while todo:
            lo, hi, left, right = todo.pop()
            if lo > hi:
                continue
            j = (lo + hi) // 2
            stop = min(j - 1, right)
            at = left - 1
            if stop >= left:
                i = np.arange(left, stop + 1)
                cost = best[i] + tall[j] * (total[j + 1] - total[i + 1])
                at = left + int(np.argmin(cost))
                if cost[at - left] < nxt[j]:
                    nxt[j], frm[j] = cost[at - left], at
            at = max(at, left)
            todo += [(lo, j - 1, left, at), (j + 1, hi, at, right)]
        best = nxt
        cut.append(frm)
    out, j = [], m - 1
    for frm in reversed(cut):
        out.append(int(lengths[j]))
        if frm[j] < 0:
            return sorted(set(out))
        j = int(frm[j])
    out.append(int(lengths[j]))
    return sorted(set(out))


def pack(spark: SparkSession, docs: DataFrame, budget: int = BUDGET, buckets: int = BUCKETS,
         seed: int = 7, in_order: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_tokens, bucket (0..), bucket_len
    (what each document of the bucket is padded to), batch_id (within the
    bucket), slot (place in the batch), padding.  ``in_order`` needs ``docs``
    read from files; a file's rows of a bucket are numbered in one task."""
    order = ([F.col("_metadata.file_name").alias("__file"), F.col("_metadata.row_index").alias("__h")]
             if in_order else [F.xxhash64(F.lit(seed), "doc_id", "text").alias("__h")])
    sized = written(spark, docs.select(
        "doc_id", token_count(F.col("text")).alias("n_tokens"), *order), "lengths")
    hist = (sized.groupBy(length_bin(F.col("n_tokens")).alias("bin"))
            .agg(F.max("n_tokens").alias("length"), F.count(F.lit(1)).alias("n"))
            .orderBy("bin").collect())
    bounds = boundaries(np.array([r.length for r in hist], dtype=np.int64),
                        np.array([r.n for r in hist], dtype=np.int64), buckets)
    bucket, length = F.lit(len(bounds) - 1), F.lit(bounds[-1] if bounds else 0).cast("long")
    for i in reversed(range(len(bounds) - 1)):
        inside = F.col("n_tokens") <= bounds[i]
        bucket = F.when(inside, F.lit(i)).otherwise(bucket)
        length = F.when(inside, F.lit(bounds[i]).cast("long")).otherwise(length)
    placed = sized.withColumn("bucket", bucket).withColumn("bucket_len", length)
    ranked = spread_rank(spark, placed, ["bucket"], "__h", ["doc_id", "n_tokens"],
                         slices="__file" if in_order else None)
    room = F.greatest(F.lit(1).cast("long"),
                      F.floor(F.lit(budget) / F.greatest(F.col("bucket_len"), F.lit(1))).cast("long"))
    return ranked.select(
        "doc_id", "n_tokens", "bucket", "bucket_len",
        F.floor(F.col("rank") / room).cast("long").alias("batch_id"),
        (F.col("rank") % room).cast("long").alias("slot"),
        (F.col("bucket_len") - F.col("n_tokens")).alias("padding"))
