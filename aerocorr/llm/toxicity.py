"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic texts are the positives; other texts, whatever they are, are
unlabelled.  The risk of a classifier g with class prior p is

    p R+(g) + max(0, Ru(g) - p R-(g)),

where R+ and R- are the losses of the positives taken as positive and as
negative and Ru is the loss of the unlabelled taken as negative.  Where the
part in max() turns negative on a batch - the model starts to fit the unlabelled
toxic texts as clean - the step goes the other way (the non-negative
correction).

A text is the set of its words and the first 3 to 6 bytes of its words, hashed
to 2**20 features.  Those that positives have more often than negatives can
(their share among the unlabelled, less p times that of the positives) enter a
linear model.  Training reads at most ``MAX_POSITIVE`` and ``MAX_UNLABELLED``
documents, the ones with the smallest seeded hash of their id (documented
bound); scoring reads every text whole, on the executors, with the model's
weights (4 MB, a fixed size) broadcast.

Defined cases: a null or empty text gets the model's score of no features; a
label row that repeats is used once and a document whose label rows disagree
counts as toxic if any says so; without a confirmed toxic text every score is
the prior 0.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocorr.llm.common import chunks, words

FEATURES = 1 << 20
PREFIXES = (3, 4, 5, 6)
MAX_POSITIVE = 3_000
MAX_UNLABELLED = 9_000
MAX_SELECTED = 4_096
THRESHOLD = 0.3
FOLDS, HELD_OUT = 4, 2


def fold(id_col="doc_id"):
    return F.crc32(F.col(id_col).cast("string")) % FOLDS


def text_features(column):
    """(first row, feature numbers, bounds) of pieces of an Arrow text column;
    a text's distinct features are at bounds[i]:bounds[i + 1]."""
    for row, data, offsets in chunks(column):
        _, whole, short, at = words(data, offsets, prefixes=PREFIXES)
        count = len(offsets) - 1
        who = np.repeat(np.arange(count, dtype=np.int64), np.diff(at))
        f = np.concatenate([(h & np.uint64(FEATURES - 1)).astype(np.int64) + who * FEATURES
                            for h in [whole, *short]]) if len(whole) else np.zeros(0, np.int64)
        f = np.unique(f)
        yield row, (f % FEATURES).astype(np.int32), np.searchsorted(f, np.arange(count + 1) * FEATURES)


class Model(NamedTuple):
    weights: np.ndarray  # one per hashed feature, mostly 0
    bias: float


def scores(weights: np.ndarray, bias: float, column) -> np.ndarray:
    """Probability of every text of an Arrow column."""
    out = np.zeros(len(column))
    for row, f, bounds in text_features(column):
        z = np.concatenate([[0.0], np.cumsum(weights[f], dtype=np.float64)])
        z = z[bounds[1:]] - z[bounds[:-1]] + bias
        out[row:row + len(z)] = 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    return out


def share(rows: list[np.ndarray]) -> np.ndarray:
    """Share of the texts that have each feature."""
    n = np.zeros(FEATURES, dtype=np.int32)
    for f in rows:
        n[f] += 1
    return n / max(len(rows), 1)


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float, *,
          epochs: int = 12, min_steps: int = 1200, batch: int = 512, rate: float = 0.05,
          decay: float = 1e-3, seed: int = 3) -> Model:
    """Linear model with the logistic loss by mini-batch Adam on the
    non-negative risk; ``prior`` is an upper bound."""
    if not positive or not unlabelled:
        return Model(np.zeros(FEATURES, np.float32), -30.0)
    p, u = share(positive), share(unlabelled)
    n1, n0 = len(positive), len(unlabelled)
    # the unlabelled hold a feature at least prior * p times: common features of
    # the positives bound the prior where the labels do not tell it
    common = (p * n1 >= 10) & (p >= 0.1)
    if common.any():
        prior = max(1e-4, min(prior, float(((u + np.sqrt(u / n0) + 1 / n0)[common] / p[common]).min())))
    negative = np.clip((u - prior * p) / (1 - prior), 0, 1)  # never below none
    spread = np.sqrt(p * (1 - p) / n1 + negative * (1 - negative) / n0 + 1 / n0**2)
    # more positives bring more chance features, so the bar rises with them
    enough = (p * n1 >= 4) & (p - negative > (2 + min(2, n1 / 400)) * spread) & (p > 3 * negative)
    gain = (p - negative) / spread
    chosen = np.flatnonzero(enough)
    chosen = chosen[np.argsort(-gain[chosen], kind="stable")][:MAX_SELECTED]
    place = np.full(FEATURES, -1, dtype=np.int64)
    place[chosen] = np.arange(len(chosen))

    def matrix(rows):
        m = np.zeros((len(rows), len(chosen)), dtype=np.float32)
        for i, f in enumerate(rows):
            at = place[f]
            m[i, at[at >= 0]] = 1
        return m

    xp, xu = matrix(positive), matrix(unlabelled)
    rng = np.random.default_rng(seed)
    theta = np.zeros(len(chosen) + 1)
    theta[-1] = np.log(prior / (1 - prior))
    m1, m2, t = np.zeros_like(theta), np.zeros_like(theta), 0

    def part(x, sign):
        """Mean logistic loss of x taken as ``sign`` and its gradient."""
        z = sign * (x @ theta[:-1] + theta[-1])
        s = -sign / (1 + np.exp(np.clip(z, -30, 30)))
        return np.logaddexp(0, -z).mean(), np.append(x.T @ s, s.sum()) / len(x)

    steps = max(1, len(xu) // batch)
    epochs = max(epochs, -(-min_steps // steps))
    mean, kept = np.zeros_like(theta), 0
    for epoch in range(epochs):
        pu, pp = rng.permutation(len(xu)), rng.permutation(len(xp))
        for i in range(steps):
            a = xp[pp[i * len(xp) // steps:(i + 1) * len(xp) // steps] if len(xp) >= 8 * steps
                   else rng.integers(0, len(xp), min(len(xp), 64))]
            b = xu[pu[i * batch:(i + 1) * batch]]
            (_, g_pos), (l_neg, g_neg), (l_unl, g_unl) = part(a, 1), part(a, -1), part(b, -1)
            rest, g_rest = l_unl - prior * l_neg, g_unl - prior * g_neg
            grad = prior * g_pos + g_rest if rest >= 0 else -g_rest
            grad[:-1] += decay * theta[:-1]
            t += 1
            m1 = 0.9 * m1 + 0.1 * grad
            m2 = 0.999 * m2 + 0.001 * grad**2
            theta -= rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.999**t)) + 1e-8)
            np.maximum(theta[:-1], 0, out=theta[:-1])  # the features chosen speak for toxicity only
            if 2 * epoch >= epochs:  # the model is the mean over the second half
                mean, kept = mean + theta, kept + 1
    weights = np.zeros(FEATURES, dtype=np.float32)
    weights[chosen] = mean[:-1] / kept
    return Model(weights, float(mean[-1] / kept))


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, *,
        max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED, seed: int = 5) -> Model:
    """Model from the labels outside the held-out fold.  Features are made on
    the executors; the driver gets those of the bounded sample."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()
                          & (fold() != HELD_OUT))
             .groupBy("doc_id").agg(F.max("toxic").alias("__y")))
    order = F.xxhash64(F.lit(seed), "doc_id")
    n, toxic = known.agg(F.count(F.lit(1)), F.sum(F.when(F.col("__y") > 0, 1).otherwise(0))).first()
    picked = (known.where("__y > 0").orderBy(order).limit(max_positive).select("doc_id", F.lit(1).alias("__p"))
              .unionByName(docs.where(F.col("doc_id").isNotNull() & (fold() != HELD_OUT))
                           .select("doc_id").distinct().orderBy(order).limit(max_unlabelled)
                           .select("doc_id", F.lit(0).alias("__p"))))
    # at most max_positive + max_unlabelled ids
    some = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("__p", "text")

    def features(batches):
        for b in batches:
            kind = np.asarray(b.column("__p"))
            for row, f, bounds in text_features(b.column("text")):
                cut = [f[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(kind[row:row + len(cut)], pa.int32()),
                                                  pa.array(cut, pa.binary())], ["p", "f"])

    got = some.mapInArrow(features, "p int, f binary").toArrow()
    # copies of a text say no more than one of them; the arrays stay in Arrow's memory
    seen = {}
    for k, f in zip(got.column("p").to_pylist(), got.column("f")):
        view = np.frombuffer(f.as_buffer(), dtype=np.int32)
        seen[k, hashlib.md5(view, usedforsecurity=False).digest()] = view
    kind, rows = [k for k, _ in sorted(seen)], [seen[x] for x in sorted(seen)]
    prior = min(max((toxic or 0) / max(n, 1), 1e-4), 0.9)
    return train([r for r, k in zip(rows, kind) if k], [r for r, k in zip(rows, kind) if not k], prior)


def score(spark: SparkSession, docs: DataFrame, model: Model) -> DataFrame:
    """One row per row of ``docs``: doc_id and score."""
    shared = spark.sparkContext.broadcast(tuple(model))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(scores(*shared.value, b.column("text")))],
                ["doc_id", "score"])

    few = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return few.mapInArrow(run, "doc_id long, score double")


def judge(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``."""
    scored = score(spark, docs, fit(spark, docs, labels))
    return scored.select("doc_id", F.coalesce(fold() == HELD_OUT, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def clean_rows(spark: SparkSession, docs: DataFrame, labels: DataFrame,
               threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without those judged toxic, all columns kept, in one pass."""
    model = spark.sparkContext.broadcast(tuple(fit(spark, docs, labels)))

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(scores(*model.value, b.column("text")) < threshold))

    return docs.mapInArrow(run, docs.schema)
