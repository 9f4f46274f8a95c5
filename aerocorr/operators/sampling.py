"""Bounded samples for plotting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aerocorr.config import ensure_checkpoint_dir


def random_sample(df: DataFrame, n: int, seed: int | None = 42) -> DataFrame:
    """``min(n, count)`` rows drawn without replacement: of a Bernoulli draw of a
    little more than ``n`` rows (six standard deviations, so a shorter result is
    next to impossible) the ``n`` with the smallest draws, wherever they lie.
    ``limit`` alone would favour the first partitions.  An empty input gives an
    empty result."""
    total = df.count()
    if total == 0:
        return df.limit(0)
    share = min(1.0, (n + 6.0 * n ** 0.5) / total)
    drawn = df.withColumn("_draw", F.rand(seed)).where(F.col("_draw") < F.lit(share))
    return drawn.orderBy("_draw").limit(n).drop("_draw")


def sample_hash(keys: Sequence[str]) -> Column:
    """Hex MD5 of the key columns joined with ``|`` - the sample order."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def exact_sample(df: DataFrame, n: int, keys: Sequence[str], oversample: float = 2.0,
                 expected_rows: int | None = None) -> DataFrame:
    """Exactly ``min(n, count)`` rows: those with the smallest ``md5`` of the
    key, reproducible on any engine.

    Instead of a global top-n (which gathers ``n`` rows per task into one
    task), rows whose hash falls below a threshold sized for about
    ``oversample * n`` rows are kept first; only that slice is checkpointed
    and ordered.  Every row left out hashes above every row kept, so the
    result is exact; if the slice is short the threshold doubles.
    ``expected_rows`` (an estimate is enough) saves the counting pass.
    ``keys`` should identify rows: rows sharing a key tie, and which of them
    falls inside the bound is then arbitrary."""
    ensure_checkpoint_dir(df.sparkSession)
    h = sample_hash(keys)
    total = df.count() if expected_rows is None else expected_rows
    if total <= n:
        return df.orderBy(h, *keys).limit(n)
    frac = min(1.0, oversample * n / total)
    while True:
        if frac >= 1.0:
            return df.orderBy(h, *keys).limit(n)
        bound = format(int(frac * 16 ** 12), "012x")
        cand = df.where(h < F.lit(bound)).checkpoint(eager=True)
        if cand.count() >= n:
            return cand.orderBy(sample_hash(keys), *keys).limit(n)
        frac *= 2.0
