"""Mixing sources to target weights by a Pfair schedule.

Each source's documents are cut into blocks of ``block`` documents.  Time runs
in slots of one block.  With an integer weight a of ``period``, block j of a
source is released at slot floor(j * period / a) and due by
ceil((j + 1) * period / a); in each slot the released block with the earliest
deadline runs.  The weights add up to ``period``, so every deadline is met: at
any slot every source is less than one block away from its share.  The
schedule repeats after ``period`` slots, so only one period is worked out on
the driver (a fixed size) and block j of any source, however many there are,
gets its slot from block j mod a of that table.  Weights are rounded to
multiples of 1 / ``period``; no source gets less than one, which the largest
ones give up in proportion.

A source that runs out leaves its slots empty and the others go on in their
proportions: every document is placed, none twice.

Defined cases: a null source is a source of its own; a source without a target
takes part with weight by ``rows ** temperature``; a target for a source without
rows is an error, but with an empty table; beyond ``max_sources`` the smallest
sources without a target share one entry; repeated rows are placed each; extra
columns of any name pass unchanged; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocorr.llm.common import shuffle_partitions, spread_rank

BLOCK = 16
PERIOD = 1 << 17
MAX_SOURCES = 20_000
TEMPERATURE = 0.5


def integer_weights(weights: Mapping[str, float], period: int) -> dict[str, int]:
    """Weights as integers >= 1 that add up to ``period`` (largest remainder).
    Weights below one unit are raised to it; the others share what is left in
    proportion, so a target is met to 1 / ``period`` and what was raised."""
    out: dict[str, int] = {}
    large = dict(weights)
    while True:  # raising the small ones lowers the unit of the others
        left, total = period - len(out), sum(large.values())
        small = [s for s, w in large.items() if w * left < total]
        if not small:
            break
        for s in small:
            out[s] = 1
            del large[s]
    exact = {s: w * left / total for s, w in large.items()}
    out |= {s: int(x) for s, x in exact.items()}
    rest = period - sum(out.values())
    for s in sorted(exact, key=lambda s: (int(exact[s]) - exact[s], s))[:rest]:
        out[s] += 1
    return out


def schedule(weights: Mapping[str, int]) -> list[tuple[str, int, int]]:
    """(source, j, slot) of one period: earliest deadline first among the
    released blocks, ties by source."""
    period = sum(weights.values())
    waiting = [(0, s, 0) for s in weights]  # (release, source, j)
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []  # (deadline, source, j)
    out = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, s, j = heapq.heappop(waiting)
            heapq.heappush(ready, (-(-(j + 1) * period // weights[s]), s, j))
        _, s, j = heapq.heappop(ready)
        out.append((s, j, slot))
        if j + 1 < weights[s]:
            heapq.heappush(waiting, ((j + 1) * period // weights[s], s, j + 1))
    return out


def target_weights(docs: DataFrame, targets: Mapping[str, float] | None, temperature: float,
                   max_sources: int) -> tuple[dict[str, float], bool]:
    """Weight by source name, and whether small sources share the entry ''."""
    wanted = {key(s): float(w) for s, w in (targets or {}).items()}
    if any(not 0 < w < float("inf") for w in wanted.values()):
        raise ValueError("target weights must be positive and finite")
    sizes = docs.groupBy(name_of("source").alias("s")).agg(F.count(F.lit(1)).alias("n"))
    named = {r.s: float(r.n) ** temperature for r in
             sizes.where(F.col("s").isin(list(wanted))).collect()} if wanted else {}
    others = sizes.where(~F.col("s").isin(list(wanted))) if wanted else sizes
    top = others.orderBy(F.desc("n"), "s").limit(max_sources + 1).collect()
    if not named and not top:
        return {}, False
    if set(wanted) - set(named):
        raise ValueError(f"targets without rows: {sorted(s[1:] for s in set(wanted) - set(named))}")
    named |= wanted
    named |= {r.s: float(r.n) ** temperature for r in top[:max_sources]}
    pooled = len(top) > max_sources
    if pooled:
        rest = others.agg(F.sum("n")).first()[0] - sum(r.n for r in top[:max_sources])
        named[""] = float(rest) ** temperature
    return named, pooled


def key(source: str | None) -> str:
    return "n" if source is None else "s" + source


def name_of(source: str) -> Column:
    """:func:`key` of a column."""
    return F.when(F.col(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def mixed(spark: SparkSession, docs: DataFrame, targets: Mapping[str, float] | None = None, *,
          block: int = BLOCK, period: int = PERIOD, temperature: float = TEMPERATURE,
          max_sources: int = MAX_SOURCES, seed: int = 11) -> DataFrame:
    """row (the row of ``docs``), block, slot and place (inside the block).
    ``targets`` are relative weights; the order of the rows of a source is that
    of a seeded hash."""
    weights, pooled = target_weights(docs, targets, temperature, max_sources)
    whole = integer_weights(weights, max(period, 2 * len(weights))) if weights else {}
    total = sum(whole.values())
    plan = spark.createDataFrame(
        [(s, j, slot) for s, j, slot in schedule(whole)] if whole else [], "ps string, pj long, pslot long")
    weight = spark.createDataFrame([(s, a) for s, a in whole.items()], "ws string, a long")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), name_of("source").alias("name"),
                       F.xxhash64(F.lit(seed), "doc_id", "n_chars").alias("h"), F.col("doc_id").alias("tie_id"),
                       F.col("n_chars").alias("tie_chars"))
    if pooled:  # names that have no entry of their own take the shared one
        rows = (rows.join(F.broadcast(weight.select("ws")), F.col("name") == F.col("ws"), "left")
                .withColumn("name", F.coalesce("ws", F.lit(""))).drop("ws"))
    ranked = (spread_rank(spark, rows, ["name"], "h", ["tie_id", "tie_chars"], "rank")
              .withColumn("block", F.floor(F.col("rank") / block).cast("long")))
    # both tables are bounded by the larger of ``period`` and 2 * max_sources, and the targets
    known = ranked.join(F.broadcast(weight), F.col("name") == F.col("ws"))
    placed = known.join(F.broadcast(plan), (F.col("name") == F.col("ps"))
                        & (F.col("block") % F.col("a") == F.col("pj")))
    slot = F.floor(F.col("block") / F.col("a")).cast("long") * total + F.col("pslot")
    return placed.select("row", "block", slot.alias("slot"), (F.col("rank") % block).cast("int").alias("place"))


def mix_positions(spark: SparkSession, docs: DataFrame, targets=None, **options) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, block, slot, place."""
    few = docs.select("doc_id", "source", "n_chars")
    return mixed(spark, few, targets, **options).select("row.doc_id", "row.source", "block", "slot", "place")


def mix_rows(spark: SparkSession, docs: DataFrame, targets=None, **options) -> DataFrame:
    """The rows of ``docs`` in the order of the schedule: partitions hold
    consecutive slots and each is sorted, so files in order are the mix."""
    out = mixed(spark, docs, targets, **options)
    return (out.repartitionByRange(shuffle_partitions(spark), "slot", "place")
            .sortWithinPartitions("slot", "place").select("row.*"))
