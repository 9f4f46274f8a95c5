"""Distinct (value, attributes) rows, where a key holds many attribute rows.

Readings x tied cities grow with the square of the data, so the rows themselves
are never shuffled or written.  The distinct (value, key) pairs, no more than
readings, are dealt by their value; every row of a value then arises in one
task, which meets the attributes by broadcast and tells equal rows apart on its
own.  Tasks are sized by the rows that arise in them.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerocorr.config import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS
from aerocorr.operators.joins import row_bytes

TASK_ROWS = 2_000_000  # rows that arise in a task


def attached_rows(values: DataFrame, attributes: DataFrame, on: Sequence[str], by: str = "avg_p", *,
                  known: DataFrame | None = None, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                  max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """The distinct rows (``by`` and the attribute columns) of ``values`` (``by``,
    ``on``; distinct) and ``attributes`` (``on`` and further columns; distinct);
    with ``known``, rows that its pairs do not give yet.  NULLs of ``on`` meet
    nothing.  Attributes beyond the broadcast bounds come in blocks, cut by
    their own columns.  All three are read more than once: hand in written
    tables."""
    on = list(on)
    cols = [c for c in attributes.columns if c not in on]
    pairs = values.select(by, *on, F.lit(False).alias("_known"))
    if known is not None:
        # only known pairs of a value that comes again can give one of its rows
        pairs = pairs.unionByName(known.select(by, *on, F.lit(True).alias("_known")).join(
            values.select(by).distinct(), by, "left_semi"))
    n, size = attributes.agg(F.count(F.lit(1)), F.sum(row_bytes(attributes))).first()
    blocks = max(1, -(-n // max_broadcast_rows), -(-(size or 0) // max_broadcast_bytes))
    met = pairs.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).join(
        attributes.groupBy(*on).agg(F.count(F.lit(1)).alias("_m")), on)
    rows = met.agg(F.sum(F.col("_n") * F.col("_m"))).first()[0] or 0
    few = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = pairs.repartition(max(few, -(-rows // (blocks * TASK_ROWS))), by)
    cut = F.pmod(F.xxhash64(*cols), F.lit(blocks))
    out = []
    for block in range(blocks):
        part = attributes.where(cut == block) if blocks > 1 else attributes
        met = dealt.join(F.broadcast(part), on)
        if known is None:
            out.append(met.select(by, *cols).distinct())
        else:
            out.append(met.groupBy(by, *cols).agg(F.max("_known").alias("_known"))
                       .where(~F.col("_known")).drop("_known"))
    return reduce(DataFrame.unionByName, out)
