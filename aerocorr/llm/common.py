"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerocorr.config import work_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later uses re-read
    files, so neither a lost executor nor a second use recomputes the plan."""
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def unit_slice(h: Column, n: int) -> Column:
    """Slice 0..n-1 of a 64-bit hash, increasing with the hash, so slices in
    order hold the rows in hash order."""
    top = F.shiftright(h, 33) + F.lit(1 << 30)  # 31 bits, in signed order
    return F.shiftright(top * n, 31).cast("int")


def spread_rank(spark: SparkSession, df: DataFrame, keys: Sequence[str], order: str,
                ties: Sequence[str] = (), out: str = "rank", slices: str | None = None) -> DataFrame:
    """0-based rank of every row within its ``keys``, in the order of the
    64-bit hash column ``order``.

    A key may hold a third of all rows, so no key is ranked in one task: the
    hash range is cut into slices, rows are numbered inside (key, slice) and
    the slices' counts are added up (a table of keys x slices rows).  With
    ``slices``, a column, its values in order are the slices and ``order`` counts
    inside them.  ``df`` is read twice; hand in a written table."""
    n = 2 * shuffle_partitions(spark)
    cut = df.withColumn("__slice", F.col(slices) if slices else unit_slice(F.col(order), n))
    sizes = cut.groupBy(*keys, "__slice").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__slice").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sizes.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                          F.col("__slice").alias("__s"),
                          F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__start"))
    inside = Window.partitionBy(*keys, "__slice").orderBy(order, *ties)
    ranked = cut.withColumn("__r", F.row_number().over(inside) - 1)
    on = (F.col("__slice") == F.col("__s"))
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    return (ranked.join(starts, on)
            .withColumn(out, (F.col("__start") + F.col("__r")).cast("long"))
            .drop("__slice", "__s", "__start", "__r", *[f"__k{i}" for i in range(len(keys))]))


def heavy_join(big: DataFrame, small: DataFrame, on: Sequence[str], hot: DataFrame) -> DataFrame:
    """Inner join of ``big`` with ``small`` (one row per key) where a key may
    hold a third of ``big``.  ``hot`` (columns ``on``, distinct) names the heavy
    keys; it must be bounded by how it was made, e.g. by a least share of all
    rows.  They meet by broadcast and leave no key to one task; the others
    shuffle.  ``big`` is read twice; hand in a written table."""
    on = list(on)
    few = small.join(F.broadcast(hot), on, "left_semi")
    return big.join(F.broadcast(few), on).unionByName(
        big.join(F.broadcast(hot), on, "left_anti").join(small, on))


def connected_components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable over the undirected ``edges``
    (a, b).  Every round takes the smallest label among the neighbours and
    then jumps to the label's own label; rounds are written tables.  Only the
    count of changed labels reaches the driver."""
    both = written(spark, edges.select("a", "b").where("a <> b")
                   .unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
                                .where("a <> b")).distinct(), "links")
    labels = written(spark, both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("a"), F.min("b")).alias("comp")), "labels")
    while True:
        near = (both.join(labels, both.b == labels.node)
                .groupBy("a").agg(F.min("comp").alias("m")))
        low = labels.join(near, labels.node == near.a, "left").select(
            "node", F.col("comp").alias("old"), F.least("comp", F.coalesce("m", "comp")).alias("l"))
        jump = labels.select(F.col("node").alias("n2"), F.col("comp").alias("c2"))
        nxt = written(spark, low.join(jump, low.l == jump.n2, "left").select(
            "node", "old", F.least("l", F.coalesce("c2", "l")).alias("comp")), "labels")
        moved = nxt.where("comp <> old").limit(1).count()
        labels = nxt.select("node", "comp")
        if not moved:
            return labels


# --- 64-bit hashes of the words of many texts at once (numpy, inside tasks) ---

_RNG = np.random.Generator(np.random.PCG64(20240501))
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = _BYTE.copy()
_LOWER[65:91] = _BYTE[97:123]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
_STEP = 0x9E3779B97F4A7C15
_POWERS = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """1, g, g**2, ... modulo 2**64, at least ``n`` of them."""
    global _POWERS
    if len(_POWERS) < n:
        size = max(1024, 1 << (n - 1).bit_length())
        _POWERS = np.cumprod(np.concatenate([[np.uint64(1)],
                                             np.full(size - 1, _STEP, dtype=np.uint64)]))
    return _POWERS


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (shifts and odd multipliers)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def chunks(column, limit: int = 2_000_000):
    """Cut an Arrow string column into pieces of about ``limit`` bytes: yields
    (first row, bytes, offsets), null texts as empty."""
    import pyarrow as pa
    import pyarrow.compute as pc
    for part in (column.chunks if isinstance(column, pa.ChunkedArray) else [column]):
        part = pc.fill_null(part.cast(pa.large_string()), "")
        base = np.frombuffer(part.buffers()[1], dtype=np.int64,
                             count=len(part) + 1 + part.offset)[part.offset:]
        data = (np.frombuffer(part.buffers()[2], dtype=np.uint8)
                if part.buffers()[2] is not None else np.zeros(0, np.uint8))
        row = 0
        while row < len(part):
            end = int(np.searchsorted(base, base[row] + limit, side="right")) - 1
            end = min(max(end, row + 1), len(part))
            yield row, data[base[row]:base[end]], base[row:end + 1] - base[row]
            row = end


def words(data: np.ndarray, offsets: np.ndarray, lower: bool = True, prefixes: Sequence[int] = ()):
    """Words (runs of bytes other than space, tab..carriage return) of the
    texts cut out of ``data`` by ``offsets``: their start, their hash, hashes
    of their first k bytes for k in ``prefixes``, and for every text the index
    of its first word (one more entry than texts)."""
    n = len(data)
    if n == 0:
        none = np.zeros(0, np.uint64)
        return np.zeros(0, np.int64), none, [none for _ in prefixes], np.zeros(len(offsets), np.int64)
    solid = ~_SPACE[data]
    edge = np.zeros(n, dtype=bool)
    edge[0] = True
    edge[1:] = ~solid[:-1]
    inner = offsets[:-1]
    edge[inner[inner < n]] = True
    first = np.flatnonzero(edge & solid)
    if len(first) == 0:
        none = np.zeros(0, np.uint64)
        return first, none, [none for _ in prefixes], np.zeros(len(offsets), np.int64)
    begin = np.zeros(n, dtype=np.int32)
    begin[first] = first
    np.maximum.accumulate(begin, out=begin)
    place = np.arange(n, dtype=np.int32) - begin
    place[:first[0]] = 0
    place[~solid] = 0
    value = (_LOWER if lower else _BYTE)[data] * powers(int(place.max()) + 1)[place]
    value[~solid] = 0
    whole = mix(np.add.reduceat(value, first))
    short = []
    for k in prefixes:
        short.append(mix(np.add.reduceat(np.where(place < k, value, np.uint64(0)), first)
                         + np.uint64(k)))
    return first, whole, short, np.searchsorted(first, offsets)


_ROLE = _RNG.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(whole: np.ndarray, bounds: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """For every text the sorted distinct hashes of its runs of ``k`` words;
    a text of fewer words has its whole sequence as the one run."""
    total = len(whole)
    run = np.zeros(max(total - k + 1, 0), dtype=np.uint64)
    for i in range(k):
        run += whole[i:i + len(run)] * _ROLE[i]
    run = mix(run)
    out = []
    for a, b in zip(bounds[:-1], bounds[1:]):
        if b - a >= k:
            out.append(np.unique(run[a:b - k + 1]))
        elif b > a:
            part = (whole[a:b] * _ROLE[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mix(np.array([part], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
