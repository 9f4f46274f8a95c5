"""Joins of the (huge) readings with per-sensor attribute tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerocorr.config import DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS

FILTER_PROBES = 4         # bits a key sets in the key filter
FILTER_BITS = 10          # bits for each key: about 1 % of absent keys pass
FILTER_WORDS = 1 << 20    # largest filter, 8 MB; with more keys more absent ones pass
_EXACT_KEYS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType,
               T.TimestampType, T.DecimalType)  # equal keys have equal hashes


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row in memory: 16, and 8 a column plus the length of what is
    not of fixed width (a nested value counts as its JSON text)."""
    sizes = [F.lit(16 + 8 * len(df.columns)).cast("long")]
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            sizes.append(F.coalesce(F.octet_length(F.col(f.name)), F.lit(0)))
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f.name)))), F.lit(0)))
    return reduce(lambda a, b: a + b, sizes)


def probe_size(df: DataFrame, max_rows: int) -> tuple[int, int]:
    """Rows and bytes of ``df``, of at most ``max_rows + 1`` rows of it."""
    n, size = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.sum(row_bytes(df))).first()
    return n, size or 0


def size_checked_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                           max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """``broadcast(df)`` when ``df`` provably holds at most ``max_rows`` rows and
    ``max_bytes`` bytes, else ``df`` unchanged (the join then shuffles and AQE
    splits skew).

    The probe reads at most ``max_rows + 1`` rows, so it stays cheap; call it on
    a materialized or otherwise small table."""
    n, size = probe_size(df, max_rows)
    return F.broadcast(df) if n <= max_rows and size <= max_bytes else df


def salted_join(big: DataFrame, small: DataFrame, key: str, buckets: int,
                how: str = "inner") -> DataFrame:
    """Equi-join that spreads every key of ``big`` over ``buckets`` shuffle
    partitions: ``big``'s rows are dealt out by their number in their partition,
    whatever they hold (a stuck sensor repeating one value is spread too), and
    ``small`` is replicated once per salt.  A key holding a third of ``big`` is
    split ``buckets`` ways instead of landing in one task.  ``big`` should be a
    scan or a written table, whose row order a recomputed task repeats."""
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports inner and left joins")
    salt = F.pmod(F.monotonically_increasing_id(), F.lit(buckets)).cast("int")
    b = big.withColumn("_salt", salt)
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return b.join(s, [key, "_salt"], how).drop("_salt")


def key_filter(big: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of ``big`` whose ``key`` may be in ``keys``: all that are, and
    about 1 % of the others.  A Bloom filter made by an aggregate over the
    distinct keys, one array of at most 8 MB whatever their number, tested in
    the scan before any shuffle.  Where the key's types differ, or are
    fractions, whose equal values may hash apart, ``big`` is returned as it is."""
    kind = keys.schema[key].dataType
    if big.schema[key].dataType != kind or not isinstance(kind, _EXACT_KEYS):
        return big
    n = keys.agg(F.approx_count_distinct(key)).first()[0]
    words = 1
    while words < min(FILTER_WORDS, max(n, 1) * FILTER_BITS / 64):
        words *= 2

    def places(column):
        hashes = [F.xxhash64(column, F.lit(i)) for i in range(FILTER_PROBES)]
        return [(h.bitwiseAND(F.lit(words - 1)), F.shiftrightunsigned(h, 58).cast("int")) for h in hashes]

    held = keys.where(F.col(key).isNotNull()).select(F.inline(F.array(*[
        F.struct(w.alias("word"), b.alias("bit")) for w, b in places(F.col(key))])))
    set_bits = held.groupBy("word").agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits"))
    every = big.sparkSession.range(words).withColumnRenamed("id", "word").join(set_bits, "word", "left")
    ordered = F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    table = every.agg(ordered.getField("bits").alias("bits")).scalar()
    tests = [F.getbit(F.get(table, w.cast("int")), b) == 1 for w, b in places(F.col(key))]
    return big.where(reduce(lambda a, b: a & b, tests))


def join_attributes(readings: DataFrame, attributes: DataFrame, key: str = "sensor_id",
                    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                    how: str = "inner", salt_buckets: int = 0,
                    max_broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Attach per-key attributes to every reading (one output row per reading
    and matching attribute row).  An attribute side small in rows and bytes is
    broadcast so the readings are never shuffled; a hot sensor then costs
    nothing extra.  Beyond the bounds the join shuffles; an inner join first
    drops readings without attributes by :func:`key_filter`.  With
    ``salt_buckets > 1`` every key is salted (:func:`salted_join`), otherwise
    AQE's skew-join splits oversized partitions at run time."""
    n, size = probe_size(attributes, max_broadcast_rows)
    if n <= max_broadcast_rows and size <= max_broadcast_bytes:
        return readings.join(F.broadcast(attributes), key, how)
    if how == "inner":
        readings = key_filter(readings, attributes, key)
    if salt_buckets > 1:
        return salted_join(readings, attributes, key, salt_buckets, how)
    return readings.join(attributes, key, how)
