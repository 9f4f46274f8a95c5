"""Document fingerprints by consistent weighted sampling.

The terms of a text are its words (runs without space, tab..carriage return),
weighted by how often they occur.  For every sample number j a term k with
weight S draws r, c ~ Gamma(2, 1) and b ~ U(0, 1) from a hash of (k, j) alone and
takes

    t = floor(ln S / r + b),   ln a = ln c - r (t - b) - r;

the sample of the text is the (k, t) with the smallest a.  Two texts agree in a
sample with a probability equal to their generalised Jaccard similarity, the
sum of min(S) over the sum of max(S).  A Gamma(2, 1) is -ln(u v) for uniform
u, v.  SQL functions only: one 64-bit number holds a (fixed point, 2**-31) above 24 bits
of a hash of (k, t), so a sample is a plain min().

Each text meets its neighbour in the order of descending doc_id by one shuffle:
doc_id ranges (their bounds are approximate quantiles) become partitions, and
the first row of every range also goes to the end of the range before it.  Terms
are counted and sampled inside the partition; texts move once.

Defined cases: null counts as empty; a text without words has the fingerprint
of all zeros, is like another such text to 1 and like any other to 0; rows of
equal doc_id follow each other in the order of a hash of their text; null
doc_ids come last; a table of one row is its own neighbour.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerocorr.llm.common import shuffle_partitions

SAMPLES = 48  # a multiple of AT_ONCE
AT_ONCE = 4  # samples worked out by one row: the generated code stays small enough for the JIT
WORD_GAP = r"[\x20\x09-\x0D]+"
EMPTY = (1 << 62) + 0  # above every sample of a term; its 24 bits are zero


def draws(terms: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and, for samples j = 0.. of the number ``g``, own_j and cut_j:
    the draws of a term taken with its weights (ln_own, ln_cut; null: not in
    that text).  In steps, so that no draw is worked out twice."""
    js = range(AT_ONCE)

    def unit(bits: Column, size: int) -> Column:
        return (bits.cast("double") + 0.5) / float(1 << size)

    col = lambda name: lambda j: F.col(f"{name}{j}")
    one, two, r, c, b = map(col, ("one", "two", "r", "c", "b"))
    low21, low32 = F.lit((1 << 21) - 1), F.lit((1 << 32) - 1)
    base = [*keys, "term", "ln_own", "ln_cut"]
    seeded = terms.select(*base, F.xxhash64("term", "g").alias("h"))
    hashed = seeded.select(*base, *[
        F.xxhash64(F.col("h").bitwiseXOR(F.lit((2 * j + i + 1) * 0x1F3D5B79))).alias(f"{name}{j}")
        for j in js for i, name in enumerate(("one", "two"))])
    drawn = hashed.select(*base, *[
        (-F.ln(unit(one(j).bitwiseAND(low21), 21)
               * unit(F.shiftrightunsigned(one(j), 21).bitwiseAND(low21), 21))).alias(f"r{j}")
        for j in js], *[
        F.ln(-F.ln(unit(F.shiftrightunsigned(one(j), 42), 22)
                   * unit(two(j).bitwiseAND(low32), 32))).alias(f"c{j}") for j in js], *[
        unit(F.shiftrightunsigned(two(j), 32), 32).alias(f"b{j}") for j in js])
    kinds = ("own", "cut")
    steps = drawn.select("*", *[F.floor(F.col(f"ln_{k}") / r(j) + b(j)).alias(f"t_{k}{j}")
                                for k in kinds for j in js])
    t = lambda k, j: F.col(f"t_{k}{j}")
    return steps.select(*keys, *[
        F.shiftleft(F.floor((c(j) - r(j) * (t(k, j) - b(j) + 1.0)) * float(1 << 31)), 24)
        .bitwiseOR(F.col("term").bitwiseXOR(t(k, j)).bitwiseAND(F.lit((1 << 24) - 1))).alias(f"{k}{j}")
        for k in kinds for j in js])


def likeness(a: list[Column], b: list[Column]) -> Column:
    same = sum(((x == y).cast("int") for x, y in zip(a, b)), F.lit(0))
    return same.cast("double") / len(a)


def print_of(samples: list[Column]) -> Column:
    return F.concat(*[F.lower(F.lpad(F.hex(s.bitwiseAND(F.lit((1 << 24) - 1))), 6, "0"))
                      for s in samples])


def ranges(rows: DataFrame, n: int) -> tuple[Column, DataFrame | None]:
    """The range number of a doc_id (larger ids, larger numbers); None if there
    are no rows."""
    cuts = rows.agg(F.percentile_approx("doc_id", [i / n for i in range(1, n)], 100 * n)).first()[0]
    cuts = sorted(set(cuts or []))
    if not cuts:
        return F.lit(0)
    step = math.isqrt(len(cuts)) + 1  # look up in two short lists, not one long one
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    below = lambda xs: F.size(F.filter(xs, lambda c: c <= F.col("doc_id")))
    top = F.greatest(below(longs([g[0] for g in groups])), F.lit(1))
    inner = F.element_at(F.array(*[longs(g) for g in groups]), top)
    return F.coalesce((top - 1) * step + below(inner), F.lit(0))


def with_next(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """part, place (in the part), ghost, doc_id, text, next_text: every row and,
    as ghosts, the rows that stand for the start of the next part."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    parts = 4 * shuffle_partitions(spark)  # small enough for the terms of one to stay in memory
    part = ranges(rows, parts)
    firsts = rows.groupBy(part.alias("part")).agg(F.max("doc_id").alias("head")).orderBy("part").collect()
    # the first row of a part follows the last of the next higher part; one row per part
    after = [(f.head, firsts[(i + 1) % len(firsts)].part) for i, f in enumerate(firsts)]
    ghosts = spark.createDataFrame(after, "head long, to int")
    dealt = (rows.withColumn("part", part)
             .join(F.broadcast(ghosts), F.col("doc_id").eqNullSafe(F.col("head")), "left")
             .select("doc_id", "text", F.explode(F.when(
                 F.col("to").isNull(), F.array(F.struct(F.col("part"), F.lit(0).alias("ghost"))))
                 .otherwise(F.array(F.struct(F.col("part"), F.lit(0).alias("ghost")),
                                    F.struct(F.col("to").alias("part"), F.lit(1).alias("ghost")))))
                 .alias("p")).select("p.part", "p.ghost", "doc_id", "text").repartitionById(parts, F.col("part")))
    order = Window.partitionBy("part").orderBy("ghost", F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    return dealt.select("part", "ghost", "doc_id", "text", F.row_number().over(order).alias("place"),
                        F.lead("text").over(order).alias("next_text"))


def sampled(texts: DataFrame, samples: int) -> DataFrame:
    """``texts`` (part, place, kind, text; kind 0 own, 1 edited) -> part,
    place, own, cut: the arrays of samples of both (null: no words)."""
    word = texts.select("part", "place", "kind", F.explode(F.split("text", WORD_GAP)).alias("w"))
    n = F.count(F.lit(1)).cast("double")
    terms = (word.where("w <> ''").groupBy("part", "place", F.xxhash64("w").alias("term"))
             .agg((n - F.sum("kind")).alias("n_own"), F.sum("kind").cast("double").alias("n_cut"))
             .select("part", "place", "term", F.ln("n_own").alias("ln_own"), F.ln("n_cut").alias("ln_cut")))
    keys = ["part", "place", "g"]
    few = terms.withColumn("g", F.explode(F.sequence(F.lit(0), F.lit(samples // AT_ONCE - 1))))
    names = [f"{k}{j}" for k in ("own", "cut") for j in range(AT_ONCE)]
    least = draws(few, keys).groupBy(*keys).agg(*[F.min(x).alias(x) for x in names])
    group = F.struct("g", F.array(*names[:AT_ONCE]).alias("own"), F.array(*names[AT_ONCE:]).alias("cut"))
    whole = least.groupBy("part", "place").agg(F.sort_array(F.collect_list(group)).alias("all"))
    return whole.select("part", "place", *[F.flatten(F.col(f"all.{k}")).alias(k)
                                           for k in ("own", "cut")])


def fingerprints(spark: SparkSession, docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next."""
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    laid = with_next(spark, docs).select(
        "part", "place", "ghost", "doc_id", "text", n.cast("long").alias("n_chars"),
        F.concat(F.substring(F.col("text"), F.lit(1), n - half),
                 F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half)).alias("edited"))
    both = laid.select("part", "place", F.explode(F.array(
        F.struct(F.lit(0).alias("kind"), "text"),
        F.struct(F.lit(1).alias("kind"), F.col("edited").alias("text")))).alias("x")).select(
        "part", "place", "x.kind", "x.text")
    got = sampled(both, samples)
    info = laid.select("part", "place", "ghost", "doc_id", "n_chars",
                       F.sha2("edited", 256).alias("edited_sha256"))
    filled = lambda k: F.transform(F.coalesce(k, F.array_repeat(F.lit(EMPTY), samples)),
                                   lambda x: F.coalesce(x, F.lit(EMPTY))).alias(k)
    prints = info.join(got, ["part", "place"], "left").select(*info.columns, filled("own"), filled("cut"))
    order = Window.partitionBy("part").orderBy("place")
    prints = prints.withColumn("follows", F.lead("own").over(order)).where("ghost = 0")
    at = lambda c: [F.col(c)[j] for j in range(samples)]
    return prints.select(
        "doc_id", "n_chars", "edited_sha256", print_of(at("own")).alias("fingerprint"),
        print_of(at("cut")).alias("edited_fingerprint"),
        likeness(at("own"), at("cut")).alias("near_edited"),
        likeness(at("own"), at("follows")).alias("near_next"))
