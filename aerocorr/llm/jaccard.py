"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document's set is its distinct 5-word shingles.  Two documents link when
|A & B| / |A | B| >= 0.8.  If they do, then for every l their l-prefixes - the
first |A| - ceil(0.8 |A|) + l elements in one global order, rare shingles
first - share at least l elements.  A longer prefix costs more postings but
asks for more matches before anything is verified; each document takes the l
with the smallest estimated cost.

1. One pass gives each document its set's size and the 64-bit key of its set;
   equal sets form a class, known by that key.  The pass also
   finds shingles that are frequent in some piece of the input; the ``HOT``
   most frequent of those are known everywhere (a fixed size).
2. A second pass deals the shingles out by hash, packed as bytes (40 bits next
   to the number of the part, 64 bits for hot ones) with the 64-bit key of
   their class, and counts classes per shingle.  There are as many parts as
   keep a part, one group in a worker, at about ``PART`` shingles.  Only shingles of several
   classes come back as rows: a document has few, and one with more than 20 %
   shingles of its own cannot link and stops here.  Copies are combined in the
   piece and again in the part, so a class of any size is counted once.
3. Linear links: every prefix posting list names its most
   typical documents (the least own shingles) of two components, every document
   is verified against the one it shares most lists with, and components are
   formed.  A group of thousands of near copies collapses here without its
   pairs being formed.
4. The rest, exactly: postings of lists that still hold several components
   meet in a self-join over different components only, with the length filter,
   the own-shingle filter, the multi-match count over prefixes cut for the pair's
   sizes, then verification.

Links inside a component found in step 3 need no verification, as the result is
the component.

Defined cases: null text, empty text and text without words have an empty set
and link with nothing; a text of fewer than 5 words has its whole sequence as
its one shingle; every row is judged by its own text, also where rows repeat a
doc_id; a null doc_id joins its class and component but never names one (null
if they have no other).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocorr.llm.common import (chunks, connected_components, mix, shingles, shuffle_partitions,
                                 words, written)

_SALT = np.uint64(0x243F6A8885A308D3)

K = 5
PERCENT = 80
HOT = 65_536
PART = 1_000_000  # shingles counted in a Python worker at a time: about 100 MB
MAX_MATCH = 8  # l goes from 1 to this; a longer prefix never pays beyond
VERIFY_COST = 0.02  # per element of a set, against 1 per posting


def _sets(batch: pa.RecordBatch, k: int):
    """(row numbers, sets) of pieces of a batch with columns doc_id, text."""
    for row, data, offsets in chunks(batch.column("text")):
        _, whole, _, bounds = words(data, offsets)
        yield row, shingles(whole, bounds, k)


def _keys(sets):
    """Size and two independent 64-bit sums of every set."""
    n = np.array([len(s) for s in sets], dtype=np.int64)
    s1 = np.array([mix(s ^ _SALT).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
    s2 = np.array([mix(s + _SALT).sum(dtype=np.uint64) for s in sets], dtype=np.uint64)
    return n, s1.view(np.int64), s2.view(np.int64)


def _distinct(sets):
    """Numbers of the first of each different non-empty set."""
    n, s1, _ = _keys(sets)
    _, first = np.unique(s1, return_index=True)
    return np.sort(first[n[first] > 0]), s1


def _profile(k: int, share: float):
    """Batches -> (doc_id, mark, n, s1, s2) for each document, and (token,
    times) for shingles in at least ``share`` of a piece's different sets."""
    def run(batches):
        for batch in batches:
            ids, marks = batch.column("doc_id"), batch.column("mark")
            for row, sets in _sets(batch, k):
                yield _rows(ids.slice(row, len(sets)), marks.slice(row, len(sets)), *_keys(sets), False)
                pick, _ = _distinct(sets)
                if len(pick):
                    token, times = np.unique(np.concatenate([sets[i] for i in pick]),
                                             return_counts=True)
                    some = times >= max(8, share * len(pick))
                    token = token[some].view(np.int64)
                    yield _rows(pa.array(token), pa.array(token), times[some], token, token, True)
    return run


def _rows(ids, marks, n, s1, s2, hot):
    return pa.RecordBatch.from_arrays(
        [ids.cast(pa.int64()), marks, pa.array(n.astype(np.int64)), pa.array(s1), pa.array(s2),
         pa.array(np.full(len(n), hot))], ["doc_id", "mark", "n", "s1", "s2", "hot"])


PACKED = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("sizes", pa.binary()),
                    ("low", pa.binary()), ("high", pa.binary())])


def _deal(k: int, parts: int, hot):
    """Batches -> packed shingles by part; parts below 0 hold the hot ones (8
    bytes each), spread by piece."""
    def run(batches):
        known = hot.value
        for batch in batches:
            for _, sets in _sets(batch, k):
                pick, key = _distinct(sets)
                if not len(pick):
                    continue
                key = key[pick]
                who = np.repeat(np.arange(len(pick)), [len(sets[i]) for i in pick])
                token = np.concatenate([sets[i] for i in pick])
                if len(known):
                    at = np.minimum(np.searchsorted(known, token), len(known) - 1)
                    is_hot = known[at] == token
                else:
                    is_hot = np.zeros(len(token), bool)
                out = []
                if is_hot.any():
                    d, c = np.unique(who[is_hot], return_counts=True)
                    out.append((-1 - int(key[0]) % parts, key[d].tobytes(),
                                c.astype(np.int32).tobytes(), token[is_hot].tobytes(), b""))
                who, token = who[~is_hot], token[~is_hot]
                part = (token >> np.uint64(40)).astype(np.int64) % parts
                order = np.argsort(part, kind="stable")  # stays in document order inside a part
                part, who, token = part[order], who[order], token[order]
                cut = np.searchsorted(part, np.arange(parts + 1))
                for p in np.flatnonzero(np.diff(cut)):
                    a, b = cut[p], cut[p + 1]
                    d, c = np.unique(who[a:b], return_counts=True)
                    t = token[a:b]
                    out.append((int(p), key[d].tobytes(), c.astype(np.int32).tobytes(),
                                (t & np.uint64(0xFFFFFFFF)).astype(np.uint32).tobytes(),
                                ((t >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8).tobytes()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), PACKED.types)], schema=PACKED)
    return run


def _count(hot, times):
    """One part's packed shingles -> (s1, token, df) where df >= 2."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        part = int(pdf["part"].iloc[0])
        key = np.repeat(np.frombuffer(b"".join(pdf["keys"]), dtype=np.int64),
                        np.frombuffer(b"".join(pdf["sizes"]), dtype=np.int32))
        if part < 0:
            token = np.frombuffer(b"".join(pdf["low"]), dtype=np.uint64)
        else:
            token = (np.frombuffer(b"".join(pdf["low"]), dtype=np.uint32).astype(np.uint64)
                     | (np.frombuffer(b"".join(pdf["high"]), dtype=np.uint8).astype(np.uint64)
                        << np.uint64(32)))
        order = np.lexsort((key, token))
        key, token = key[order], token[order]
        first = np.ones(len(key), bool)
        first[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
        key, token = key[first], token[first]
        if part < 0:
            df = times.value[np.searchsorted(hot.value, token)]
        else:
            start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
            count = np.diff(np.append(start, len(token)))
            df = np.repeat(count, count)
            keep = df >= 2
            token = token[keep] | (np.uint64(part & 0x3FFFFF) << np.uint64(40))
            key, df = key[keep], df[keep]
        return pd.DataFrame({"s1": key, "token": token.view(np.int64), "df": df})
    return run


def profiles(spark: SparkSession, docs: DataFrame, k: int, hot_share: float):
    """(doc_id, mark, n, s1, s2) of every row; the hot shingles in order; their counts."""
    marked = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"), "text")
    seen = written(spark, marked.mapInArrow(
        _profile(k, hot_share), "doc_id long, mark long, n long, s1 long, s2 long, hot boolean"), "sets")
    hot = (seen.where("hot").groupBy(F.col("doc_id").alias("token")).agg(F.sum("n").alias("times"))
           .orderBy(F.desc("times"), "token").limit(HOT).toPandas())
    token = hot["token"].to_numpy(dtype=np.int64).view(np.uint64)
    order = np.argsort(token)
    return (seen.where("not hot").drop("hot"), token[order],
            np.maximum(2, hot["times"].to_numpy(dtype=np.int64)[order]))


def shared_elements(spark: SparkSession, docs: DataFrame, k: int, hot: np.ndarray,
                    times: np.ndarray, total: int) -> DataFrame:
    """(s1, token, df): every shingle that at least two classes have.  ``total``:
    shingles of all rows, which decides the number of parts, so that a part (one
    group in a Python worker) holds about ``PART`` of them whatever the input."""
    sc = spark.sparkContext
    known, counts = sc.broadcast(hot), sc.broadcast(times)  # at most HOT entries of 8 bytes
    parts = max(shuffle_partitions(spark), -(-total // PART))
    packed = docs.mapInArrow(_deal(k, parts, known),
                             "part int, keys binary, sizes binary, low binary, high binary")
    return packed.groupBy("part").applyInPandas(_count(known, counts), "s1 long, token long, df long")


def needed(n):
    """Least overlap of a set of ``n`` with any set it links to."""
    return F.ceil(n * PERCENT / 100.0)


def overlap(na, nb):
    """Least overlap of two linked sets: 100 i >= 80 (na + nb - i)."""
    return F.ceil((na + nb) * PERCENT / (100.0 + PERCENT))


def prefixes(sets: DataFrame) -> DataFrame:
    """Adds l (the chosen number of matches) and own (shingles of the class
    alone, which come first in the order).  ``cand`` of l is bounded by the
    postings of the l-prefix over l, since a candidate needs l of them."""
    base = F.col("n") - needed(F.col("n")) - F.col("own")
    like = F.col("n") - overlap(F.col("n"), F.col("n")) - F.col("own")  # against sets of this size
    options = []
    for l in range(1, MAX_MATCH + 1):
        postings = F.aggregate(F.slice("dfs", 1, F.greatest(like + l, F.lit(0)).cast("int")),
                               F.lit(0.0), lambda a, x: a + x)
        cost = F.when(needed(F.col("n")) >= l, postings * (1 + VERIFY_COST * F.col("n") / l))
        options.append(F.struct(F.coalesce(cost, F.lit(float("inf"))).alias("cost"),
                                F.lit(l).alias("l")))
    return sets.withColumn("l", F.array_min(F.array(*options))["l"]).withColumn(
        "base", base.cast("int"))


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b) of ``pairs`` that link, by the exact overlap of their shared elements."""
    a = sets.select(F.col("rep").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    b = sets.select(F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    return (pairs.join(a, "a").join(b, "b")
            .where(100 * both >= PERCENT * (F.col("na") + F.col("nb") - both)).select("a", "b"))


def index(sets: DataFrame) -> DataFrame:
    """Prefix elements: token, rep, n, own, l, place (1.. in the global order,
    own shingles counted)."""
    entry = F.posexplode(F.slice("tokens", 1, F.greatest(F.col("base") + MAX_MATCH, F.lit(0))))
    return (sets.select("rep", "n", "own", "l", entry.alias("pos", "token"))
            .withColumn("place", F.col("own") + F.col("pos") + 1).drop("pos"))


def typical_pairs(entries: DataFrame) -> DataFrame:
    """Each document with the head, of another component, of the lists it
    shares most.  A list's heads are its most typical document and the most
    typical one outside that one's component: rows stay linear."""
    best = F.min(F.struct((F.col("own") / F.col("n")).alias("r"), F.col("rep").alias("b"),
                          F.col("comp").alias("cb"))).alias("h")
    heads = entries.groupBy("token", "comp").agg(best)
    one = heads.groupBy("token").agg(F.min("h").alias("h"), F.count(F.lit(1)).alias("m")).where("m > 1")
    first = one.select(F.col("token").alias("t1"), F.col("h.cb").alias("c1"))
    two = (heads.join(first, (F.col("token") == F.col("t1")) & (F.col("comp") != F.col("c1")))
           .groupBy("token").agg(F.min("h").alias("h")))
    either = one.select("token", "h.*").join(
        two.select("token", F.col("h.b").alias("b2")), "token").select("token", "b", "cb", "b2")
    votes = (entries.select("token", F.col("rep").alias("a"), "comp").join(either, "token")
             .select("a", F.when(F.col("comp") != F.col("cb"), F.col("b")).otherwise(F.col("b2")).alias("b"))
             .groupBy("a", "b").agg(F.count(F.lit(1)).alias("v")))
    return votes.groupBy("a").agg(F.max_by("b", F.struct("v", F.bitwise_not("b"))).alias("b"))


def candidate_pairs(entries: DataFrame) -> DataFrame:
    """(a, b) over different ``comp`` that share at least l (of a) elements in
    their l-prefixes.  Once both sizes are known the pair needs an overlap of
    o >= 0.8 |A|, so its prefixes end at |A| - o + l and |B| - o + l."""
    mixed = entries.groupBy("token").agg(F.min("comp").alias("c1"), F.max("comp").alias("c2")).where(
        "c1 <> c2").select("token")
    left = entries.join(mixed, "token", "left_semi")
    y = left.select("token", F.col("rep").alias("b"), F.col("n").alias("nb"), F.col("own").alias("ob"),
                    F.col("place").alias("pb"), F.col("comp").alias("cb"))
    x = left.select("token", F.col("rep").alias("a"), F.col("n").alias("na"), F.col("own").alias("oa"),
                    F.col("place").alias("pa"), "l", F.col("comp").alias("ca"))
    o = overlap(F.col("na"), F.col("nb"))
    pairs = x.join(y, "token").where(
        (F.col("ca") != F.col("cb"))
        & ((F.col("nb") < F.col("na")) | ((F.col("nb") == F.col("na")) & (F.col("b") < F.col("a"))))
        & (100 * F.col("nb") >= PERCENT * F.col("na"))
        & (F.col("na") - F.col("oa") >= o) & (F.col("nb") - F.col("ob") >= o)
        & (F.col("pa") <= F.col("na") - o + F.col("l")) & (F.col("pb") <= F.col("nb") - o + F.col("l")))
    return (pairs.groupBy("a", "b", "l").agg(F.count(F.lit(1)).alias("m"))
            .where("m >= l").select("a", "b"))


def _grouped(spark: SparkSession, docs: DataFrame, k: int, hot_share: float) -> DataFrame:
    """One row per row of ``docs``: doc_id, mark (hash of the text), n, rep
    (smallest doc_id of the class) and comp (key of the component; NULL without
    shingles).  A class is known by its key, never by a doc_id, so rows that
    repeat a doc_id with other texts are not mixed up."""
    few = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    seen, hot, times = profiles(spark, few, k, hot_share)
    total = seen.agg(F.sum("n")).first()[0] or 0
    classes = written(spark, seen.where("n > 0").groupBy("s1").agg(
        F.max("n").alias("n"), F.min("doc_id").alias("rep")), "classes")
    near = (shared_elements(spark, few, k, hot, times, total)
            .join(classes.select("s1", "n"), "s1").withColumnRenamed("s1", "rep")
            .groupBy("rep", "n")
            .agg(F.sort_array(F.collect_set(F.struct("df", "token"))).alias("e"))
            .where(F.size("e") >= needed(F.col("n")))
            .select("rep", "n", F.col("e.token").alias("tokens"), F.col("e.df").alias("dfs"),
                    (F.col("n") - F.size("e")).alias("own")))
    sets = written(spark, prefixes(near).drop("dfs"), "near_sets")
    entries = written(spark, index(sets), "prefixes")
    found = written(spark, verified(typical_pairs(entries.withColumn("comp", F.col("rep"))), sets),
                    "links")
    start = connected_components(spark, found)
    labelled = entries.join(start, entries.rep == start.node, "left").select(
        *entries.columns, F.coalesce("comp", "rep").alias("comp"))
    links = found.unionByName(verified(candidate_pairs(labelled), sets))
    comp = connected_components(spark, links)
    named = classes.select("s1", "rep").join(comp, F.col("s1") == F.col("node"), "left").select(
        F.col("s1").alias("key"), "rep", F.coalesce("comp", "s1").alias("comp"))
    return written(spark, seen.join(named, (F.col("s1") == F.col("key")) & (F.col("n") > 0), "left")
                   .select("doc_id", "mark", "n", "rep", "comp"), "groups")


def near_groups(spark: SparkSession, docs: DataFrame, k: int = K, hot_share: float = 0.01) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest
    doc_id reachable), class_id (smallest doc_id with the same set)."""
    groups = _grouped(spark, docs, k, hot_share)
    least = groups.where("comp is not null").groupBy(F.col("comp").alias("c")).agg(
        F.min("doc_id").alias("component_id"))
    alone = F.col("comp").isNull()
    return groups.join(least, groups.comp == least.c, "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("rep")).alias("class_id"))


def first_of_each(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """``docs`` with one document of each component: its smallest doc_id, of
    several rows with that id those of one text.  Texts without words, linked
    with nothing, all stay."""
    groups = _grouped(spark, docs, K, 0.01)
    rows = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    stay = (groups.where("comp is not null").groupBy("comp").agg(F.min(rows).alias("r"))
            .select(F.col("r.doc_id").alias("__id"), F.col("r.mark").alias("__mark"))
            .unionByName(groups.where("comp is null").select(
                F.col("doc_id").alias("__id"), F.col("mark").alias("__mark")).distinct()))
    mark = F.xxhash64(F.coalesce(F.col("text"), F.lit("")))
    return docs.join(stay, F.col("doc_id").eqNullSafe(F.col("__id")) & (mark == F.col("__mark")), "left_semi")
