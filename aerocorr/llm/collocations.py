"""Phrase collocation mining by dynamic itemset counting.

Texts are lower-cased (A-Z), cut into pieces at ``. , ; : ! ?`` and line ends,
and into words.  All counts are per language.  The corpus is cut into shards,
ranges of doc_id, which are scanned in a cycle; one scan is one step.  Words are
counted from step 0.  A phrase of k words starts to be counted in the step after
both its subphrases of k - 1 words have reached ``least``, and is counted for
one full cycle, so its count is whole while lengths are interleaved: most
phrases start long before the shorter ones have been counted out.  With S shards
there are at most S * length steps; the run ends when a
whole cycle has brought no new frequent phrase.

What a scan must know - the step in which a subphrase reached the threshold -
is a table of one byte a slot, a slot being the top bits of a phrase's key.  It
is sized once, by the words that reached the threshold in step 0, and has at
most ``SLOTS`` bytes.  Phrases that share a slot only start sooner, or are
counted without need; a slot once set stays, so a start never moves and every
phrase with frequent subphrases is counted for exactly one cycle.  A step adds
its counts (combined in the task, then by key) to the open ones; closed phrases
below the threshold go, and the table of the step before is removed.

Phrases are known by 64-bit hashes of their words and language.  A last scan
brings the strings and the subphrases' keys of the frequent phrases, by a table
of marks of at most ``SLOTS`` bytes and then by key.  It goes through the
documents in rounds of 1/64, 3/64, 12/64 and 48/64 of them by a hash, each naming
only phrases that no earlier round has named: a phrase is found in the round
that brings its first few occurrences, so names come in proportion to the
phrases, not to phrases times tasks.  Then come scores, the drop rule and the
top of each language; a histogram of scores leaves rows that cannot be among the
top out of the final sort.  Subphrases in many candidates (words, at most
``HOT`` of them by their share of all words) meet by broadcast.

Defined cases: a null or empty text has no words; a null language is ``und``;
every row counts, also rows that repeat a doc_id; a null doc_id belongs to the
first shard; phrases do not cross pieces, so a long text is worked on in runs of
whole pieces; ties in score and count go to the smaller phrase (UTF-8 bytes);
an empty table gives no rows.  Columns other than those three are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerocorr.config import work_dir
from aerocorr.llm.common import chunks, heavy_join, mix, words
from aerocorr.operators.joins import size_checked_broadcast
from aerocorr.sources.commits import remove

LEAST = 10
LENGTH = 3
SHARDS = 3
TOP = 2000
INSIDE_PERCENT = 50
SLOTS, LEAST_SLOTS = 1 << 24, 1 << 16  # powers of two
HOT = 4096
NEVER = 255
ROUNDS = (1, 4, 16, 64)  # of 64 parts of the documents, where a round of the last scan ends
LANGS = 1 << 16  # languages whose bounds in the score histogram are broadcast
BEST = 1_000_000  # the highest score: a <= l and a <= r
PIECE = 1 << 20  # bytes of text worked on at a time
HELD = 1 << 21  # keys kept in a task before they are handed on
BATCH = 1 << 15  # rows handed on at a time, as Arrow holds a batch outside the heap

WORD = r"[^ \t.,;:!?\n\x0B\f\r]+"
_SEP = np.zeros(256, dtype=bool)
_SEP[list(b".,;:!?\n\x0b\x0c\r")] = True
_FLAT = np.arange(256, dtype=np.uint8)
_FLAT[_SEP] = 32
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ROLE = np.random.Generator(np.random.PCG64(12)).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _pieces(column, limit: int):
    """(row numbers, bytes, offsets): runs of whole texts of about ``limit``
    bytes; a longer text is cut behind separators."""
    for row, data, offsets in chunks(column, limit):
        if len(offsets) > 2 or len(data) <= limit:
            yield np.arange(row, row + len(offsets) - 1), data, offsets
            continue
        ends = np.flatnonzero(_SEP[data]) + 1
        a = 0
        while a < len(data):
            i = np.searchsorted(ends, a + limit, side="right") - 1  # the last end within the limit
            if i < 0 or ends[i] <= a:
                i = np.searchsorted(ends, a, side="right")  # else the next one
            b = int(ends[i]) if i < len(ends) else len(data)
            yield np.array([row]), data[a:b], np.array([0, b - a])
            a = b


def seed(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode(), digest_size=8).digest(), "little")


def phrases(rows, data, offsets, seeds, length: int):
    """Keys of all phrases of 1 to ``length`` words: for each k the numbers of
    their first words and their keys by first word; then the words' first bytes
    and the number of the text of each."""
    first, whole, _, bounds = words(_FLAT[data], offsets)
    text = np.repeat(np.arange(len(rows)), np.diff(bounds))
    word = mix(whole ^ seeds[rows[text]]) if len(first) else whole
    piece = np.cumsum(_SEP[data], dtype=np.int32)[first] + text * (len(data) + 1)
    out = [(np.arange(len(first)), word)]
    total = word * _ROLE[0]
    for k in range(2, length + 1):
        n = max(len(first) - k + 1, 0)
        total = total[:n] + word[k - 1:] * _ROLE[k - 1]
        out.append((np.flatnonzero(piece[:n] == piece[k - 1:]), mix(total + np.uint64(k))))
    return out, first, text


def _of(batch):
    langs = batch.column("lang").to_pylist()
    known = {x: seed(x) for x in set(langs)}
    return langs, np.array([known[x] for x in langs], dtype=np.uint64)


def _slot(key, slots):
    """The slot of a key: its top bits."""
    return (key >> np.uint64(65 - len(slots).bit_length())).astype(np.int64)


def _slices(batch):
    for a in range(0, batch.num_rows, BATCH):
        yield batch.slice(a, BATCH)


def _count(step: int, shards: int, length: int, table):
    """Batches (lang, text) -> (key, n, start) of the phrases counted in ``step``."""
    def emit(held):
        for start in sorted(held):
            key = np.sort(np.concatenate(held[start]))
            head = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            n = np.diff(np.append(head, len(key)))
            yield from _slices(pa.RecordBatch.from_arrays(
                [pa.array(key[head].view(np.int64)), pa.array(n),
                 pa.array(np.full(len(head), start, np.int32))], ["key", "n", "start"]))

    def run(batches):
        held, size = {}, 0
        slots = None if table is None else table.value
        for batch in batches:
            _, seeds = _of(batch)
            for rows, data, offsets in _pieces(batch.column("text"), PIECE):
                all_keys, _, _ = phrases(rows, data, offsets, seeds, length if step else 1)
                found = [(0, all_keys[0][1])] if step < shards else []
                for (_, shorter), (at, keys) in zip(all_keys, all_keys[1:]):
                    reached = slots[_slot(shorter, slots)]
                    start = np.maximum(reached[at], reached[at + 1])
                    found += [(x + 1, keys[at[start == x]]) for x in range(max(0, step - shards), step)]
                for start, keys in found:
                    if len(keys):
                        held.setdefault(start, []).append(keys)
                        size += len(keys)
                if size > HELD:
                    yield from emit(held)
                    held, size = {}, 0
        yield from emit(held)
    return run


NAMES = pa.schema([("key", pa.int64()), ("lang", pa.string()), ("words", pa.int32()), ("phrase", pa.string()),
                   ("heads", pa.list_(pa.int64())), ("tails", pa.list_(pa.int64()))])


def _marked(key, marks):
    """Whether keys may be frequent phrases: both their top and their low bits are marked."""
    return (marks[_slot(key, marks)] & 1 > 0) & (marks[key & np.uint64(len(marks) - 1)] & 2 > 0)


def _name(length: int, table):
    """Batches -> the marked phrases of two words or more, with their strings and
    the keys of both parts at each cut."""
    def lists(keys, size):
        flat = np.stack(keys, axis=1).ravel().view(np.int64)
        return pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, size), pa.int32()), pa.array(flat))

    def run(batches):
        marks = table.value
        seen = np.zeros(0, np.uint64)  # what this task has named, in order
        for batch in batches:
            langs, seeds = _of(batch)
            for rows, data, offsets in _pieces(batch.column("text"), PIECE):
                all_keys, first, text = phrases(rows, data, offsets, seeds, length)
                if not len(first):
                    continue
                gap = np.sort(np.concatenate([np.flatnonzero((_FLAT[data] == 32) | (data == 9)), offsets[1:]]))
                end = gap[np.searchsorted(gap, first, side="right")]  # a word ends at the next gap or end of text
                low = _LOWER[data].tobytes()
                for k, (at, keys) in enumerate(all_keys[1:], 2):
                    on = at[_marked(keys[at], marks)]
                    key, where = np.unique(keys[on], return_index=True)
                    place = np.searchsorted(seen, key)
                    new = np.ones(len(key), bool)
                    inside = place < len(seen)
                    new[inside] = seen[place[inside]] != key[inside]
                    key, where = key[new], on[where[new]]
                    if not len(key):
                        continue
                    seen = np.sort(np.concatenate([seen, key]))
                    for some in range(0, len(key), BATCH):
                        at, x = where[some:some + BATCH], key[some:some + BATCH]
                        parts = [[low[a:b] for a, b in zip(first[at + j].tolist(), end[at + j].tolist())]
                                 for j in range(k)]
                        yield pa.RecordBatch.from_arrays([
                            pa.array(x.view(np.int64)),
                            pa.array([langs[i] for i in rows[text[at]].tolist()], pa.string()),
                            pa.array(np.full(len(x), k, np.int32)),
                            pa.array([b" ".join(y) for y in zip(*parts)], pa.binary()).cast(pa.string()),
                            lists([all_keys[c - 1][1][at] for c in range(1, k)], k - 1),
                            lists([all_keys[k - c - 1][1][at + c] for c in range(1, k)], k - 1)], schema=NAMES)
                if len(seen) > HELD:
                    seen = seen[:0]
    return run


def marked(keys: DataFrame, size: int):
    """One byte a slot: bit 1 for the top bits of a key, bit 2 for its low ones.
    The driver gets the slots as bits, at most ``size`` / 4 bytes."""
    both = keys.select(F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.shiftrightunsigned("key", 65 - size.bit_length()).alias("slot")),
        F.struct(F.lit(1).alias("side"), F.col("key").bitwiseAND(F.lit(size - 1)).alias("slot")))).alias("x"))
    bits = (both.groupBy("x.side", F.shiftright("x.slot", 6).alias("block"))
            .agg(F.expr("bit_or(shiftleft(1L, cast(x.slot & 63 as int)))").alias("bits")).toArrow())
    out = np.zeros((2, max(size >> 6, 1)), np.int64)
    out[bits["side"].to_numpy(), bits["block"].to_numpy()] = bits["bits"].to_numpy()
    top, low = np.unpackbits(out.view(np.uint8), axis=1, bitorder="little")[:, :size]
    return top | low << 1


def named(spark: SparkSession, few: DataFrame, keys: DataFrame, length: int) -> DataFrame:
    """Each phrase of ``keys`` once, with its language, words and the keys of its parts."""
    dealt = F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS[-1]))
    size = min(SLOTS, max(LEAST_SLOTS, 1 << (16 * keys.count()).bit_length()))
    names, last = None, 0
    for i, end in enumerate(ROUNDS):
        if names is not None:
            path = work_dir(spark, f"phrases_to_name_{i}")
            keys.join(names.select("key"), "key", "left_anti").write.parquet(path)
            keys = spark.read.parquet(path)
        marks = marked(keys, size)
        if names is not None and not marks.any():
            break
        sent = spark.sparkContext.broadcast(marks)
        part = few.where((dealt >= last) & (dealt < end)).select("lang", "text")
        path = work_dir(spark, f"phrase_names_{i}")
        (part.mapInArrow(_name(length, sent), "key long, lang string, words int, phrase string, "
                         "heads array<long>, tails array<long>")
            .join(keys, "key", "left_semi").distinct().write.parquet(path))
        sent.destroy()
        more = spark.read.parquet(path)
        names, last = more if names is None else names.unionByName(more), end
    return names


def _step(score, a):
    """A number that never falls as (score, a) rises; few different ones.  Scores
    below 32 and the highest, which many phrases share, are divided by a."""
    by_a = F.floor(F.log2(a.cast("double")) * 8)
    some = F.lit(32_000) + F.floor(F.log2(score.cast("double")) * 32)
    return (F.when(score >= BEST, F.lit(33_000) + by_a).when(score >= 32, some)
            .otherwise(score * 1000 + by_a).cast("int"))


def leading(rows: DataFrame, top: int) -> DataFrame:
    """``rows`` (lang, a, w.score) without those that cannot be among the first
    ``top`` of their language: below the step at which ``top`` are reached."""
    rows = rows.withColumn("step", _step(F.col("w.score"), F.col("a")))
    steps = rows.groupBy("lang", "step").agg(F.count(F.lit(1)).alias("rows"))
    above = F.sum("rows").over(Window.partitionBy("lang").orderBy(F.desc("step"))) - F.col("rows")
    least = (steps.withColumn("above", above).where(F.col("above") < top)
             .groupBy(F.col("lang").alias("of")).agg(F.min("step").alias("least")))
    least = size_checked_broadcast(least, LANGS)  # else all rows of a language meet in one task
    return rows.join(least, (F.col("lang") == F.col("of")) & (F.col("step") >= F.col("least"))).drop(
        "of", "least", "step")


COUNTED = "key long, n long, start int, reach int, closed boolean"


def counted(spark: SparkSession, few: DataFrame, least: int, length: int, shards: int):
    """The cyclic scans over ``few`` (doc_id, lang, text): frequent phrases
    (key, n, whether of several words) as a list of tables."""
    low, high = few.agg(F.min("doc_id"), F.max("doc_id")).first()
    low, high = (0, 0) if low is None else (low, high)
    cuts = [low + (high - low + 1) * i // shards for i in range(shards)]

    def shard(i):
        cond = F.lit(True) if i == 0 else F.col("doc_id") >= cuts[i]
        if i + 1 < shards:
            cond = cond & (F.col("doc_id") < cuts[i + 1])
        return few.where(cond | F.col("doc_id").isNull() if i == 0 else cond).select("lang", "text")

    sc = spark.sparkContext
    slots, sent, done, last, newest, step = None, None, [], None, 0, 0
    while True:
        rows = shard(step % shards).mapInArrow(_count(step, shards, length, sent), "key long, n long, start int")
        rows = rows.withColumn("reach", F.lit(None).cast("int"))
        if last is not None:
            rows = rows.unionByName(now.where("not closed").drop("closed"))
        path = work_dir(spark, f"phrases_{step}")
        (rows.groupBy("key").agg(F.sum("n").alias("n"), F.min("start").alias("start"), F.min("reach").alias("reach"))
            .withColumn("reach", F.coalesce("reach", F.when(F.col("n") >= least, F.lit(step))))
            .withColumn("closed", F.col("start") + (shards - 1) <= step)
            .where(~F.col("closed") | (F.col("n") >= least))
            .write.partitionBy("closed").parquet(path))
        if last is not None:
            remove(spark, f"{last}/closed=false")
        now = spark.read.schema(COUNTED).parquet(path)
        done.append(now.where("closed").select("key", "n", (F.col("start") > 0).alias("several")))
        reached = now.where(F.col("reach") == step)
        if slots is None:
            size = min(SLOTS, max(LEAST_SLOTS, 1 << (64 * reached.count()).bit_length()))
            slots = np.full(size, NEVER, np.uint8)
        new = reached.select(F.shiftrightunsigned("key", 65 - len(slots).bit_length()).cast("int").alias("slot")).distinct()
        new = new.toArrow()["slot"].to_numpy()  # at most one row a slot
        slots[new[slots[new] == NEVER]] = step
        if sent is not None:
            sent.destroy()
        sent = sc.broadcast(slots)
        newest = step if len(new) else newest
        if step + 1 == shards * length or step >= max(newest + shards, shards - 1):
            sent.destroy()
            return done  # what the newest keys let start has had its cycle
        last, step = path, step + 1


def collocations(spark: SparkSession, docs: DataFrame, least: int = LEAST, length: int = LENGTH,
                 top: int = TOP, inside_percent: int = INSIDE_PERCENT, shards: int = SHARDS) -> DataFrame:
    """The first ``top`` phrases of each language by score: lang, rank, phrase,
    a (its count), l and r (counts of both parts at the lowest-scoring cut), n
    (words of the language), score = floor(1000000 a a / (l r))."""
    few = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    done = counted(spark, few, least, length, shards)
    counts = done[0]
    for more in done[1:]:
        counts = counts.unionByName(more)
    path = work_dir(spark, "counted_phrases")
    counts.write.parquet(path)
    counts = spark.read.parquet(path)
    names = named(spark, few, counts.where("several").select("key"), length)
    size = few.groupBy(F.col("lang").alias("in_lang")).agg(F.sum(F.regexp_count("text", F.lit(WORD))).alias("n"))
    path = work_dir(spark, "phrase_words")
    size.write.parquet(path)
    size = spark.read.parquet(path)
    path = work_dir(spark, "frequent_phrases")
    names.join(counts.select("key", F.col("n").alias("a")), "key").write.parquet(path)
    found = spark.read.parquet(path)
    total = size.agg(F.sum("n")).first()[0] or 0
    hot = counts.where(F.col("n") * HOT >= total).select("key")  # at most HOT of each length
    part = lambda key, n: counts.select(F.col("key").alias(key), F.col("n").alias(n))
    cuts = found.select("key", "a", F.posexplode(F.arrays_zip("heads", "tails")).alias("k", "x"))
    path = work_dir(spark, "phrase_cuts")
    (heavy_join(cuts.select("key", "a", "k", F.col("x.heads").alias("head"), F.col("x.tails").alias("tail")),
                part("head", "l"), ["head"], hot.withColumnRenamed("key", "head")).write.parquet(path))
    cut = heavy_join(spark.read.parquet(path), part("tail", "r"), ["tail"], hot.withColumnRenamed("key", "tail"))
    d = lambda c: F.col(c).cast("decimal(19,0)")
    cut = cut.withColumn("aa", (d("a") * d("a") * F.lit(BEST).cast("decimal(7,0)")).cast("decimal(38,0)")) \
             .withColumn("lr", d("l") * d("r")).withColumn("score", F.expr("aa div lr"))
    worst = cut.groupBy("key").agg(F.min(F.struct("score", "k", "l", "r")).alias("w"))
    longer = (found.where("words > 2").select(F.explode(F.array(F.element_at("heads", -1), F.element_at("tails", 1)))
                                              .alias("in_key"), "a")
              .groupBy("in_key").agg(F.max("a").alias("most")))
    kept = (found.join(worst, "key").join(longer, F.col("key") == F.col("in_key"), "left")
            .where(F.col("most").isNull() | (100 * F.col("most") < inside_percent * F.col("a"))))
    path = work_dir(spark, "kept_phrases")
    kept.select("lang", "phrase", "a", "w").write.parquet(path)
    kept = leading(spark.read.parquet(path), top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("w.score"), F.desc("a"), "phrase"))
    best = kept.select("lang", "phrase", "a", "w", rank.cast("long").alias("rank")).where(F.col("rank") <= top)
    return best.join(size, F.col("lang") == F.col("in_lang")).select(
        "lang", "rank", "phrase", "a", F.col("w.l").alias("l"), F.col("w.r").alias("r"), "n",
        F.col("w.score").alias("score"))
