"""Fuzzy repeated passages by collinear chaining.

1. Every text gives its minimisers: of each ``WINDOW`` successive runs of ``K``
   words (A-Z lowered) the one with the smallest hash, so two texts that share
   ``K + WINDOW - 1`` words in a row share a seed.
2. A seed's occurrences are matched with the one in its smallest doc_id, not
   with each other: rows stay linear however often a passage repeats.  The
   smallest doc_id may hold only a part of what two later ones share, so seeds
   with places that no passage of this first step covers are matched again by
   their runs of successive seeds, up to runs of ``LEAST`` words: a run meets
   the smallest doc_id that holds all of it, and the pairs found so are
   compared in all their seeds near the run.
3. The matches of each pair of documents are chained: a chain's score is K per
   match less the gaps between matches on both sides; the best predecessor is a
   prefix maximum in a Fenwick tree over the positions in the other text.
4. Chains are aligned on the words themselves: matches are extended to both
   sides, the gaps are aligned by longest common subsequence, and the chain is
   cut into segments of at least ``LEAST`` words with ``SIMILAR`` of them equal:
   a chain that bridges different text gives each of its passages.

One row per found passage.  The group of documents that share it hangs together
over the smallest doc_id that holds each part of it.

Defined cases: null and empty texts have no seeds; texts shorter than ``LEAST``
words cannot hold a passage; a seed that a document holds n times is matched at
all n places with the first place, and place by place, of the other; rows that repeat a doc_id are one document (their seeds are pooled, its
text is the one with the smallest hash), so a document is never matched with
itself; rows without doc_id take no part.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocorr.llm.common import _ROLE, chunks, mix, words, written
from aerocorr.operators.joins import key_filter

K = 8
WINDOW = 16
LEAST = 50  # words of a passage
SIMILAR = 0.8
GAP = 0.2  # cost of a skipped word on either side
BAND = 64  # longest gap that is aligned; longer ones count as unequal
DROP = 8  # an extension ends where its score falls so far below its best


def seeds_of(whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(seed, position) of a text's minimisers; the second and later places of
    a seed also count as numbered seeds of their own."""
    n = len(whole) - K + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    run = np.zeros(n, dtype=np.uint64)
    for i in range(K):
        run += whole[i:i + n] * _ROLE[i]
    run = mix(run)
    if n <= WINDOW:
        at = np.array([int(run.argmin())])
    else:
        view = np.lib.stride_tricks.sliding_window_view(run, WINDOW)
        at = np.unique(view.argmin(axis=1) + np.arange(n - WINDOW + 1))
    order = np.argsort(run[at], kind="stable")
    seed, at = run[at][order], at[order]
    begin = np.concatenate([[True], seed[1:] != seed[:-1]])
    number = np.arange(len(at)) - np.maximum.accumulate(np.where(begin, np.arange(len(at)), 0))
    again = number > 0
    numbered = mix(seed[again] + number[again].astype(np.uint64) * _ROLE[K])
    odd = np.uint64(1)  # marks numbered seeds
    return np.concatenate([seed & ~odd, numbered | odd]), np.concatenate([at, at[again]])


def _seeds(batches):
    for batch in batches:
        ids = np.asarray(batch.column("doc_id"), dtype=np.int64)
        for row, data, offsets in chunks(batch.column("text")):
            _, whole, _, at = words(data, offsets)
            docs, seeds, places = [], [], []
            for i in range(len(offsets) - 1):
                if at[i + 1] - at[i] >= LEAST:
                    s, p = seeds_of(whole[at[i]:at[i + 1]])
                    seeds.append(s)
                    places.append(p)
                    docs.append(np.full(len(s), ids[row + i]))
            if docs:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(seeds).view(np.int64)), pa.array(np.concatenate(docs)),
                     pa.array(np.concatenate(places).astype(np.int32))], ["seed", "doc_id", "pos"])


def shared_seeds(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """(seed, doc_id, pos, ref_id, ref_pos, n): the n places of seeds that
    several documents hold, with the first place in the smallest doc_id."""
    # dealt once by seed: the first places and their join read the same exchange
    found = docs.mapInArrow(_seeds, "seed long, doc_id long, pos int").repartition("seed")
    first = found.groupBy("seed").agg(
        F.min(F.struct("doc_id", "pos")).alias("f"), F.max("doc_id").alias("last"),
        F.count(F.lit(1)).alias("n")).where("last <> f.doc_id")
    return written(spark, found.join(first.select("seed", F.col("f.doc_id").alias("ref_id"),
                                                  F.col("f.pos").alias("ref_pos"), "n"), "seed"), "seeds")


def by_pair(both: DataFrame) -> DataFrame:
    """(doc_id, ref_id, at): per pair of documents the places of shared seeds."""
    return (both.groupBy("doc_id", "ref_id")
            .agg(F.collect_list(F.struct("pos", "ref_pos")).alias("at")).where("size(at) > 1"))


RUNS = "run long, doc_id long, pos int, end int, open boolean"


def _runs(batches):
    """Places of a document's seeds -> its runs of two and more successive
    seeds, as far as one that spans LEAST words; ``open`` where a place of the
    run is outside the passages.  Where all its seeds have met one stretch of
    one document, the first step has compared them, in this and in every other
    document that holds the run: it is left out.  Of equal runs inside a stretch
    that repeats one seed at even steps, the covered ones after the first are
    left out too: the first stands for them as the place others may meet."""
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    for batch in batches:
        for doc, at in zip(batch.column("doc_id").to_pylist(), batch.column("at")):
            flat = at.values
            pos, seed, ref, there, free = (np.asarray(flat.field(c).cast(pa.int64())) for c in (
                "pos", "seed", "ref_id", "ref_pos", "open"))
            pos, index = np.unique(pos, return_index=True)
            # of the same seed at successive words (one word repeated) the first and the last place
            same = (np.diff(pos) == 1) & (np.diff(seed[index]) == 0)
            ends = ~(np.concatenate([[False], same]) & np.concatenate([same, [False]]))
            pos, index = pos[ends], index[ends]
            seed, ref, there, free = seed[index].view(np.uint64), ref[index], there[index], free[index].cumsum()
            before = np.concatenate([[0], free])
            turn = (ref[1:] != ref[:-1]) | (np.diff(pos) != np.diff(there))
            turns = np.concatenate([[0], turn.cumsum()])  # places where the met stretch changes
            step = np.where(np.diff(seed) == 0, np.diff(pos), -np.arange(1, len(pos)))
            even = np.concatenate([[0, 0], (np.diff(step) == 0).cumsum()])[:len(pos)]  # steps like the one before
            key, r = seed.copy(), 1
            todo = np.arange(len(pos))  # starts whose run does not span LEAST words yet
            while True:
                todo = todo[todo + r < len(pos)]
                last = todo + r
                todo = todo[(pos[last - 1] + K - pos[todo] < LEAST) & (pos[last] - pos[last - 1] < LEAST)]
                if not len(todo):
                    break
                last = todo + r
                key[todo] = mix(key[todo] * _ROLE[1] + seed[last])
                new = todo[turns[last] > turns[todo]]
                last = new + r
                opens = before[last + 1] > before[new]
                wanted = opens | (even[last] - even[new] < r)
                new, last, opens = new[wanted], last[wanted], opens[wanted]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(
                        [key[new].view(np.int64), np.full(len(new), doc), pos[new], pos[last]], kinds)]
                    + [pa.array(opens)], [c.split()[0] for c in RUNS.split(", ")])
                r += 1


def rematched(spark: SparkSession, shared: DataFrame, passages: DataFrame) -> DataFrame:
    """(doc_id, ref_id, pos, ref_pos) of seeds with places outside the
    passages, matched by runs of successive seeds."""
    covered = passages.groupBy("doc_id").agg(F.collect_list(F.struct("start_word", "end_word")).alias("held"))
    # a seed of two places has nothing but the match of the first step
    marked = shared.where("n > 2 and seed % 2 = 0").join(covered, "doc_id", "left").select(
        "seed", "doc_id", "pos", "ref_id", "ref_pos", F.expr(
            "(doc_id <> ref_id or pos <> ref_pos) and (held is null or not exists(held, "
            f"h -> h.start_word <= pos and pos + {K} <= h.end_word))").alias("open"))
    few = written(spark, marked.join(marked.where("open").select("seed").distinct(), "seed"), "open")
    held = few.groupBy("doc_id").agg(F.collect_list(F.struct("pos", "seed", "ref_id", "ref_pos", "open")).alias("at"))
    runs = written(spark, held.mapInArrow(_runs, RUNS), "runs")
    first = runs.groupBy("run").agg(
        F.min(F.struct("doc_id", "pos", "end")).alias("f"), F.max("doc_id").alias("last"),
        F.max("open").alias("any")).where("last <> f.doc_id and any")
    met = written(spark, runs.where("open").join(first.select("run", "f"), "run").where("doc_id <> f.doc_id").select(
        "doc_id", F.col("f.doc_id").alias("ref_id"), "pos", "end", F.col("f.pos").alias("ref_pos"),
        F.col("f.end").alias("ref_end")), "met")
    ends = met.select("doc_id", "ref_id", "pos", "ref_pos").unionByName(
        met.select("doc_id", "ref_id", F.col("end").alias("pos"), F.col("ref_end").alias("ref_pos")))
    # the other seeds that a pair shares near its runs, by stretches of LEAST words
    first_part, last_part = (F.floor(F.col(c) / LEAST).cast("int") for c in ("pos", "end"))
    near = met.select("doc_id", "ref_id", F.explode(F.sequence(first_part - 1, last_part + 1)).alias("part")).distinct()
    mine = few.select("seed", "doc_id", "pos", first_part.alias("part"))
    theirs = few.groupBy("seed", F.col("doc_id").alias("ref_id")).agg(F.min("pos").alias("ref_pos"))
    others = near.join(mine, ["doc_id", "part"]).join(theirs, ["ref_id", "seed"]).select(
        "doc_id", "ref_id", "pos", "ref_pos")
    return ends.unionByName(others).distinct()


def chain(pos: np.ndarray, ref: np.ndarray) -> list[list[int]]:
    """Best disjoint collinear chains of the matches, as lists of indices in
    order.  With the gap cost GAP * (skipped here + skipped there), the best
    predecessor of a match maximises score + GAP * (pos + ref) among those
    before it on both sides: a prefix maximum over the ranks of ``ref``."""
    order = np.lexsort((ref, pos))
    rank = (np.searchsorted(np.unique(ref), ref) + 1).tolist()
    size = max(rank, default=0)
    tree = [(-1.0, -1)] * (size + 1)
    score, back, total = {}, {}, (pos + ref).tolist()
    place = pos.tolist()
    waiting: list[int] = []

    def insert(i):
        value, r = (score[i] + GAP * total[i], i), rank[i]
        while r <= size:
            if tree[r] < value:
                tree[r] = value
            r += r & -r

    for i in order.tolist():
        if waiting and place[waiting[0]] != place[i]:
            for j in waiting:
                insert(j)
            waiting = []
        best, r = (-1.0, -1), rank[i] - 1
        while r > 0:
            if tree[r] > best:
                best = tree[r]
            r -= r & -r
        gain = best[0] - GAP * total[i]
        score[i], back[i] = (K + gain, best[1]) if best[1] >= 0 and gain > 0 else (float(K), -1)
        waiting.append(i)
    used, out = set(), []
    for i in sorted(score, key=lambda i: (-score[i], place[i])):
        path = []
        while i >= 0 and i not in used:
            used.add(i)
            path.append(i)
            i = back[i]
        if len(path) > 1:
            out.append(path[::-1])
    return out


CHAINS = ("doc_id long, ref_id long, low int, high int, ref_low int, ref_high int, "
          "pos array<int>, ref_pos array<int>")


def _chains(batches):
    """Matches of pairs -> chains that an extension may bring to LEAST words,
    with the stretch of both texts that it can reach."""
    short = LEAST - 2 * (WINDOW - 1)
    for batch in batches:
        rows = []
        for doc, ref, at in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "ref_id", "at"))):
            pos = np.array([x["pos"] for x in at])
            there = np.array([x["ref_pos"] for x in at])
            for path in chain(pos, there):
                p, r = pos[path], there[path]
                if min(p[-1] - p[0], r[-1] - r[0]) + K >= short:
                    rows.append((doc, ref, max(0, int(p[0]) - LEAST), int(p[-1]) + K + LEAST,
                                 max(0, int(r[0]) - LEAST), int(r[-1]) + K + LEAST, p.tolist(), r.tolist()))
        if rows:
            kinds = [pa.int64()] * 2 + [pa.int32()] * 4 + [pa.list_(pa.int32())] * 2
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                ["doc_id", "ref_id", "low", "high", "ref_low", "ref_high", "pos", "ref_pos"])


def _stretches(batches):
    """Texts and the stretches wanted of them -> 4-byte hashes of their words."""
    for batch in batches:
        ids, wanted = batch.column("doc_id").to_pylist(), batch.column("wanted").to_pylist()
        out = []
        for row, data, offsets in chunks(batch.column("text")):
            _, whole, _, at = words(data, offsets)
            small = (whole >> np.uint64(32)).astype(np.uint32)
            for i in range(len(offsets) - 1):
                text = small[at[i]:at[i + 1]]
                out += [(ids[row + i], w["low"], w["high"], text[w["low"]:w["high"]].tobytes())
                        for w in wanted[row + i]]
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int32(), pa.int32(), pa.binary()])],
                ["doc_id", "low", "high", "words"])


def equal_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words aligned as equal between two stretches (longest
    common subsequence).  Stretches beyond BAND are compared place by place if
    equally long, else only as far as they go on from either end."""
    if len(a) == len(b):
        same = np.flatnonzero(a == b)
        if len(same) == len(a) or len(a) > BAND:
            return same, same
    none = np.zeros(0, np.int64)
    if not len(a) or not len(b):
        return none, none
    if max(len(a), len(b)) > BAND:
        n = extension(a, b)[0]
        m = extension(a[n:][::-1], b[n:][::-1])[0]
        head = np.flatnonzero(a[:n] == b[:n])
        tail = np.flatnonzero(a[len(a) - m:] == b[len(b) - m:])
        return np.concatenate([head, tail + len(a) - m]), np.concatenate([head, tail + len(b) - m])
    table = np.zeros((len(a) + 1, len(b) + 1), dtype=np.int32)
    for k, x in enumerate(a):
        table[k + 1, 1:] = np.maximum.accumulate(np.maximum(table[k, 1:], table[k, :-1] + (b == x)))
    at, there, i, j = [], [], len(a), len(b)
    while table[i, j]:
        if table[i - 1, j] == table[i, j]:
            i -= 1
        elif table[i, j - 1] == table[i, j]:
            j -= 1
        else:
            i, j = i - 1, j - 1
            at.append(i)
            there.append(j)
    return np.array(at[::-1], np.int64), np.array(there[::-1], np.int64)


def equal_words(a: np.ndarray, b: np.ndarray) -> int:
    """Number of words aligned as equal between two short stretches."""
    return len(equal_pairs(a, b)[0])


def extension(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """(words, equal words) by which a match goes on along two stretches."""
    n = min(len(a), len(b))
    if not n:
        return 0, 0
    same = a[:n] == b[:n]
    score = np.cumsum(np.where(same, 1, -2))
    best = np.maximum.accumulate(np.maximum(score, 0))
    stop = np.flatnonzero(best - score > DROP)
    score = score[:stop[0]] if len(stop) else score
    if not len(score) or score.max() <= 0:
        return 0, 0
    end = int(score.argmax()) + 1
    return end, int(same[:end].sum())


def aligned_pairs(a: np.ndarray, b: np.ndarray, pos: np.ndarray, ref: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the equal words of a chain whose matches are at ``pos`` and
    ``ref`` of the word hashes a and b, with what goes on at both ends."""
    s, t = int(pos[0]), int(ref[0])
    before = extension(a[:s][::-1], b[:t][::-1])[0]
    same = np.flatnonzero(a[s - before:s] == b[t - before:t])
    here, there = [same + s - before], [same + t - before]
    i, j = s, t
    for p, r in zip(pos.tolist(), ref.tolist()):
        left = K
        if p < i or r < j:  # overlaps the match before: only what is new counts
            skip = max(i - p, j - r)
            if skip >= K or (i - p) != (j - r):
                continue
            p, r, left = p + skip, r + skip, K - skip
        else:
            x, y = equal_pairs(a[i:p], b[j:r])
            here.append(x + i)
            there.append(y + j)
        here.append(np.arange(p, p + left))
        there.append(np.arange(r, r + left))
        i, j = p + left, r + left
    after = extension(a[i:], b[j:])[0]
    same = np.flatnonzero(a[i:i + after] == b[j:j + after])
    return np.concatenate([*here, same + i]), np.concatenate([*there, same + j])


def align(a: np.ndarray, b: np.ndarray, pos: np.ndarray, ref: np.ndarray) -> tuple[int, int, int, int, int]:
    """(start, end, start there, end there, equal words) of a whole chain."""
    x, y = aligned_pairs(a, b, pos, ref)
    return int(x[0]), int(x[-1]) + 1, int(y[0]), int(y[-1]) + 1, len(x)


def similar_segments(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int]]:
    """First and last index of disjoint segments of the equal words at x and y
    that have LEAST words with SIMILAR of them equal: the whole, else the
    longest one and then those on both sides of it.  A run of equal words is
    never cut, as a segment that reaches into it gains by taking all of it."""
    skipped = np.concatenate([[0], np.maximum(np.diff(x), np.diff(y)) - 1]).cumsum()
    k = np.arange(len(x))
    place = k + skipped  # column of the alignment
    high = (1 - SIMILAR) * (k + 1) - SIMILAR * skipped  # score up to and with a pair
    low = high - (1 - SIMILAR)
    out, todo = [], [(0, len(x))]
    while todo:
        f, e = todo.pop()
        if e - f < LEAST * SIMILAR:
            continue
        here, there = int(x[e - 1] - x[f]) + 1, int(y[e - 1] - y[f]) + 1
        if min(here, there) >= LEAST and e - f >= SIMILAR * max(here, there):
            out.append((f, e - 1))
            continue
        least = np.minimum.accumulate(low[f:e])
        start = np.searchsorted(-least, -(high[f:e] + 1e-9))
        long = place[f:e] - place[f:e][start]
        last = int(long.argmax())
        first = int(start[last])
        if long[last] + 1 < LEAST:
            continue
        if min(x[f + last] - x[f + first], y[f + last] - y[f + first]) + 1 >= LEAST:
            out.append((f + first, f + last))
        todo += [(f, f + first), (f + last + 1, e)]
    return sorted(out)


FOUND = ("doc_id long, ref_id long, start_word int, end_word int, ref_start int, ref_end int, "
         "n_words int, equal_words int, similarity double")


def _aligned(batches):
    for batch in batches:
        rows = []
        for x in batch.to_pylist():
            a, b = np.frombuffer(x["here"], np.uint32), np.frombuffer(x["there"], np.uint32)
            here, there = aligned_pairs(a, b, np.array(x["pos"]) - x["low"], np.array(x["ref_pos"]) - x["ref_low"])
            for i, j in similar_segments(here, there):
                s, e, t, f = (int(v) for v in (here[i], here[j] + 1, there[i], there[j] + 1))
                rows.append((x["doc_id"], x["ref_id"], s + x["low"], e + x["low"], t + x["ref_low"], f + x["ref_low"],
                             min(e - s, f - t), j - i + 1, (j - i + 1) / max(e - s, f - t)))
        if rows:
            kinds = [pa.int64()] * 2 + [pa.int32()] * 6 + [pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows), kinds)],
                [f.split()[0] for f in FOUND.split(", ")])


def passages_of(spark: SparkSession, few: DataFrame, both: DataFrame) -> DataFrame:
    """The passages that the matches (doc_id, ref_id, pos, ref_pos) lie in."""
    chains = written(spark, by_pair(both).mapInArrow(_chains, CHAINS), "chains")
    asked = written(spark, chains.select("doc_id", "low", "high")
                    .unionByName(chains.select(F.col("ref_id").alias("doc_id"), F.col("ref_low").alias("low"),
                                               F.col("ref_high").alias("high"))).distinct()
                    .groupBy("doc_id").agg(F.collect_list(F.struct("low", "high")).alias("wanted")), "asked")
    # only texts with a stretch to give are dealt
    held = key_filter(few, asked.select("doc_id"), "doc_id").join(asked, "doc_id").mapInArrow(
        _stretches, "doc_id long, low int, high int, words binary")
    # rows that repeat a doc_id: one stretch each; both joins read the same exchange
    held = held.repartition("doc_id", "low", "high").groupBy("doc_id", "low", "high").agg(F.min("words").alias("words"))
    here = held.withColumnRenamed("words", "here")
    there = held.select(F.col("doc_id").alias("ref_id"), F.col("low").alias("ref_low"),
                        F.col("high").alias("ref_high"), F.col("words").alias("there"))
    pairs = chains.join(here, ["doc_id", "low", "high"]).join(there, ["ref_id", "ref_low", "ref_high"])
    return pairs.select("doc_id", "ref_id", "low", "ref_low", "pos", "ref_pos", "here", "there").mapInArrow(
        _aligned, FOUND)


def repeated_passages(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """One row per passage of a document that an earlier document (smaller
    doc_id) holds too; places are numbers of words, ends exclusive."""
    few = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    shared = shared_seeds(spark, few)
    one = written(spark, passages_of(spark, few, shared.where("doc_id <> ref_id")), "passages")
    two = passages_of(spark, few, rematched(spark, shared, one))
    # what lies inside a passage of the first step is known
    held = one.groupBy("doc_id").agg(F.collect_list(F.struct("start_word", "end_word")).alias("held"))
    new = two.join(held, "doc_id", "left").where(
        "held is null or not exists(held, h -> h.start_word <= start_word and end_word <= h.end_word)")
    return one.unionByName(new.drop("held"))
