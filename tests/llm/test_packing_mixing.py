import itertools
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from aerocorr.llm.common import spread_rank
from aerocorr.llm.mixing import PERIOD, integer_weights, mix_positions, mix_rows, schedule
from aerocorr.llm.packing import FINE, boundaries, length_bin, pack


def padded(lengths, rows, cuts):
    return sum(n * min(c for c in cuts if c >= x) for x, n in zip(lengths, rows))


@pytest.mark.parametrize("buckets", [1, 2, 3, 5])
def test_boundaries_are_optimal(buckets):
    rng = np.random.default_rng(buckets)
    for _ in range(20):
        lengths = np.sort(rng.choice(np.arange(1, 60), 9, replace=False))
        rows = rng.integers(1, 30, 9)
        best = min(padded(lengths, rows, [*c, lengths[-1]])
                   for k in range(buckets) for c in itertools.combinations(lengths[:-1].tolist(), k))
        got = boundaries(lengths, rows, buckets)
        assert len(got) <= buckets and got[-1] == lengths[-1]
        assert padded(lengths, rows, got) == best


def test_length_bins_grow_with_the_length(spark):
    rows = spark.range(0, 70_000).select("id", length_bin(F.col("id")).alias("b")).orderBy("id").collect()
    bins = [r.b for r in rows]
    assert all(b - a in (0, 1) for a, b in zip(bins, bins[1:]))
    assert bins[FINE] == FINE and max(Counter(bins).values()) <= 256


def test_pack_puts_every_row_in_one_slot(spark, messy):
    budget = 300
    got = pack(spark, messy, budget=budget, buckets=4).collect()
    assert sorted((r.doc_id or 0) for r in got) == sorted((r.doc_id or 0) for r in messy.collect())
    assert len({(r.bucket, r.batch_id, r.slot) for r in got}) == len(got)
    for (bucket, _), rows in itertools.groupby(sorted(got, key=lambda r: (r.bucket, r.batch_id)),
                                               key=lambda r: (r.bucket, r.batch_id)):
        rows = list(rows)
        assert all(0 <= r.padding == r.bucket_len - r.n_tokens for r in rows)
        assert len(rows) == 1 or sum(r.bucket_len for r in rows) <= budget


def test_spread_rank_matches_a_plain_rank(spark):
    df = spark.range(0, 3000).select((F.col("id") % 3).alias("k"), F.xxhash64("id").alias("h"), "id")
    got = spread_rank(spark, df, ["k"], "h").collect()
    groups = defaultdict(list)
    for r in got:
        groups[r.k].append(r)
    for rows in groups.values():
        assert [r.rank for r in sorted(rows, key=lambda r: r.h)] == list(range(len(rows)))


def test_schedule_stays_within_one_block():
    weights = integer_weights({"a": 0.5, "b": 0.31, "c": 0.17, "d": 0.02}, 200)
    period = sum(weights.values())
    assert period == 200 and min(weights.values()) >= 1
    done = Counter()
    for s, j, slot in schedule(weights):
        assert done[s] == j and slot < -(-(j + 1) * period // weights[s])
        done[s] += 1
        assert all(abs(done[x] - (slot + 1) * weights[x] / period) < 1 for x in weights)
    assert done == weights


def test_mix_follows_targets_and_places_every_row(spark):
    docs = spark.range(0, 4000).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"),
        F.when(F.col("id") < 3000, "big").when(F.col("id") < 3600, "mid").otherwise(None).alias("source"),
        F.lit(1).cast("long").alias("n_chars"))
    got = mix_positions(spark, docs, {"big": 2, "mid": 1, None: 1}, block=10, period=100).collect()
    assert len(got) == 4000 and len({(r.slot, r.place) for r in got}) == 4000
    first = Counter(r.source for r in got if r.slot < 120)
    assert all(abs(first[s] - 1200 * w) <= 10 for s, w in (("big", .5), ("mid", .25), (None, .25)))


def test_mix_rows_keeps_columns_and_rows(spark, messy):
    got = mix_rows(spark, messy)
    assert got.columns == messy.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, messy.collect()))


def test_weights_of_many_sources_keep_the_target():
    """A target of a half beside 5,000 sources, and one below a unit."""
    weights = {"half": 5_000.0, **{f"s{i}": 1.0 for i in range(5_000)}}
    whole = integer_weights(weights, PERIOD)
    assert sum(whole.values()) == PERIOD and abs(whole["half"] / PERIOD - 0.5) <= 1 / PERIOD
    tiny = integer_weights({"a": 1e-9, "b": 0.5, "c": 0.5}, 1_000)
    assert tiny["a"] == 1 and sorted(tiny.values()) == [1, 499, 500]
    assert integer_weights({"a": 1e-12, "b": 1.0}, 4) == {"a": 1, "b": 3}


def test_schedule_of_many_sources_stays_within_one_block():
    """Every block runs inside its window, so no source is ever a block off."""
    weights = integer_weights({"half": 5_000.0, **{f"s{i}": 1.0 + i % 3 for i in range(5_000)}}, 20_000)
    done = Counter()
    for s, j, slot in schedule(weights):
        assert done[s] == j
        assert j * 20_000 // weights[s] <= slot < -(-(j + 1) * 20_000 // weights[s])
        done[s] += 1
    assert done == weights


def test_mix_equals_a_brute_force_schedule(spark):
    """Slots of every block against an earliest-deadline-first run in fractions."""
    from fractions import Fraction
    sizes = {"a": 90, "b": 40, "c": 10, None: 25}
    rows = [(i, s, i % 7) for s, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, n_chars long")
    targets, block, period = {"a": 8, "b": 5, "c": 2, None: 1}, 5, 16
    got = {}
    for r in mix_positions(spark, docs, targets, block=block, period=period).collect():
        got.setdefault((r.source, r.block), set()).add(r.slot)
    done, want = Counter(), {}
    for slot in range(200):
        released = [s for s, w in targets.items() if done[s] / Fraction(w, 16) < slot + 1]
        due = min(released, key=lambda s: ((done[s] + 1) / Fraction(targets[s], 16), s or ""))
        want[due, done[due]] = slot
        done[due] += 1
    for (s, j), slots in got.items():
        w = targets[s]
        assert len(slots) == 1  # a block has one slot
        slot = slots.pop()
        assert j * 16 // w <= slot < -(-(j + 1) * 16 // w)
        assert abs(slot - want[(s, j)]) < 16 / w  # ties may fall otherwise inside the window


def test_targets_need_rows_and_sense(spark):
    docs = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], "doc_id long, source string, n_chars long")
    for bad in ({"zz": 1}, {"a": 0}, {"a": -1}, {"a": float("nan")}):
        with pytest.raises(ValueError):
            mix_positions(spark, docs, bad)
    assert mix_positions(spark, docs.limit(0), {"zz": 1}).count() == 0


def test_a_target_is_never_pooled(spark):
    docs = spark.range(0, 620).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 600, F.concat(F.lit("s"), (F.col("id") % 60).cast("string")))
        .otherwise("rare").alias("source"), F.lit(1).cast("long").alias("n_chars"))
    got = mix_positions(spark, docs, {"rare": 1000.0}, max_sources=10, block=2, period=200).collect()
    assert len({(r.slot, r.place) for r in got}) == 620
    assert sorted(r.slot for r in got if r.source == "rare")[-1] < 40


def test_mix_rows_keeps_extra_columns_of_any_name(spark):
    names = ["__slot", "__h", "__source", "__rank", "__slice", "row", "name", "slot", "h", "a", "rank", "block", "ws"]
    docs = spark.range(0, 100).select(
        F.col("id").alias("doc_id"), (F.col("id") % 3).cast("string").alias("source"),
        F.lit(1).cast("long").alias("n_chars"), *[(F.col("id") * 10 + i).alias(c) for i, c in enumerate(names)])
    got = mix_rows(spark, docs, max_sources=2)
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, docs.collect()))


def test_many_sources_share_an_entry(spark):
    docs = spark.range(0, 300).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), (F.col("id") % 60).cast("string")).alias("source"),
        F.lit(1).cast("long").alias("n_chars"))
    got = mix_positions(spark, docs, max_sources=10, block=2, period=50).collect()
    assert len({(r.slot, r.place) for r in got}) == 300


def test_empty(spark, empty):
    assert pack(spark, empty).count() == 0 and mix_positions(spark, empty).count() == 0
