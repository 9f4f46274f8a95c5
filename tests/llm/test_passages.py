import random
import re

import numpy as np
import pyarrow as pa
import pytest

from aerocorr.llm.passages import (
    GAP, K, LEAST, SIMILAR, _runs, align, chain, equal_words, repeated_passages, shared_seeds, similar_segments)

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def text(rng, n):
    return [f"v{rng.randrange(10**6)}" for _ in range(n)]


def plain_chain(pos, ref):
    """Best chain score by comparing all pairs."""
    order = sorted(range(len(pos)), key=lambda i: (pos[i], ref[i]))
    score = {}
    for i in order:
        score[i] = max([K] + [K + score[j] - GAP * (pos[i] - pos[j] + ref[i] - ref[j])
                              for j in score if pos[j] < pos[i] and ref[j] < ref[i]])
    return max(score.values())


@pytest.mark.parametrize("seed", range(5))
def test_chain_finds_the_best_score(seed):
    rng = np.random.default_rng(seed)
    pos, ref = rng.integers(0, 120, 60), rng.integers(0, 120, 60)
    best = 0
    for path in chain(pos, ref):
        assert all(pos[a] < pos[b] and ref[a] < ref[b] for a, b in zip(path, path[1:]))
        best = max(best, K * len(path) - GAP * (pos[path[-1]] - pos[path[0]] + ref[path[-1]] - ref[path[0]]))
    assert best == pytest.approx(plain_chain(pos.tolist(), ref.tolist()))


def test_equal_words_is_a_common_subsequence():
    a, b = np.array([1, 2, 3, 4, 5]), np.array([1, 3, 9, 4, 5, 5])
    assert equal_words(a, b) == 4 and equal_words(a, a) == 5 and equal_words(a, b[:0]) == 0


def test_align_extends_to_both_sides():
    a, b = np.arange(100), np.concatenate([[900, 901], np.arange(100)])
    assert align(a, b, np.array([30, 50]), np.array([32, 52])) == (0, 100, 2, 102, 100)


def test_planted_passages(spark):
    """Exact and edited passages in otherwise different texts are found with
    their places; texts without a common passage stay out."""
    rng = random.Random(1)
    shared, other = text(rng, 60), text(rng, 90)
    fuzzy = [w if i % 23 else "changed" for i, w in enumerate(other)]
    docs = {1: text(rng, 200) + shared + text(rng, 100), 2: shared + text(rng, 90), 3: text(rng, 300),
            4: text(rng, 40) + other, 5: text(rng, 10) + fuzzy + text(rng, 500), 6: text(rng, 70) + shared,
            7: shared[:40] + text(rng, 60), 8: text(rng, 30)}
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    got = {(r.doc_id, r.ref_id): r for r in repeated_passages(spark, df).collect()}
    assert set(got) == {(2, 1), (6, 1), (5, 4)}
    assert (got[2, 1].start_word, got[2, 1].end_word, got[2, 1].ref_start) == (0, 60, 200)
    assert (got[6, 1].start_word, got[6, 1].end_word) == (70, 130)
    found = got[5, 4]
    assert 10 <= found.start_word <= 20 and 90 <= found.end_word <= 100 and found.similarity >= 0.9


@pytest.mark.parametrize("size, gap", [(200, 150), (200, 110), (100, 60), (60, 40)])
def test_passages_of_one_pair_are_cut(spark, size, gap):
    """Two exact passages with different text between them are both found,
    however far their chain reaches."""
    rng = random.Random(size + gap)
    one, two = text(rng, size), text(rng, size)
    docs = [(i, " ".join(text(rng, 30) + one + text(rng, gap) + two + text(rng, 30))) for i in (1, 2)]
    got = repeated_passages(spark, spark.createDataFrame(docs, "doc_id long, text string")).collect()
    spans = sorted((r.start_word, r.end_word, r.ref_start, r.ref_end) for r in got)
    second = 30 + size + gap
    assert spans == [(30, 30 + size) * 2, (second, second + size) * 2] and {r.similarity for r in got} == {1.0}


def test_segments_against_brute_force():
    """The longest similar segment is found, and every run of LEAST equal words
    lies in a segment."""
    rng = np.random.default_rng(3)
    for _ in range(30):
        equal = np.repeat(rng.random(40) < 0.6, rng.integers(1, 70, 40))
        x = np.flatnonzero(equal)
        got = similar_segments(x, x + 5)
        longest = max((x[j] - x[i] + 1 for i in range(len(x)) for j in range(i, len(x))
                       if j - i + 1 >= SIMILAR * (x[j] - x[i] + 1)), default=0)
        assert max((x[j] - x[i] + 1 for i, j in got), default=0) == (longest if longest >= LEAST else 0)
        covered = {w for i, j in got for w in range(x[i], x[j] + 1)}
        for run in np.split(x, np.flatnonzero(np.diff(x) > 1) + 1):
            assert len(run) < LEAST or covered.issuperset(run.tolist())


def spans_of(spark, docs):
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    return {(r.doc_id, r.ref_id, r.start_word, r.end_word, r.ref_start) for r in repeated_passages(spark, df).collect()}


def test_earlier_holders_of_parts_hide_nothing(spark):
    """Two documents share a passage whose halves (or all its sentences) stand
    in earlier ones that do not hold the whole."""
    rng = random.Random(5)
    for size, cut in ((60, 30), (120, 40), (200, 25)):
        whole = text(rng, size)
        docs = {i: text(rng, 40) + whole[a:a + cut] + text(rng, 40) for i, a in enumerate(range(0, size, cut), 1)}
        docs |= {50: text(rng, 20) + whole + text(rng, 30), 51: text(rng, 70) + whole, 52: whole + text(rng, 10)}
        got = spans_of(spark, docs)
        assert {(51, 50, 70, 70 + size, 20), (52, 50, 0, size, 20)} <= got, (size, cut)
        assert all(d > 50 for d, *_ in got)


def test_an_edited_first_holder_hides_no_equal_copies(spark):
    rng = random.Random(6)
    whole = text(rng, 60)
    edited = [w if i % 4 != 3 or 20 < i < 40 else "changed" for i, w in enumerate(whole)]
    got = spans_of(spark, {1: edited, 2: text(rng, 30) + whole, 3: whole + text(rng, 30)})
    assert (3, 2, 0, 60, 30) in got


def test_every_place_of_a_passage(spark):
    """A passage twice in one document, and one whose first sentences stand
    alone earlier in the document that holds it."""
    rng = random.Random(7)
    whole = text(rng, 60)
    got = spans_of(spark, {1: whole + text(rng, 50), 2: whole + text(rng, 300) + whole})
    assert got == {(2, 1, 0, 60, 0), (2, 1, 360, 420, 0)}
    got = spans_of(spark, {1: whole[:30] + text(rng, 200) + whole + text(rng, 200) + whole[30:], 2: whole})
    assert (2, 1, 0, 60, 230) in got
    got = spans_of(spark, {1: text(rng, 20) + ["so"] * 90, 2: ["so"] * 90 + text(rng, 20)})
    assert any(e - s >= 80 for _, _, s, e, _ in got)


def runs_of(doc, places):
    """(run, doc_id, pos, end, open) of the places (pos, seed, open), all matched with word 0 of document 1."""
    at = [[{"pos": p, "seed": s, "ref_id": 1, "ref_pos": 0, "open": o} for p, s, o in places]]
    batch = pa.RecordBatch.from_arrays([pa.array([doc]), pa.array(at, pa.list_(pa.struct(
        [("pos", pa.int32()), ("seed", pa.int64()), ("ref_id", pa.int64()), ("ref_pos", pa.int32()),
         ("open", pa.bool_())])))], ["doc_id", "at"])
    return [tuple(r.values()) for b in _runs([batch]) for r in b.to_pylist()]


def test_covered_runs_of_one_repeated_seed_count_once():
    """Two words repeated give a seed every second word: its covered runs are
    told by the first of each length, whatever the stretch's length; the open
    ones and those that leave the stretch are all there."""
    tail = [(600 + 9 * i, 20 + i, False) for i in range(4)]
    got = runs_of(5, [(2 * i, 8, False) for i in range(300)] + tail)
    assert len(got) < 400 and min(p for _, _, p, _, _ in got) == 0
    assert {e for *_, e, _ in got} >= {p for p, _, _ in tail}
    inside = [r for r in got if r[3] < 600]
    assert len({r[0] for r in inside}) == len(inside) == 21 and {r[2] for r in inside} == {0}
    # one open place: every run that holds it stays, with the key that the first run of its length has
    some = runs_of(6, [(2 * i, 8, i == 150) for i in range(300)])
    opens = [r for r in some if r[4]]
    assert {(p, e) for _, _, p, e, _ in opens} == {
        (2 * a, 2 * b) for a in range(300) for b in range(a + 1, min(a + 22, 300)) if a <= 150 <= b}
    assert {r[0] for r in opens} == {r[0] for r in inside}


def test_seeds_are_dealt_once(spark, monkeypatch):
    """First places and their join read one exchange of the seeds."""
    from aerocorr.llm import passages
    plans = []
    monkeypatch.setattr(passages, "written", lambda s, df, name: plans.append(df) or df)
    rng = random.Random(8)
    whole = text(rng, 60)
    docs = [(i, " ".join(text(rng, 30) + whole)) for i in range(4)]
    df = shared_seeds(spark, spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.ref_id for r in df.collect()} == {0}
    plan = plans[0]._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "ReusedExchange" in plan


def test_messy_rows(spark, messy):
    got = {(r.doc_id, r.ref_id) for r in repeated_passages(spark, messy).collect()}
    assert got == {(2, 1), (3, 1), (12, 11)}


def test_empty(spark, empty):
    assert repeated_passages(spark, empty).count() == 0
