import random
import re

import pytest

import aerocorr.llm.jaccard as J
from aerocorr.llm.common import connected_components

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def brute(pairs):
    """{(doc_id, text): (size, component)} by all pairs."""
    sets = [(i, shingles(t)) for i, t in pairs]
    comp = list(range(len(sets)))

    def find(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for a in range(len(sets)):
        for b in range(a):
            i = len(sets[a][1] & sets[b][1])
            if i and 100 * i >= 80 * len(sets[a][1] | sets[b][1]):
                comp[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(sets):
        r = find(k)
        low[r] = i if low.get(r) is None else min(low[r], i if i is not None else low[r])
    return [(i, len(s), low[find(k)]) for k, (i, s) in enumerate(sets)]


def order(rows):
    return sorted(rows, key=repr)


def check(spark, pairs):
    docs = spark.createDataFrame(pairs, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in J.near_groups(spark, docs).collect()]
    assert order(got) == order(brute(pairs))


def test_messy_rows(spark, messy):
    got = [(r.doc_id, r.n_shingles, r.component_id) for r in J.near_groups(spark, messy).collect()]
    assert order(got) == order(brute([(r.doc_id, r.text) for r in messy.collect()]))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_edits_at_the_threshold(spark, seed):
    """Groups of copies edited by 0-12 % of their words, with a passage that
    many share: similarities lie around the threshold."""
    rng = random.Random(seed)
    shared = " ".join(f"s{i}" for i in range(30))
    pairs = []
    for g in range(12):
        words = [f"g{g}v{rng.randrange(60)}" for _ in range(rng.choice([6, 40, 90]))]
        for _ in range(rng.choice([1, 5, 14])):
            w = [x if rng.random() > 0.03 * rng.randrange(3) else f"e{rng.random()}" for x in words]
            if rng.random() < 0.2:
                w = w[: len(w) - rng.randrange(5)]
            text = " ".join(w)
            pairs.append((rng.randrange(10**6), text + " " + shared if g % 3 == 0 else text))
    check(spark, list({i: (i, t) for i, t in pairs}.values()))


def test_frequent_shingles_are_known_everywhere(spark):
    """Shingles in most documents come last in the order, and no link is lost."""
    shared = " ".join(f"s{i}" for i in range(60))
    pairs = [(i, shared + " " + " ".join(f"d{i}x{j}" for j in range(i % 14))) for i in range(60)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string").coalesce(1)
    _, hot, _ = J.profiles(spark, docs, 5, 0.01)
    assert len(hot) >= 50
    check(spark, pairs)


def test_candidates_stay_few_in_a_group_of_near_copies(spark, monkeypatch):
    """Near copies of one text meet over few rows, not over all pairs."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    pairs = [(i, " ".join(x if rng.random() > 0.01 * (i % 4) else f"e{rng.random()}" for x in base))
             for i in range(200)]
    seen = []
    plain = J.candidate_pairs
    monkeypatch.setattr(J, "candidate_pairs", lambda e: seen.append(plain(e).count()) or plain(e))
    check(spark, pairs)
    assert seen[0] < 200 * 199 / 2 * 0.1


def test_first_of_each_keeps_columns(spark, messy):
    got = J.first_of_each(spark, messy)
    assert got.columns == messy.columns
    ids = [r.doc_id for r in got.collect()]
    assert 1 in ids and not {2, 3, 8} & set(ids) and {4, 5, 6, 7, 9} <= set(ids)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    got = {r.node: r.comp for r in connected_components(spark, edges).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_empty(spark, empty):
    assert J.near_groups(spark, empty).count() == 0 and J.first_of_each(spark, empty).count() == 0


def test_rows_that_repeat_an_id_with_other_texts(spark):
    """A class is not its smallest doc_id: an unrelated text under a used id
    stays alone, and of near texts under one id one stays."""
    words = [f"w{i}" for i in range(60)]
    near = lambda i: " ".join(words[:i] + ["other"] + words[i + 1:])
    rows = [(1, " ".join(words)), (5, near(30)), (5, " ".join(f"u{i}" for i in range(50))), (7, near(1)),
            (9, " ".join(f"v{i}" for i in range(50))), (11, " ".join(f"x{i}" for i in range(60))),
            (11, " ".join(f"x{i}" for i in range(59))), (None, " ".join(f"z{i}" for i in range(20))),
            (None, " ".join(f"z{i}" for i in range(20)))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in J.near_groups(spark, df).collect())
    assert got == [(0, 16, 0), (0, 16, 0), (1, 56, 1), (5, 46, 5), (5, 56, 1), (7, 56, 1), (9, 46, 9),
                   (11, 55, 11), (11, 56, 11)]
    stay = sorted((r.doc_id or 0, r.text.split()[0]) for r in J.first_of_each(spark, df).collect())
    assert stay == [(0, "z0"), (0, "z0"), (1, "w0"), (5, "u0"), (9, "v0"), (11, "x0")]


def test_parts_follow_the_number_of_shingles(spark, monkeypatch):
    words = [f"w{i}" for i in range(400)]
    rows = [(i, " ".join(words[:i] + ["o"] + words[i + 1:])) for i in range(30)] + [(99, " ".join(words[::2]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = sorted(tuple(r) for r in J.near_groups(spark, df).collect())
    sizes = []
    deal = J._deal
    monkeypatch.setattr(J, "PART", 500)
    monkeypatch.setattr(J, "_deal", lambda k, parts, hot: (sizes.append(parts), deal(k, parts, hot))[1])
    assert sorted(tuple(r) for r in J.near_groups(spark, df).collect()) == whole
    assert sizes[0] >= 24 and {r[2] for r in whole} == {0, 99}
