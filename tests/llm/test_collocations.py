"""Collocations against plain counting in Python."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from aerocorr.llm import collocations as C

LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows, least=10, length=3, top=2000, percent=50):
    f, n = Counter(), Counter()
    for _, lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, length + 1):
                f.update((lang, *w[i:i + k]) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    most = defaultdict(int)
    for (lang, *w), a in cand.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                most[(lang, *w[i:i + k])] = max(most[(lang, *w[i:i + k])], a)
    out = defaultdict(list)
    for (lang, *w), a in cand.items():
        if 100 * most[(lang, *w)] >= percent * a:
            continue
        s, k = min((10**6 * a * a // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        out[lang].append((-s, -a, " ".join(w).encode(), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    return sorted((lang, i, p.decode(), -a, l, r, n[lang], -s)
                  for lang, xs in out.items() for i, (s, a, p, l, r) in enumerate(sorted(xs)[:top], 1))


def got(df):
    return sorted(tuple(r) for r in df.collect())


def some(n, seed):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["É", "ç", "Big", "BIG", "x|y"]
    weight = [1 / (i + 1) for i in range(len(vocab))]
    out = []
    for i in range(n):
        w, size = [], rng.randrange(150)
        while len(w) < size:
            w += ["New", "York", "City"] if rng.random() < .05 else ["strong", "tea"] if rng.random() < .05 else \
                rng.choices(vocab, weight)
        text = "".join(x + rng.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", "!\r\n"]) for x in w)
        out.append((None if i % 50 == 49 else i, rng.choice(["en", "en", "de", None, "und"]), text))
    return out


def test_equals_brute_force(spark):
    rows = some(300, 3)
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(5)
    want = brute(rows)
    assert len(want) > 100 and got(C.collocations(spark, df)) == want
    assert got(C.collocations(spark, df, top=7, shards=2)) == brute(rows, top=7)


def test_longer_phrases_more_shards(spark):
    rows = some(150, 4) + [(1000 + i, "en", "one two three four five six") for i in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    assert got(C.collocations(spark, df, length=4, least=5, shards=4)) == brute(rows, 5, 4)


def test_shared_slots_change_no_count(spark, monkeypatch):
    """A table in which nearly every slot is set: phrases start too soon, counts stay whole."""
    monkeypatch.setattr(C, "LEAST_SLOTS", 8)
    monkeypatch.setattr(C, "SLOTS", 8)
    rows = some(120, 5)
    assert got(C.collocations(spark, spark.createDataFrame(rows, "doc_id long, lang string, text string"))) == brute(rows)


def test_messy_and_empty(spark, messy, empty):
    rows = [tuple(r) for r in messy.select("doc_id", "lang", "text").collect()]
    assert got(C.collocations(spark, messy, least=2)) == brute(rows, 2)
    assert got(C.collocations(spark, empty)) == []


def test_long_text_is_cut_at_separators():
    text = ("some words here, and more of them; " * 500).encode()
    column = C.pa.array([text.decode(), "", None, "a b"])
    runs = list(C._pieces(column, 1000))
    assert max(len(d) for _, d, _ in runs) <= 1000
    assert b"".join(d.tobytes() for _, d, _ in runs) == text + b"a b"
    assert all(d.tobytes()[-1:] in b",;" or i >= len(runs) - 2 for i, (_, d, _) in enumerate(runs))
    one = list(C._pieces(C.pa.array(["x" * 5000 + ". y"]), 1000))
    assert [len(d) for _, d, _ in one] == [5001, 2]


def test_every_key_is_named_once_whatever_the_round(spark):
    """Phrases of all documents and phrases of one document alike, found in any of the rounds."""
    rows = [(i, "en", "of the " * (1 + i % 3) + f"only{i} here{i}") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(4)
    done = C.counted(spark, df, 1, 2, 2)
    keys = done[0]
    for more in done[1:]:
        keys = keys.unionByName(more)
    names = [r.phrase for r in C.named(spark, df, keys.where("several").select("key"), 2).collect()]
    want = {" ".join(w[i:i + 2]) for _, _, t in rows for w in [t.split()] for i in range(len(w) - 1)}
    assert len(names) == len(set(names)) and set(names) == want


def test_marks_hold_every_key(spark):
    keys = np.array([0, 1, -1, 2**63 - 1, -2**63, 12345678901234567], dtype=np.int64)
    marks = C.marked(spark.createDataFrame([(int(k),) for k in keys], "key long"), 1 << 16)
    assert C._marked(keys.view(np.uint64), marks).all() and (marks > 0).sum() <= 2 * len(keys)


@pytest.mark.parametrize("odd", [0, 5, 10**6, None])
def test_leading_keeps_the_top(spark, odd):
    rng = random.Random(1)
    rows = [("en", rng.randrange(10**6) if odd is None or i % 9 == 0 else odd, rng.randrange(10, 500), i) for i in range(3000)]
    rows += [("de", 5, 10, i) for i in range(3)]
    df = spark.createDataFrame(rows, "lang string, score long, a long, i int").selectExpr(
        "lang", "a", "i", "named_struct('score', cast(score as decimal(38,0))) as w")
    kept = {(r.lang, r.i) for r in C.leading(df, 400).collect()}
    en = sorted(((-s, -a), i) for x, s, a, i in rows if x == "en")
    last = en[399][0]
    assert {("en", i) for x, i in en if x <= last} <= kept and {("de", i) for i in range(3)} <= kept
    assert len(kept) < 1000
