"""Divergence against plain sums over all kept terms in Python."""

import random
import re
from collections import Counter, defaultdict

from aerocorr.llm import divergence as D


LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(rows, least=3, top=200):
    term = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    n, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for lang, source, text in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        ts = [t.translate(LOWER) for t in term.findall(text or "")]
        n[lang, source].update(ts)
        docs[lang].update(set(ts))
    out = []
    for lang, sources in groups.items():
        kept = [t for t, d in docs[lang].items() if d >= least]

        def shares(count):
            size = sum(count[t] for t in kept) + len(kept)
            return {t: 1 + 10**9 * (count[t] + 1) // size for t in kept}
        p = {s: shares(n[lang, s]) for s in sources}
        q = shares(sum((n[lang, s] for s in sources), Counter()))
        f = lambda a, b: (a - b) ** 2 // b
        for s in sources:
            pair = [(-sum(f(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            single = [(-f(p[s][t], q[t]), t) for t in kept if n[lang, s][t] and p[s][t] > q[t]]
            for part, xs in (("pair", sorted(pair, key=lambda x: (x[0], x[1].encode()))),
                             ("term", sorted(single, key=lambda x: (x[0], x[1].encode()))[:top])):
                out += [(lang, s, part, item, -v, i) for i, (v, item) in enumerate(xs, 1)]
    return sorted(out)


def got(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def some(n, seed):
    rng = random.Random(seed)
    vocab = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(90)] + ["É", "ç漢", "BIG", "big", "\U0001f600x"]
    out = []
    for _ in range(n):
        s = rng.choice(["a", "a", "a", "b", "c", None, "", "Ü"])
        lo = {"a": 0, "b": 30, "c": 60}.get(s, 10)
        text = " ".join(rng.choice(vocab[lo:lo + 40] if rng.random() < .7 else vocab) + rng.choice(["", "1", "-x", "."])
                        for _ in range(rng.randrange(60)))
        out.append((rng.choice(["en", "en", "de", None, ""]), s, rng.choice([text] * 9 + [None])))
    return out + [("xx", "only", "no kept term here"), ("yy", "u", "t"), ("yy", "v", None), ("zz", "one", "a b a " * 5)] * 2


def frame(spark, rows):
    return spark.createDataFrame(rows, "lang string, source string, text string").repartition(4)


def test_equals_brute_force(spark):
    rows = some(300, 1)
    want = brute(rows)
    assert got(D.divergence(spark, frame(spark, rows))) == want
    assert {r[2] for r in want} == {"pair", "term"}


def test_many_small_parts_and_shuffle_join(spark, monkeypatch):
    monkeypatch.setattr(D, "MANY_GROUPS", 1)
    rows = some(200, 2)
    assert got(D.divergence(spark, frame(spark, rows), top_terms=5, part_rows=20)) == brute(rows, top=5)


def test_many_sources(spark):
    rng = random.Random(5)
    rows = [("en", f"s{i % 150}", " ".join(f"t{chr(97 + rng.randrange(26))}" for _ in range(9))) for i in range(600)]
    assert got(D.divergence(spark, frame(spark, rows), part_rows=500)) == brute(rows)


def test_messy_and_empty(spark, messy, empty):
    rows = [tuple(r) for r in messy.select("lang", "source", "text").collect()]
    assert got(D.divergence(spark, messy, least_docs=1)) == brute(rows, 1)
    assert got(D.divergence(spark, empty)) == []


def test_long_text_in_runs(monkeypatch):
    text = "aé1b CD " * 3000 + "z" * 5000
    whole = D.terms_of(text)
    monkeypatch.setattr(D, "LONG", 64)
    assert D.terms_of(text) == whole == ["aé", "b", "cd"] * 3000 + ["z" * 5000]


def test_counters_are_handed_on(monkeypatch):
    monkeypatch.setattr(D, "HELD", 3)
    batch = D.pa.RecordBatch.from_pydict({"lang": ["e"] * 9, "source": ["s"] * 9, "text": [f"a b{chr(97 + i)}" for i in range(9)]})
    rows = [r for b in D._count([batch, batch]) for r in b.to_pylist()]
    assert sum(r["n"] for r in rows if r["term"] == "a") == 18 and len([r for r in rows if r["term"] is None]) > 2
