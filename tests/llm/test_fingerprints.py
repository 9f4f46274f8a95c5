import hashlib
import random
import re
from collections import Counter

from aerocorr.llm.fingerprints import fingerprints

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def jaccard(a, b):
    a, b = Counter(WORD.findall(a)), Counter(WORD.findall(b))
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def edited(text, after):
    half = len(text) // 2
    return text[:len(text) - half] + after[:half]


def test_edits_follow_descending_doc_id(spark, messy):
    rows = sorted(((r.doc_id, r.text or "") for r in messy.where("doc_id is not null and doc_id <> 10").collect()),
                  reverse=True)
    got = {r.doc_id: r for r in fingerprints(spark, messy.where("doc_id is not null and doc_id <> 10")).collect()}
    for k, (i, text) in enumerate(rows):
        want = edited(text, rows[(k + 1) % len(rows)][1])
        assert got[i].n_chars == len(text)
        assert got[i].edited_sha256 == hashlib.sha256(want.encode()).hexdigest()
    assert got[1].fingerprint == got[2].fingerprint != got[3].fingerprint
    assert got[2].near_next == 1.0  # the next is 1, a copy
    assert set(got[4].fingerprint) == {"0"} and got[4].fingerprint == got[6].fingerprint
    assert got[7].near_next == 0.0  # the next text has no words
    assert got[6].near_next == 1.0 and got[5].near_edited == 1.0


def test_null_ids_and_repeats_are_rows_of_their_own(spark, messy):
    got = fingerprints(spark, messy).collect()
    assert sorted((r.doc_id or 0) for r in got) == sorted((r.doc_id or 0) for r in messy.collect())
    assert len({r.fingerprint for r in got if r.doc_id == 10}) == 1


def test_likeness_estimates_generalised_jaccard(spark):
    rng = random.Random(3)
    docs = [(i, " ".join(f"w{int(rng.expovariate(0.08))}" for _ in range(rng.randrange(30, 300))))
            for i in range(120)]
    got = {r.doc_id: r for r in fingerprints(
        spark, spark.createDataFrame(docs, "doc_id long, text string"), samples=64).collect()}
    errors, edits = [], []
    for i, text in docs:
        after = docs[i - 1][1]
        errors.append(got[i].near_next - jaccard(text, after))
        edits.append(got[i].near_edited - jaccard(text, edited(text, after)))
    for e in (errors, edits):  # the mean of 120 estimates with a deviation of at most 1/16
        assert abs(sum(e) / len(e)) < 0.03 and max(map(abs, e)) < 0.32


def test_one_row_and_empty(spark, empty):
    one = fingerprints(spark, spark.createDataFrame([(5, "a b c d")], "doc_id long, text string")).collect()
    assert one[0].near_next == 1.0
    assert fingerprints(spark, empty).count() == 0
