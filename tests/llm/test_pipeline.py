import os
import random
import re

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from aerocorr.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def write(spark, path, docs, labels):
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    rng = random.Random(11)
    new = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    docs, labels, toxic = [], [], set()
    for i in range(400):
        words = new(60)
        if i % 7 == 0:
            toxic.add(i)
            for _ in range(5):
                words.insert(rng.randrange(50), rng.choice(["vilefoo", "nastybar", "zorgbaz"]))
        docs.append([i, words])
        if i % 2 or i % 7 == 0:
            labels.append((i, 1, int(i in toxic)))
    copies = {}
    for i in range(400, 440):  # exact copies of clean documents: the larger id stays
        docs.append([i, list(docs[i - 399][1])])
        copies[i - 399] = i
    for i in range(440, 470):  # near copies: the smaller id stays
        words = list(docs[i - 240][1])
        words[30] = "edited"
        docs.append([i, words])
    rows = [(i, " ".join(w), "en", "big" if i % 3 else None, 1) for i, w in docs] + [(500, None, None, "s", None)]
    path = str(tmp_path_factory.mktemp("corpus"))
    write(spark, path, rows, labels)
    return path, rows, toxic


def test_against_brute_force(spark, corpus):
    """Each stage's decision by hand: no toxic text, one row of equal texts,
    one of near copies, all others there and packed once."""
    path, rows, toxic = corpus
    bad = {i for i, t, *_ in rows if t and re.search("vilefoo|nastybar|zorgbaz", t)}
    left = {i: t for i, t, *_ in rows if i not in bad}
    last = {}
    for i in sorted(left):
        last[left[i]] = i
    left = {i: t for t, i in last.items()}
    shingles = {i: {tuple(w[j:j + 5]) for j in range(len(w) - 4)} for i, t in left.items()
                for w in [WORD.findall(t or "")]}
    keep = []
    for i in sorted(left):
        if not any(shingles[i] and len(shingles[i] & shingles[k]) * 100 >= 80 * len(shingles[i] | shingles[k])
                   for k in keep):
            keep.append(i)
    got = corpus_pipeline.run(spark, path).collect()
    assert sorted(r.doc_id for r in got) == sorted(keep)
    assert len({(r.bucket, r.batch_id, r.slot) for r in got}) == len(got)


def test_stages_keep_the_columns(spark, corpus):
    path, rows, _ = corpus
    docs = spark.read.parquet(f"{path}/documents.parquet").selectExpr("*", "1 AS digest", "'x' AS rank", "2 AS bucket")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "mixing", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, path).columns == docs.columns


def test_empty_documents(spark, tmp_path):
    write(spark, str(tmp_path), [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_queries_are_registered():
    names = E.queries()
    assert set(QUERIES) < set(names) and "pipeline" in names
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracles(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(repr, (tuple(r[c] for c in want.columns) for r in got.collect()))) == sorted(
        map(repr, want.fetchall()))




def test_batches_follow_the_mix(spark, tmp_path):
    """The mix decides which documents share a batch, and in which order."""
    from aerocorr.llm.common import written
    from aerocorr.llm.mixing import mix_positions
    rng = random.Random(5)
    rows = [(i, " ".join(f"w{i}" for _ in range(rng.choice([3, 9, 400]))), "en", "big" if i % 5 else "small", i % 9)
            for i in range(3000)]
    write(spark, str(tmp_path), rows, [])
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    at = {r.doc_id: (r.slot, r.place) for r in mix_positions(spark, docs).collect()}
    mix = written(spark, corpus_pipeline.mixing(spark, docs, str(tmp_path)), "mix")
    got = corpus_pipeline.packing(spark, mix, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == list(range(3000)) and len({r.bucket for r in got}) == 3
    assert max(r.batch_id for r in got) > 1
    for bucket in range(3):
        packed = sorted((r.batch_id, r.slot, at[r.doc_id]) for r in got if r.bucket == bucket)
        assert [p for *_, p in packed] == sorted(p for *_, p in packed)
