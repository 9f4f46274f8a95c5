"""Line dedup against a plain count in Python, and the index across sessions."""

import random

from pyspark.sql import functions as F

from aerocorr.config import work_dir
from aerocorr.llm.line_runs import BLANK, LOWER, LineRuns, dedup_lines


def brute(rows, chars=20, least=3):
    keys = [[x.strip(BLANK).translate(LOWER) for x in (t or "").split("\n")] for _, t in rows]
    docs = {}
    for (i, _), ks in zip(rows, keys):
        for k in {k for k in ks if len(k) >= chars}:
            docs.setdefault(k, []).append(-2**63 if i is None else i)
    out = []
    for (i, t), ks in zip(rows, keys):
        me = -2**63 if i is None else i
        lines = (t or "").split("\n")
        stay = [x for x, k in zip(lines, ks) if len(docs.get(k, ())) < least or max(docs[k]) == me]
        out.append((i, "\n".join(stay), len(lines), len(lines) - len(stay)))
    return sorted(out, key=str)


def got(df):
    return sorted(map(tuple, df.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=str)


def some(n, seed):
    rng = random.Random(seed)
    stock = [f"A stock line of number {i:04d} é" for i in range(40)] + ["short", "", "   ", "x" * 19, "x" * 20]
    out = []
    for i in range(n):
        lines = [rng.choice(["", " ", "\t"]) + (x.upper() if rng.random() < .2 else x) + rng.choice(["", "\r", " \x0b"])
                 for x in rng.choices(stock, k=rng.randrange(6))]
        out.append((None if i % 41 == 40 else i // 2 if i % 29 == 0 else i, "\n".join(lines)))
    return out


def test_equals_brute_force(spark):
    rows = some(400, 1) + [(7, None), (8, ""), (9, "\n\n"), (10, "a hot line of more than twenty")] + [
        (1000 + i, "a hot line of more than twenty\nown line of this text " + str(i)) for i in range(200)]
    assert got(dedup_lines(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(5))) == brute(rows)


def test_messy_and_empty(spark, messy, empty):
    rows = [tuple(r) for r in messy.select("doc_id", "text").collect()]
    assert got(dedup_lines(spark, messy)) == brute(rows)
    assert got(dedup_lines(spark, empty)) == []


def test_all_null_ids_and_long_text(spark):
    rows = [(None, "one line that all of them hold\nb")] * 4 + [(None, "\n".join(f"line number {i % 7000} of a long text" for i in range(30_000)))]
    assert got(dedup_lines(spark, spark.createDataFrame(rows, "doc_id long, text string"))) == brute(rows)


def batch(spark, lines):
    return spark.createDataFrame(lines, "h1 long, h2 long, docs long, keep long")


def test_runs_compact_and_settled_keys_stay_out(spark):
    index = LineRuns(spark, work_dir(spark, "runs"), fan=2, buckets=3)
    index.add(batch(spark, [(1, 1, 5, 90), (2, 2, 1, 95)]))
    assert index.fresh(batch(spark, [(1, 1, 9, 80), (2, 2, 1, 70), (1, 1, 1, 91)])).count() == 2
    for i in range(3):
        index.add(batch(spark, [(1, 1, 2, 50 - i), (2, 2, 1, 40 - i), (3 + i, 0, 1, None)]))
    assert sorted(r["level"] for r in index.runs()) == [2]
    assert {tuple(r) for r in index.merged().collect()} == {
        (1, 1, 5, 90), (2, 2, 4, 95), (3, 0, 1, None), (4, 0, 1, None), (5, 0, 1, None)}
    plan = index.fresh(batch(spark, [(1, 1, 1, 1)]))._jdf.queryExecution().executedPlan().toString()
    assert "SelectedBucketsCount: 3 out of 3" in plan


def test_index_goes_on_in_a_session_without_its_tables(spark):
    folder = work_dir(spark, "runs")
    docs = spark.createDataFrame([(i, "a line that comes in two calls") for i in (1, 9)], "doc_id long, text string")
    before = len(spark.catalog.listTables())
    first = LineRuns(spark, folder, buckets=3)
    assert got(dedup_lines(spark, docs, first)) == [(1, "a line that comes in two calls", 1, 0),
                                                    (9, "a line that comes in two calls", 1, 0)]
    assert len(spark.catalog.listTables()) == before
    later = LineRuns(spark, folder, buckets=7)
    assert later.state["buckets"] == 3
    more = spark.createDataFrame([(5, "A line that comes in two calls ")], "doc_id long, text string")
    assert got(dedup_lines(spark, more, later)) == [(5, "", 1, 1)]
