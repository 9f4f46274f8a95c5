import hashlib
from collections import defaultdict

from aerocorr.config import work_dir
from aerocorr.llm.exact import DigestIndex, digested, drop_copies, exact_dedup


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_against_brute_force(spark, messy):
    groups = defaultdict(list)
    for r in messy.collect():
        groups[sha(r.text)].append(r.doc_id)
    got = exact_dedup(spark, messy).collect()
    assert len(got) == messy.count()
    for r in got:
        ids = groups[r.text_sha256]
        known = [i for i in ids if i is not None]
        assert r.keep_id == (max(known) if known else None) and r.group_size == len(ids)
        assert r.kept == (r.doc_id == r.keep_id)


def test_drop_copies_keeps_one_row_of_each_text(spark, messy):
    got = drop_copies(spark, messy)
    assert got.columns == messy.columns
    assert sorted(sha(r.text) for r in got.collect()) == sorted({sha(r.text) for r in messy.collect()})


def test_index_grows_by_new_texts_only(spark):
    index = DigestIndex(spark, "digest_index_test", work_dir(spark, "index"), buckets=4)
    first = spark.createDataFrame([(1, "a"), (2, "b"), (3, "a")], "doc_id long, text string")
    more = spark.createDataFrame([(9, "a"), (4, "c"), (5, "c"), (6, None)], "doc_id long, text string")
    index.add(digested(first))
    plan = index.new_groups(digested(more))._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    index.add(digested(more))
    assert sorted((r.keep_id, r.n) for r in index.table().collect()) == [(2, 1), (3, 2), (5, 2), (6, 1)]
    detail = {r.col_name: r.data_type for r in spark.sql("DESCRIBE EXTENDED digest_index_test").collect()}
    assert detail["Num Buckets"] == "4" and "digest" in detail["Sort Columns"]
    index.drop()


def test_empty(spark, empty):
    assert exact_dedup(spark, empty).count() == 0 and drop_copies(spark, empty).count() == 0
