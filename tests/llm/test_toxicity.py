import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aerocorr.llm.toxicity import FEATURES, HELD_OUT, clean_rows, fit, fold, judge, scores, text_features, train


def corpus(n=1200):
    rng = random.Random(7)
    vocabulary = [f"{rng.choice('bcdfgl')}{rng.choice('aeiou')}{rng.randrange(10**5)}" for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(20, 200))]
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["vilefoo", "nasty", "zorg" + rng.choice("abcdef")]))
        docs.append((i, " ".join(words)))
        if rng.random() < 0.6:
            labels.append((i, 1, int(toxic)))
    return docs, labels


@pytest.fixture(scope="module")
def data(spark):
    docs, labels = corpus()
    return (spark.createDataFrame(docs, "doc_id long, text string"),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), dict(docs))


def held(i):
    return zlib.crc32(str(i).encode()) % 4 == HELD_OUT


def test_held_out_accuracy(spark, data):
    docs, labels, _ = data
    got = {r.doc_id: r for r in judge(spark, docs, labels).collect()}
    assert len(got) == 1200 and all(r.held_out == held(i) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    test = [(got[r.doc_id].predicted, r.toxic) for r in labels.collect() if held(r.doc_id)]
    hit = sum(p and y for p, y in test)
    assert hit >= 0.9 * sum(y for _, y in test) and hit >= 0.9 * sum(p for p, _ in test)


def test_held_out_labels_are_never_read(spark, data):
    docs, labels, _ = data
    flipped = labels.withColumn("toxic", F.when(fold() == HELD_OUT, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert np.array_equal(fit(spark, docs, labels).weights, fit(spark, docs, flipped).weights)


def test_features_cover_the_whole_text():
    long = " ".join(f"w{i}" for i in range(300_000)) + " tail"
    texts = pa.array([long, None, "", "tail", "TAIL"])
    rows = [None] * 5
    for row, f, bounds in text_features(texts):
        for i in range(len(bounds) - 1):
            rows[row + i] = set(f[bounds[i]:bounds[i + 1]].tolist())
    assert rows[3] and rows[3] <= rows[0] and rows[3] == rows[4] and rows[1] == rows[2] == set()


def test_training_corrects_for_positives_among_the_unlabelled():
    """Half of the unlabelled are toxic too; plain learning would put the
    threshold's share far too low."""
    rng = np.random.default_rng(2)
    toxic = lambda: np.unique(np.append(rng.integers(100, 400, 30), rng.integers(0, 5, 2))).astype(np.int32)
    clean = lambda: np.unique(rng.integers(100, 400, 30)).astype(np.int32)
    model = train([toxic() for _ in range(400)], [toxic() for _ in range(500)] + [clean() for _ in range(500)], 0.5)
    z = lambda f: model.weights[f].sum() + model.bias
    assert np.mean([z(toxic()) > 0 for _ in range(200)]) > 0.95 and np.mean([z(clean()) > 0 for _ in range(200)]) < 0.05


def test_messy_rows(spark, messy, labels, empty):
    got = judge(spark, messy, labels)
    assert got.count() == messy.count()
    assert len({round(r.score, 12) for r in got.where("doc_id in (4, 5, 6)").collect()}) == 1
    assert clean_rows(spark, messy, labels.limit(0)).count() == messy.count()
    assert clean_rows(spark, messy, labels).columns == messy.columns
    assert judge(spark, empty, labels).count() == 0
    none = judge(spark, messy, labels.limit(0)).collect()
    assert max(r.score for r in none) < 1e-6
    assert scores(np.zeros(FEATURES, np.float32), 0.0, pa.array([None, "a"], pa.string())).tolist() == [0.5, 0.5]
