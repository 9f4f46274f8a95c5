import math
import random

import pytest
from pyspark.sql import functions as F

from aerocorr.operators import stats

NAN = float("nan")


def matrix(df, cols, **kw):
    return {(r.col_a, r.col_b): (r.r, r.n) for r in stats.correlation_matrix(df, cols, **kw).collect()}


def test_degenerate_inputs(spark):
    schema = "x double, y double"
    empty = spark.createDataFrame([], schema)
    one = spark.createDataFrame([(1.0, 2.0)], schema)
    const = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], schema)
    for df, n in ((empty, 0), (one, 1), (const, 3)):
        m = matrix(df, ["x", "y"])
        assert m[("x", "y")] == (None, n)
        assert m[("x", "x")][0] is None
    assert matrix(const, ["x", "y"])[("y", "y")] == (1.0, 3)


def test_null_and_nan_rows_skipped_and_exact_signs(spark):
    rows = [(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (None, 1.0), (NAN, 5.0), (4.0, None)]
    df = spark.createDataFrame(rows, "x double, y double")
    m = matrix(df, ["x", "y"])
    assert m[("x", "y")][1] == 3 and m[("x", "y")][0] == pytest.approx(1.0, abs=1e-12)
    neg = spark.createDataFrame([(1.0, -2.0), (2.0, -4.0), (3.0, -6.0)], "x double, y double")
    assert matrix(neg, ["x", "y"])[("y", "x")][0] == pytest.approx(-1.0, abs=1e-12)


def test_matches_ml_correlation_and_properties(spark):
    rnd = random.Random(1)
    rows = []
    for _ in range(300):
        a = rnd.gauss(20, 5)
        rows.append((a, 0.3 * a + rnd.gauss(0, 2), rnd.uniform(0, 100) if rnd.random() > 0.05 else None))
    df = spark.createDataFrame(rows, "a double, b double, c double")
    cols = ["a", "b", "c"]
    m = matrix(df, cols)
    ml = stats.correlation_matrix_ml(df, cols)
    for i, x in enumerate(cols):
        for j, y in enumerate(cols):
            assert m[(x, y)][0] == pytest.approx(ml[i, j], abs=1e-9)
            assert m[(x, y)][0] == m[(y, x)][0]
    scaled = df.selectExpr("a * 1000 - 7 AS a", "b", "c")
    assert matrix(scaled, cols)[("a", "b")][0] == pytest.approx(m[("a", "b")][0], abs=1e-9)
    assert math.isclose(m[("a", "a")][0], 1.0)


def test_pooled_equals_row_level(spark):
    rnd = random.Random(5)
    rows = []
    for g in range(40):
        d = None if g == 3 else rnd.uniform(0, 2)
        for _ in range(rnd.randrange(0, 30)):
            rows.append((g, rnd.gauss(20 + g, 4), d))
    df = spark.createDataFrame(rows, "g long, a double, d double")
    direct = matrix(df, ["a", "d"])
    groups = stats.grouped_moments(df, ["g", "d"], F.col("a"))
    pooled = {(r.col_a, r.col_b): (r.r, r.n)
              for r in stats.pooled_correlation_matrix(groups, "a", "d").collect()}
    for k, (r, n) in direct.items():
        assert pooled[k][1] == n and pooled[k][0] == pytest.approx(r, abs=1e-12)
    empty = stats.grouped_moments(df.where("false"), ["g", "d"], F.col("a"))
    out = stats.pooled_correlation_matrix(empty, "a", "d").collect()
    assert {(r.r, r.n) for r in out} == {(None, 0)}
