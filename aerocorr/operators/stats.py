"""Pearson correlation matrices as one aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _complete(df: DataFrame, cols: Sequence[str]):
    conds = []
    for c in cols:
        conds.append(F.col(c).isNotNull())
        if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
            conds.append(~F.isnan(F.col(c)))
    return reduce(lambda a, b: a & b, conds)


def correlation_matrix(df: DataFrame, columns: Sequence[str], *, complete: bool = True,
                       digits: int | None = None) -> DataFrame:
    """Long-form Pearson matrix ``(col_a, col_b, r, n)`` with ``k*k`` rows.

    All moments come from one aggregation (partial per task, merged once), so
    the data is scanned once and nothing is shuffled but one buffer per task.
    ``complete=True`` uses only rows with no NULL or NaN in any of
    ``columns`` (the vector-assembler "skip" rule), so every pair uses the
    same rows.  The rule is applied inside the aggregates rather than as a
    filter: a filter would be pushed below the projection that derives the
    columns and re-evaluate expensive derivations once per reference.
    ``r`` is NULL when fewer than two rows remain or a column is constant; the
    diagonal is 1 where the column varies."""
    cols = list(columns)
    ok = _complete(df, cols) if complete else F.lit(True)

    def v(c):
        return F.when(ok, F.col(c))

    aggs = [F.count(F.when(ok, F.lit(1))).alias("_n")]
    for i, c in enumerate(cols):
        aggs += [F.var_pop(v(c)).alias(f"_v{i}"), F.stddev_pop(v(c)).alias(f"_s{i}")]
    for i in range(len(cols)):
        for j in range(i + 1, len(cols)):
            aggs.append(F.covar_pop(v(cols[i]), v(cols[j])).alias(f"_c{i}_{j}"))
    moments = df.agg(*aggs)

    def fmt(x):
        return F.round(x, digits) if digits is not None else x

    cells = []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if i == j:
                r = F.when(F.col(f"_v{i}") > 0, F.lit(1.0))
            else:
                lo, hi = min(i, j), max(i, j)
                r = F.try_divide(F.col(f"_c{lo}_{hi}"), F.col(f"_s{i}") * F.col(f"_s{j}"))
            cells.append(F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                                  fmt(r).cast("double").alias("r"), F.col("_n").alias("n")))
    return moments.select(F.inline(F.array(*cells)))


def correlation_matrix_ml(df: DataFrame, columns: Sequence[str]):
    """The same matrix through ``pyspark.ml`` (vector assembler with
    ``handleInvalid="skip"`` + ``Correlation.corr``), returned as a local
    ``DenseMatrix``; used to cross-check :func:`correlation_matrix`."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import Correlation

    vec = VectorAssembler(inputCols=list(columns), outputCol="_features",
                          handleInvalid="skip").transform(df)
    return Correlation.corr(vec, "_features").first()[0]


def grouped_moments(df: DataFrame, keys: Sequence[str], value, where=None,
                    prefix: str = "_") -> DataFrame:
    """Per group: count, mean and population variance of ``value`` over the
    rows satisfying ``where`` (other rows still create their group).  One
    hash aggregation; a hot key is combined map-side before the shuffle."""
    v = F.when(where, value) if where is not None else value
    return df.groupBy(*keys).agg(F.count(v).alias(f"{prefix}n"), F.avg(v).alias(f"{prefix}mean"),
                                 F.var_pop(v).alias(f"{prefix}var"))


def pooled_correlation_matrix(groups: DataFrame, value: str, attr: str, *, n: str = "_n",
                              mean: str = "_mean", var: str = "_var",
                              digits: int | None = None) -> DataFrame:
    """Long-form Pearson matrix of ``(value, attr)`` over the rows the groups
    summarise, when ``attr`` is constant within a group.

    Each group row holds ``n`` values of ``value`` (their mean and population
    variance) that all pair with the group's ``attr``.  Pooled moments
    (within-group part + centred between-group part) give exactly the
    row-level statistics, so the row-level table is never built or joined.
    Global means come from one small aggregate over ``groups`` (materialize it
    first if it is expensive)."""
    g = groups.where((F.col(n) > 0) & F.col(attr).isNotNull() & ~F.isnan(F.col(attr)))
    head = g.agg(F.sum(n).alias("N"), F.sum(F.col(n) * F.col(mean)).alias("SA"),
                 F.sum(F.col(n) * F.col(attr)).alias("SD")).first()
    total = head["N"] or 0
    ma = head["SA"] / total if total else 0.0
    md = head["SD"] / total if total else 0.0
    da = F.col(mean) - F.lit(ma)
    dd = F.col(attr) - F.lit(md)
    w = F.col(n)
    mom = g.agg(F.coalesce(F.sum(w), F.lit(0)).cast("long").alias("_N"),
                F.sum(w * F.col(var) + w * da * da).alias("_m2a"),
                F.sum(w * dd * dd).alias("_m2d"),
                F.sum(w * da * dd).alias("_c"))

    def fmt(x):
        return F.round(x, digits) if digits is not None else x

    off = F.try_divide(F.col("_c"), F.sqrt(F.col("_m2a")) * F.sqrt(F.col("_m2d")))
    cells = [(value, value, F.when(F.col("_m2a") > 0, F.lit(1.0))),
             (value, attr, off), (attr, value, off),
             (attr, attr, F.when(F.col("_m2d") > 0, F.lit(1.0)))]
    return mom.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                 fmt(r).cast("double").alias("r"), F.col("_N").alias("n"))
        for a, b, r in cells])))


def co_moments(df: DataFrame, columns: Sequence[str]) -> dict:
    """Count, means and centred sums of products of ``columns`` over the rows
    where all are present: one aggregate, a few numbers on the driver.
    ``{"n", "mean": [..], "m": [[..]]}``, merged by :func:`merge_moments`."""
    cols, k = list(columns), len(columns)
    rows = df.where(_complete(df, cols)).select(*[F.col(c).cast("double").alias(c) for c in cols])
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    got = rows.agg(F.count(F.lit(1)), *[F.avg(c) for c in cols],
                   *[F.covar_pop(cols[i], cols[j]) for i, j in pairs]).first()
    n, m = got[0], [[0.0] * k for _ in cols]
    for (i, j), c in zip(pairs, got[1 + k:]):
        m[i][j] = m[j][i] = (c or 0.0) * n
    return {"n": n, "mean": [x or 0.0 for x in got[1:1 + k]], "m": m}


def merge_moments(a: dict, b: dict) -> dict:
    """The moments of two disjoint sets of rows together: within-part sums plus
    the centred part between the two means."""
    if not a["n"] or not b["n"]:
        return b if not a["n"] else a
    n, k = a["n"] + b["n"], len(a["mean"])
    d = [y - x for x, y in zip(a["mean"], b["mean"])]
    w = a["n"] * b["n"] / n
    return {"n": n, "mean": [x + di * b["n"] / n for x, di in zip(a["mean"], d)],
            "m": [[a["m"][i][j] + b["m"][i][j] + w * d[i] * d[j] for j in range(k)] for i in range(k)]}


def matrix_of_moments(spark: SparkSession, moments: dict, columns: Sequence[str], *,
                      digits: int | None = None) -> DataFrame:
    """The long-form matrix of :func:`correlation_matrix` from :func:`co_moments`."""
    m, cells = moments["m"], []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            varies = m[i][i] > 0 and m[j][j] > 0
            r = (1.0 if i == j else m[i][j] / (m[i][i] ** 0.5 * m[j][j] ** 0.5)) if varies else None
            cells.append((a, b, r, moments["n"]))
    out = spark.createDataFrame(cells, "col_a string, col_b string, r double, n long")
    return out if digits is None else out.withColumn("r", F.round("r", digits))


def matrix_wide(matrix: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The long-form matrix as ``k`` rows ``(col_a, <c1>, ..., <ck>)`` - the
    layout of a printed correlation matrix.  The pivot values are given, so
    no extra pass discovers them."""
    cols = list(columns)
    wide = matrix.groupBy("col_a").pivot("col_b", cols).agg(F.first("r"))
    return wide.select("col_a", *cols)
