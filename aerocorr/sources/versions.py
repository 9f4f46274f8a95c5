"""Versioned tables: compute once, reload while the inputs stay the same.

A table at a path is a row of snapshot folders and a commit log that names the
current one (:mod:`aerocorr.sources.commits`).  A refresh writes a new folder
and then commits it, so readers that opened the table before keep the old
files; :func:`expire` removes folders of old versions.  A commit holds the
fingerprints of the inputs it was computed from."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocorr.sources.commits import read_commit, remove, versions, write_commit


def fingerprint(df: DataFrame) -> str:
    """Of the rows of ``df`` as a bag, whatever their order or files: count,
    sum and exclusive or of 64-bit row hashes (one aggregate)."""
    cols = sorted(df.columns)
    h = F.xxhash64(*cols, *[F.col(c).isNull() for c in cols])
    n, total, xor = df.select(h.alias("h")).agg(
        F.count(F.lit(1)), F.sum(F.col("h").cast("decimal(20,0)")), F.bit_xor("h")).first()
    return f"{','.join(cols)}|{n}|{total or 0}|{xor or 0}"


def open_version(spark: SparkSession, path: str, version: int | None = None,
                 part: str = "table") -> DataFrame | None:
    """The table at ``path`` as of ``version`` (default: the last one); None
    where nothing is committed."""
    state = read_commit(spark, path, version)
    return None if state is None else spark.read.parquet(f"{path}/{state['folder']}/{part}")


def snapshot(spark: SparkSession, path: str, parts: dict[str, DataFrame], info: dict,
             after: int | None = None) -> int:
    """Write ``parts`` (``table`` among them) as a new version of ``path``."""
    folder = f"v-{uuid.uuid4().hex[:12]}"
    for name, df in parts.items():
        df.write.parquet(f"{path}/{folder}/{name}")
    return write_commit(spark, path, {**info, "folder": folder}, after)


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove the folders of all but the last ``keep`` versions; their numbers.
    A folder that a kept version names stays."""
    found = versions(spark, path)
    held = {read_commit(spark, path, v)["folder"] for v in found[-keep:]}
    gone = []
    for v in found[:-keep]:
        folder = read_commit(spark, path, v)["folder"]
        if folder not in held:
            remove(spark, f"{path}/{folder}")
            gone.append(v)
    return gone


def refresh_changed(spark: SparkSession, path: str, rows: DataFrame, side: DataFrame,
                    compute: Callable[[DataFrame], DataFrame], key: str,
                    settings: str = "", refresh: bool | str = "changed") -> DataFrame:
    """The table ``compute(rows)`` at ``path``, where a key's result depends only
    on that key's ``rows``, on ``side`` and on ``settings``.

    ``refresh="changed"``: with equal inputs the stored version is reloaded; if
    only rows changed, just the keys whose rows differ are computed, the others
    are carried over; a changed ``side`` or setting computes all.  ``True``
    computes all, ``False`` reloads whatever is stored (and computes if nothing
    is).  ``rows`` is read several times; hand in a written table."""
    state = read_commit(spark, path)
    if refresh is False and state is not None:
        return open_version(spark, path)
    after = state["version"] if state else 0
    rows = rows.distinct()
    info = {"side": fingerprint(side), "rows": fingerprint(rows), "settings": settings}
    same = state is not None and all(state.get(k) == info[k] for k in ("side", "settings"))
    if refresh == "changed" and same and state["rows"] == info["rows"]:
        return open_version(spark, path)
    table = None
    if refresh == "changed" and same:
        old = open_version(spark, path, after, "rows")
        # a key whose rows differ on either side; distinct rows, so a union counts them
        tagged = rows.withColumn("_new", F.lit(1)).unionByName(old.withColumn("_new", F.lit(0)))
        changed = (tagged.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("_n")).where("_n = 1")
                   .select(key).distinct())
        stale = f"{path}/changed-{uuid.uuid4().hex[:12]}"
        changed.write.parquet(stale)
        changed = spark.read.parquet(stale)
        here = F.col(key).eqNullSafe(F.col("_key"))
        one = changed.select(F.col(key).alias("_key"))
        table = (open_version(spark, path, after).join(one, here, "left_anti")
                 .unionByName(compute(rows.join(one, here, "left_semi"))))
    snapshot(spark, path, {"table": compute(rows) if table is None else table, "rows": rows}, info, after)
    if table is not None:
        remove(spark, stale)
    return open_version(spark, path)
