"""Numbered commit files beside a table: the last one says which folders hold
the table now.  Writers add folders first and the commit file last, so a reader
sees one whole state or the one before it.  The files go through Hadoop's
file-system interface, on whatever storage the path names."""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import SparkSession

LOG = "_commits"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the commits under ``root``, ascending; empty without any."""
    fs, path = _fs(spark, root)
    log = path(f"{root}/{LOG}")
    if not fs.exists(log):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(log)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def read_commit(spark: SparkSession, root: str, version: int | None = None) -> dict | None:
    """What commit ``version`` (default: the last) holds; None without commits."""
    found = versions(spark, root)
    if version is None:
        if not found:
            return None
        version = found[-1]
    elif version not in found:
        raise ValueError(f"{root} has no version {version}")
    fs, path = _fs(spark, root)
    stream = fs.open(path(f"{root}/{LOG}/{version:09d}.json"))
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return {**json.loads(text), "version": version}


def write_commit(spark: SparkSession, root: str, state: dict, after: int | None = None) -> int:
    """Publish ``state`` as the next version.  ``after``: the version that the
    writer started from; if another writer committed since, nothing is written
    and the call fails, so no update is lost."""
    found = versions(spark, root)
    last = found[-1] if found else 0
    if after is not None and after != last:
        raise RuntimeError(f"{root} is at version {last}, not {after}: another writer committed")
    fs, path = _fs(spark, root)
    hidden = path(f"{root}/{LOG}/.{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    out.write(json.dumps({k: v for k, v in state.items() if k != "version"}).encode())
    out.close()
    target = path(f"{root}/{LOG}/{last + 1:09d}.json")
    if fs.exists(target) or not fs.rename(hidden, target):
        fs.delete(hidden, False)
        raise RuntimeError(f"{root}: version {last + 1} was taken by another writer")
    return last + 1


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that no commit names any more."""
    fs, path = _fs(spark, folder)
    fs.delete(path(folder), True)


def drop_unnamed(spark: SparkSession, root: str, parts: Sequence[str]) -> None:
    """Remove the folders of ``parts`` that only the commit before the last two names."""
    found = versions(spark, root)
    if len(found) < 3:
        return
    older, *kept = [{f for p in parts for f in read_commit(spark, root, v)[p]} for v in found[-3:]]
    for folder in older - set().union(*kept):
        remove(spark, f"{root}/{folder}")
