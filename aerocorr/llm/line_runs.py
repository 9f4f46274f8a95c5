"""Line dedup over levelled sorted runs of line hashes.

The index holds, for every line key, in how many documents it was met and the
largest doc_id that holds it.  It is a set of runs, Parquet tables bucketed and
sorted by the 128-bit hash of the key.  A batch of documents is reduced to one
row per key, anti-joined with every run (the runs need no shuffle) - a key that
a run has already settled adds nothing - and what is left becomes a run of
level 0.  Once ``fan`` runs of a level have gathered they are merged into one of
the next, so n batches leave about fan * log(n) runs.  A commit file names the
runs that count; an index opened later, in any session, goes on from it.

``dedup_lines`` puts the documents into the index in ranges of doc_id, largest
first, so a line's keeper is known early and later batches find most frequent
lines settled.  Then every line meets the merged runs.  A line may be in a
third of all documents: keys above a share of all lines (so at most ``HOT``
times the batches of them) meet by broadcast, the others by a shuffle join.

A line's key is the line without white space (space, tab to carriage return) at
both ends, A-Z lower-cased.  A key of at least ``least_chars`` code points in at
least ``least_docs`` documents loses all its lines except those of the largest
doc_id that holds it; all other lines stay, in order.

Defined cases: a null text is the empty text, which is one empty line; a text
whose lines all go becomes empty; every row is a document of its own, also
where rows repeat a doc_id, and rows of the largest doc_id all keep the line; a
null doc_id is smaller than any other; an empty table leaves the index as it
is.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocorr.config import work_dir
from aerocorr.llm.common import heavy_join, shuffle_partitions, written
from aerocorr.sources.commits import read_commit, write_commit

LEAST_CHARS = 20
LEAST_DOCS = 3
HOT = 4096  # keys above 1/HOT of a batch's share of all lines meet by broadcast
BLANK = " \t\n\x0b\x0c\r"
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
RUN = "h1 BIGINT, h2 BIGINT, docs BIGINT, keep BIGINT"


class LineRuns:
    """The index under ``folder`` (shared storage).  ``least_docs``: documents
    from which a key counts as frequent."""

    def __init__(self, spark: SparkSession, folder: str, least_docs: int = LEAST_DOCS,
                 fan: int = 2, buckets: int | None = None):
        self.spark, self.folder, self.least, self.fan = spark, folder.rstrip("/"), least_docs, fan
        self.known: set[str] = set()
        state = read_commit(spark, self.folder)
        self.state = state or {"runs": [], "version": 0,
                               "buckets": buckets or shuffle_partitions(spark)}

    def runs(self) -> list[dict]:
        """{level, name} of the runs that count, oldest first."""
        return self.state["runs"]

    def _name(self, run: dict) -> str:
        name = f"line_run_{run['name']}"
        self.known.add(name)
        return name

    def run(self, run: dict) -> DataFrame:
        """The table of a run; a session that does not know it yet is told
        where its files lie and how they are bucketed."""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self._name(run)} ({RUN}) USING parquet "
            f"CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.state['buckets']} BUCKETS "
            f"LOCATION '{self.folder}/{run['name']}'")
        return self.spark.table(self._name(run))

    def _write(self, rows: DataFrame, level: int) -> dict:
        run = {"level": level, "name": uuid.uuid4().hex[:16]}
        (rows.select("h1", "h2", "docs", "keep").repartition(self.state["buckets"], "h1", "h2")
            .write.format("parquet").option("path", f"{self.folder}/{run['name']}")
            .bucketBy(self.state["buckets"], "h1", "h2").sortBy("h1", "h2")
            .saveAsTable(self._name(run)))
        return run

    def _commit(self, runs: list[dict]) -> None:
        state = {**self.state, "runs": runs}
        state["version"] = write_commit(self.spark, self.folder, state, self.state["version"])
        self.state = state

    def fresh(self, batch: DataFrame) -> DataFrame:
        """``batch`` (h1, h2, docs, keep; one row per key) without the keys that
        a run has settled: frequent there, with a keeper as large."""
        for i, run in enumerate(self.runs()):
            old = self.run(run).where(F.col("docs") >= self.least).select(
                F.col("h1").alias("r1"), F.col("h2").alias("r2"), F.col("keep").alias("rk"))
            batch = batch.join(old.hint("merge"), (F.col("h1") == F.col("r1"))
                               & (F.col("h2") == F.col("r2"))
                               & (F.col("keep").isNull() | (F.col("rk") >= F.col("keep"))),
                               "left_anti")
        return batch

    def add(self, batch: DataFrame) -> None:
        """Add the run of a batch and compact the levels that are full."""
        self._commit(self.runs() + [self._write(self.fresh(batch), 0)])
        level = 0
        while sum(r["level"] == level for r in self.runs()) >= self.fan:
            full = [r for r in self.runs() if r["level"] == level]
            rest = [r for r in self.runs() if r["level"] != level]
            self._commit(rest + [self._write(self.merged(full), level + 1)])
            level += 1

    def merged(self, runs: list[dict] | None = None) -> DataFrame:
        """(h1, h2, docs, keep), one row per key of ``runs`` (default: all).
        ``docs`` of a frequent key is a lower bound, never below the least."""
        rows = self.spark.createDataFrame([], RUN)
        for run in self.runs() if runs is None else runs:
            rows = rows.unionByName(self.run(run))
        return rows.groupBy("h1", "h2").agg(F.sum("docs").alias("docs"), F.max("keep").alias("keep"))

    def frequent(self) -> DataFrame:
        return self.merged().where(F.col("docs") >= self.least)

    def close(self) -> None:
        """Take the runs out of the session's catalog; their files stay."""
        while self.known:
            self.spark.sql(f"DROP TABLE IF EXISTS {self.known.pop()}")


def _keys(least: int):
    """Batches (doc_id, mark, text) -> a row for each line with a long key:
    doc_id, mark, place, h1, h2, first (whether the text has the key there first)."""
    def rows(batch):
        for doc, mark, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
            seen = set()
            for place, line in enumerate((text or "").split("\n")):
                key = line.strip(BLANK)
                if len(key) >= least:
                    h = hashlib.blake2b(key.translate(LOWER).encode(), digest_size=16).digest()
                    yield (doc, mark, place, int.from_bytes(h[:8], "little", signed=True),
                           int.from_bytes(h[8:], "little", signed=True), h not in seen)
                    seen.add(h)

    def run(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("place", pa.int32()),
                            ("h1", pa.int64()), ("h2", pa.int64()), ("first", pa.bool_())])
        out = []
        for batch in batches:
            for row in rows(batch):
                out.append(row)
                if len(out) >= 50_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), schema.types)], schema=schema)
    return run


def _without(batches):
    """Batches (doc_id, text, gone: places of lines) -> doc_id, text, n_lines, n_dropped."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.large_string()), ("n_lines", pa.int64()),
                        ("n_dropped", pa.int64())])
    for batch in batches:
        out = []
        for text, gone in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            text = text or ""
            n = text.count("\n") + 1
            if gone:
                away = set(gone)
                text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in away)
            out.append((text, n, len(gone or ())))
        cols = list(zip(*out)) or [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64())] + [pa.array(c, t) for c, t in zip(cols, schema.types[1:])],
            schema=schema)


def dedup_lines(spark: SparkSession, docs: DataFrame, index: LineRuns | None = None,
                least_chars: int = LEAST_CHARS, least_docs: int = LEAST_DOCS,
                batches: int = 4) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, the text that is
    left, n_lines (before) and n_dropped.  With an ``index`` that has met other
    documents before, their lines count as well."""
    index = index or LineRuns(spark, work_dir(spark, "line_runs"), least_docs)
    few = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"), "text")
    lines = written(spark, few.mapInArrow(
        _keys(least_chars), "doc_id long, mark long, place int, h1 long, h2 long, first boolean"), "lines")
    low, high, total = lines.agg(F.min("doc_id"), F.max("doc_id"), F.count("*")).first()
    if low is None:
        low = high = 0
    part = F.least(F.lit(batches - 1), F.floor(
        (F.col("doc_id").cast("double") - float(low)) / (float(high) - float(low) + 1) * batches))
    met = written(spark, lines.where("first").groupBy(
        F.coalesce(part, F.lit(0)).cast("int").alias("batch"), "h1", "h2").agg(
        F.count(F.lit(1)).alias("docs"), F.max("doc_id").alias("keep")), "line_batches")
    if total:
        for i in reversed(range(batches)):
            index.add(met.where(F.col("batch") == i).drop("batch"))
    gone = written(spark, index.frequent(), "frequent_lines")
    index.close()
    hot = met.where(F.col("docs") * (HOT * batches) >= total).select("h1", "h2").distinct()
    places = (heavy_join(lines.drop("first"), gone.select("h1", "h2", "keep"), ["h1", "h2"], hot)
              .where(~F.col("doc_id").eqNullSafe(F.col("keep")))
              .groupBy(F.col("doc_id").alias("d"), F.col("mark").alias("m"))
              .agg(F.collect_set("place").alias("gone")))
    return (few.join(places, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("mark") == F.col("m")), "left")
            .select("doc_id", "text", "gone")
            .mapInArrow(_without, "doc_id long, text string, n_lines long, n_dropped long"))
