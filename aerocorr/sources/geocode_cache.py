"""A geocode cache that grows by its lookups.

The cache is an append-only set of batches, Parquet tables bucketed by
coordinate, named by a commit log.  One round is: :meth:`GeocodeCache.worklist`
gives the coordinates that still need an answer, something outside Spark looks
them up, :meth:`GeocodeCache.add` parses the response bodies and appends what
the cache lacks.  A failed lookup is tried again until ``max_attempts``; after
that it counts as failed for good and the studies keep the position (fail-open)."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerocorr import schemas
from aerocorr.operators.geocode import parse_responses
from aerocorr.sources.commits import read_commit, write_commit

BATCH = "lat DOUBLE, lon DOUBLE, ok BOOLEAN, country STRING, attempt INT"


class GeocodeCache:
    """The cache under ``folder`` (shared storage); opened later, in any
    session, it goes on with what was committed.  ``fan``: batches from which
    they are merged into one."""

    def __init__(self, spark: SparkSession, folder: str, max_attempts: int = 3,
                 buckets: int | None = None, fan: int = 8):
        self.spark, self.folder, self.most, self.fan = spark, folder.rstrip("/"), max_attempts, fan
        self.state = read_commit(spark, self.folder) or {
            "batches": [], "version": 0,
            "buckets": buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))}

    def _table(self, name: str) -> DataFrame:
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS geocode_{name} ({BATCH}) USING parquet "
            f"CLUSTERED BY (lat, lon) SORTED BY (lat, lon) INTO {self.state['buckets']} BUCKETS "
            f"LOCATION '{self.folder}/{name}'")
        return self.spark.table(f"geocode_{name}")

    def _write(self, rows: DataFrame) -> str:
        name = uuid.uuid4().hex[:16]
        (rows.select("lat", "lon", "ok", "country", "attempt")
            .repartition(self.state["buckets"], "lat", "lon")
            .write.format("parquet").option("path", f"{self.folder}/{name}")
            .bucketBy(self.state["buckets"], "lat", "lon").sortBy("lat", "lon")
            .saveAsTable(f"geocode_{name}"))
        return name

    def _commit(self, batches: list[str]) -> None:
        state = {**self.state, "batches": batches}
        state["version"] = write_commit(self.spark, self.folder, state, self.state["version"])
        self.state = state

    def entries(self) -> DataFrame:
        """One row per coordinate ever looked up: lat, lon, ok, country (NULL
        without one), attempt (lookups so far)."""
        empty = self.spark.createDataFrame([], BATCH)
        rows = reduce(DataFrame.unionByName, map(self._table, self.state["batches"]), empty)
        return rows.groupBy("lat", "lon").agg(
            F.max("ok").alias("ok"), F.min(F.when(F.col("ok"), F.col("country"))).alias("country"),
            F.max("attempt").alias("attempt"))

    def settled(self) -> DataFrame:
        return self.entries().where(F.col("ok") | (F.col("attempt") >= self.most))

    def worklist(self, positions: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
        """Distinct coordinates (lat, lon) of ``positions`` that need a lookup."""
        wanted = positions.select(F.col(lat).alias("lat"), F.col(lon).alias("lon")).na.drop().distinct()
        return wanted.join(self.settled().select("lat", "lon"), ["lat", "lon"], "left_anti")

    def add(self, responses: DataFrame, body: str = "body") -> None:
        """Append the answers in ``responses`` (lat, lon and a response body).
        A coordinate that is settled stays as it is; of several answers for one
        coordinate a good one wins, then the smallest country; a row without
        coordinates is ignored."""
        parsed = parse_responses(responses.select("lat", "lon", body).na.drop(subset=["lat", "lon"]), body)
        country = F.nullif(F.col("country"), F.lit(""))
        one = parsed.groupBy("lat", "lon").agg(
            F.max("geocode_ok").alias("ok"), F.min(F.when(F.col("geocode_ok"), country)).alias("country"))
        before = self.entries().select("lat", "lon", F.col("ok").alias("_ok"), F.col("attempt").alias("_attempt"))
        fresh = (one.join(before, ["lat", "lon"], "left")
                 .where(~F.coalesce("_ok", F.lit(False)) & (F.coalesce("_attempt", F.lit(0)) < self.most))
                 .withColumn("attempt", F.coalesce("_attempt", F.lit(0)) + 1))
        self._commit(self.state["batches"] + [self._write(fresh)])
        if len(self.state["batches"]) >= self.fan:
            self._commit([self._write(self.entries())])

    def answers(self, failed: str = schemas.FAILED_LOOKUP) -> DataFrame:
        """(lat, lon, country) for :func:`aerocorr.operators.geocode.enrich_country`:
        answered coordinates, and ``failed`` for those that failed for good."""
        return self.settled().select("lat", "lon", F.when(F.col("ok"), F.col("country"))
                                     .otherwise(F.lit(failed)).alias("country"))

    def close(self) -> None:
        """Take the tables out of the session's catalog; their files stay."""
        for name in self.state["batches"]:
            self.spark.sql(f"DROP TABLE IF EXISTS geocode_{name}")
