"""The state of all sources as versioned snapshots of a log, and the tail that came after the newest one.

A log folder holds

* ``log/batch=<n>``: actions, appended batch by batch;
* ``data/version=<v>/bucket=<b>``: for each source of a bucket the numbers of its last completion and its last failure. A
  snapshot writes the buckets that the tail has touched and no other;
* ``versions/version=<v>``: for each bucket the version whose data hold it, and the last batch that the snapshot covers. It is
  written last and makes a snapshot valid, so a snapshot that breaks off leaves the one before in place.

State folds like the log does, by maxima, so snapshot and tail are merged by the same aggregation. Reading state prunes the log
to the batches after the snapshot, and a look-up prunes data to the buckets of the sources asked for.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.session import delete_path, path_exists

BUCKETS = 32
ACTION = "source_id string, seq long, action string"
HELD = "source_id string, c long, p long, bucket int"
VERSION = "bucket int, data_version int, last_batch int"


def bucket_of(source: Column) -> Column:
    return F.pmod(F.xxhash64(source), F.lit(BUCKETS)).cast("int")


@dataclass(frozen=True)
class StateLog:
    spark: SparkSession
    path: str

    def _rows(self, table: str, schema: str, key: str) -> DataFrame:
        if not path_exists(self.spark, f"{self.path}/{table}"):
            return self.spark.createDataFrame([], f"{schema}, {key} int")
        return self.spark.read.schema(f"{schema}, {key} int").parquet(f"{self.path}/{table}")

    def _last(self, table: str, schema: str, key: str) -> int:
        """The highest number of a table's folders, -1 if there is none."""
        top = self._rows(table, schema, key).agg(F.max(key)).first()[0]
        return -1 if top is None else top

    def version(self) -> tuple[int, int, dict[int, int]]:
        """(newest valid version, the last batch it covers, the version that holds each bucket's data); -1 if there is none."""
        newest = self._last("versions", VERSION, "version")
        if newest < 0:
            return -1, -1, {}
        rows = self._rows("versions", VERSION, "version").where(F.col("version") == newest).collect()  # a row for each bucket
        return newest, rows[0]["last_batch"], {r["bucket"]: r["data_version"] for r in rows if r["data_version"] is not None}

    def append(self, actions: DataFrame) -> int:
        """Add a batch of actions (source_id, seq, action) to the log; returns its number. One writer at a time."""
        number = max(self._last("log", ACTION, "batch"), self.version()[1]) + 1
        actions.select("source_id", F.col("seq").cast("long").alias("seq"), "action").write.parquet(f"{self.path}/log/batch={number}")
        return number

    def tail(self, after: int) -> DataFrame:
        """(source_id, c, p, bucket): the fold of the batches after one."""
        at = {a: F.max(F.when(F.col("action") == a, F.col("seq"))) for a in ("completed", "pending")}
        rows = self._rows("log", ACTION, "batch").where(F.col("batch") > after).where("source_id IS NOT NULL")
        return rows.groupBy("source_id").agg(at["completed"].alias("c"), at["pending"].alias("p")).withColumn("bucket", bucket_of(F.col("source_id")))

    def held(self, where: dict[int, int], buckets: Iterable[int] | None = None) -> DataFrame:
        """(source_id, c, p, bucket) of a snapshot, of some buckets only if they are given."""
        by_version: dict[int, list[int]] = {}
        for bucket, version in where.items():
            if buckets is None or bucket in buckets:
                by_version.setdefault(version, []).append(bucket)
        chosen = F.lit(False)
        for version, own in by_version.items():
            chosen = chosen | ((F.col("version") == version) & F.col("bucket").isin(own))
        return self._rows("data", HELD, "version").where(chosen).select("source_id", "c", "p", "bucket")

    def _merged(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("source_id", "bucket").agg(F.max("c").alias("c"), F.max("p").alias("p"))

    def state(self, sources: Iterable[str] | None = None) -> DataFrame:
        """(source_id, seen, completed, pending) now; of some sources only if they are given."""
        _, last, where = self.version()
        own, tail = None, self.tail(last)
        if sources is not None:
            sources = list(sources)
            asked = self.spark.createDataFrame([(s,) for s in sources], "source_id string")
            own = {r[0] for r in asked.select(bucket_of(F.col("source_id"))).distinct().collect()}
            tail = tail.where(F.col("source_id").isin(sources))
        held = self.held(where, own)
        held = held if sources is None else held.where(F.col("source_id").isin(sources))
        rows = self._merged(held.unionByName(tail))
        pending = F.coalesce(F.col("p") > F.coalesce("c", F.lit(-1)), F.lit(False))
        return rows.select("source_id", F.lit(True).alias("seen"), F.col("c").isNotNull().alias("completed"), pending.alias("pending"))

    def snapshot(self) -> int:
        """Fold the tail into a new version; buckets without new actions stay where they are. Returns the version."""
        newest, last, where = self.version()
        upto = self._last("log", ACTION, "batch")
        if upto <= last:
            return newest
        version = max(newest, self._last("data", HELD, "version")) + 1  # never over what a broken snapshot has left
        tail = self.tail(last)
        touched = sorted(r[0] for r in tail.select("bucket").distinct().collect())  # BUCKETS at most
        rows = self._merged(self.held(where, touched).unionByName(tail))
        rows.repartition(BUCKETS, "bucket").sortWithinPartitions("bucket", "source_id").select("source_id", "c", "p", "bucket").write.partitionBy("bucket").parquet(f"{self.path}/data/version={version}")
        now = where | dict.fromkeys(touched, version)
        listed = [(b, now.get(b), upto) for b in range(BUCKETS)]
        self.spark.createDataFrame(listed, VERSION).coalesce(1).write.parquet(f"{self.path}/versions/version={version}")
        return version

    def compact(self) -> None:
        """Delete what the newest snapshot doesn't need: covered batches of the log, older versions, data no bucket refers to."""
        newest, last, where = self.version()
        if newest < 0:
            return
        gone = [("versions", "version", lambda v: v < newest), ("log", "batch", lambda b: b <= last), ("data", "version", lambda v: v not in where.values())]
        for (table, key, drop), schema in zip(gone, (VERSION, ACTION, HELD)):
            for r in self._rows(table, schema, key).select(key).distinct().collect():
                if drop(r[0]):
                    delete_path(self.spark, f"{self.path}/{table}/{key}={r[0]}")
