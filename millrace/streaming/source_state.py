"""What is known of each source, kept by key while a stream of actions comes in, with timers that bring back what is pending.

Every key has a value (the last completion and the last failure by their numbers, and how often it was brought back) and a map
of counts by action. A source that is pending gets a timer in event time; if it fires before a completion, the source is
given out to be tried again, and the next timer waits twice as long, up to ``tries`` times. A completion removes the timer.
State is in the stream's checkpoint (RocksDB), so a stream that starts again knows all keys and timers; a batch may look
keys up there with ``look_up`` without running the stream.

After any batch ``current`` equals ``sync_state.fold_actions`` over the actions that came till then.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUT = "source_id string, kind string, seen boolean, completed boolean, pending boolean, tries int, at timestamp"
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
NEVER = -1


class SourceState(StatefulProcessor):
    def __init__(self, wait_ms: int, tries: int):
        self.wait_ms, self.tries = wait_ms, tries

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "completed long, pending long, tries int")
        self.counts = handle.getMapState("counts", "action string", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        """Every call of the state is a round trip to the executor, so what is known of a key is asked for once."""
        held = self.last.get()
        done, failed, tries = held or (NEVER, NEVER, 0)
        waits = failed > done  # only then a timer can be set
        came, when = {}, None
        for r in rows:
            came[r["action"]] = came.get(r["action"], 0) + 1
            if r["seq"] is None:
                continue
            if r["action"] == "completed":
                done = max(done, r["seq"])
            elif r["action"] == "pending" and r["seq"] > failed:
                failed, when = r["seq"], r["ms"]
        before = {k[0]: v[0] for k, v in self.counts.iterator()} if held else {}
        for action, n in came.items():
            if action is not None:
                self.counts.updateValue((action,), (before.get(action, 0) + n,))
        pending = failed > done
        if waits and (not pending or when is not None):
            self._drop_timers()
        if not pending:
            tries = 0
        elif when is not None:
            self.handle.registerTimer(when + self.wait_ms * 2**tries)
        self.last.update((done, failed, tries))
        yield self._row(key, "state", done, pending, tries, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        done, failed, tries = self.last.get()
        if failed > done and tries < self.tries:
            tries += 1
            self.last.update((done, failed, tries))
            at = expiredTimerInfo.getExpiryTimeInMs()
            if tries < self.tries:
                self.handle.registerTimer(at + self.wait_ms * 2**tries)
            yield self._row(key, "again", done, True, tries, at)

    def _drop_timers(self) -> None:
        for expiry in list(self.handle.listTimers()):
            self.handle.deleteTimer(expiry)

    @staticmethod
    def _row(key, kind: str, done: int, pending: bool, tries: int, at_ms: int) -> Row:
        return Row(source_id=key[0], kind=kind, seen=True, completed=done > NEVER, pending=pending, tries=tries, at=at_ms)


def keyed_state(actions: DataFrame, late: str = "0 seconds", wait_ms: int = 3_600_000, tries: int = 3) -> DataFrame:
    """The stream of changes of a stream of actions (source_id, seq, action, ts)."""
    actions.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    rows = actions.select(F.col("source_id").cast("string").alias("source_id"), F.col("seq").cast("long").alias("seq"), "action", F.unix_millis("ts").alias("ms"), "ts").withWatermark("ts", late)
    changes = rows.groupBy("source_id").transformWithState(statefulProcessor=SourceState(wait_ms, tries), outputStructType=OUT.replace("at timestamp", "at long"), outputMode="Update", timeMode="EventTime")
    return changes.withColumn("at", F.timestamp_millis("at"))


def run(changes: DataFrame, folder: str, checkpoint: str) -> None:
    """Run the stream until all that is there has been taken in; each batch's changes are written once, repeated batches included."""
    spark = changes.sparkSession
    # a batch without rows would move the watermark once more, at a time that depends on when the stream is stopped
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")

    def put(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    query = changes.writeStream.option("checkpointLocation", checkpoint).outputMode("update").foreachBatch(put).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def changes_of(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"{OUT}, batch long").parquet(folder)


def current(spark: SparkSession, folder: str) -> DataFrame:
    """(source_id, seen, completed, pending) after the last batch."""
    rows = changes_of(spark, folder).where("kind = 'state'")
    last = rows.groupBy("source_id").agg(F.max_by(F.struct("seen", "completed", "pending"), "batch").alias("s"))
    return last.select("source_id", "s.seen", "s.completed", "s.pending")


def look_up(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(source_id, completed, pending, tries) as the stream's checkpoint holds them; numbers of -1 stand for never."""
    rows = spark.read.format("statestore").option("stateVarName", "last").load(checkpoint)
    return rows.select(F.col("key.source_id").alias("source_id"), "value.completed", "value.pending", "value.tries")
