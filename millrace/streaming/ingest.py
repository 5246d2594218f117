"""Checkpointed incremental ingestion with Structured Streaming.

The record log is the truth: every micro-batch drops what the log already completes, appends the rest and stops. A
batch that is repeated after a crash finds its own records in the log, so nothing is ingested twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def completed_ids(spark: SparkSession, log_path: str, schema: str) -> DataFrame:
    try:
        return spark.read.schema(schema).json(log_path).select("source_id").distinct()
    except AnalysisException:  # no log yet
        return spark.createDataFrame([], "source_id string")


def ingest_new(batch: DataFrame, log_path: str, schema: str, make_records: Callable[[DataFrame], DataFrame]) -> None:
    """Append records of the items whose source isn't completed yet, each source once."""
    done = completed_ids(batch.sparkSession, log_path, schema)
    fresh = batch.dropDuplicates(["source_id"]).join(done, "source_id", "left_anti")
    make_records(fresh).write.mode("append").option("ignoreNullFields", "false").json(log_path)


def run_ingest(spark: SparkSession, items_path: str, items_schema: str, log_path: str, log_schema: str, checkpoint: str, make_records: Callable[[DataFrame], DataFrame]):
    """All item files that have come since the last run, in micro-batches; returns the finished query."""
    items = spark.readStream.schema(items_schema).json(items_path)
    started = items.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(lambda df, _: ingest_new(df, log_path, log_schema, make_records)).start()
    started.awaitTermination()
    return started


def dedup_content(payloads: DataFrame, late: str = "1 hour", time_col: str = "fetched_at", digest_col: str = "sha256") -> DataFrame:
    """A stream of payloads without those whose digest came within the watermark."""
    return payloads.withWatermark(time_col, late).dropDuplicatesWithinWatermark([digest_col])


def progress(state_counts: DataFrame, page: int, pages: int) -> DataFrame:
    """One row of progress for a report."""
    return state_counts.select(F.lit(page).alias("page"), F.lit(pages).alias("pages"), "*")


def discovery_complete(seen: int, total: int | None, stable_passes: int, passes_allowed: int) -> bool:
    """A listing is complete when all of it was seen and its total held for one pass, or two where several are allowed."""
    return total is not None and seen == total and stable_passes >= (1 if passes_allowed == 1 else 2)
