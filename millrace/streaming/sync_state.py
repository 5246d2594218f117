"""Incremental ingestion state as a fold of an action log, in batch and as a stream.

The log is the truth: state is recomputed from it, so recovery after a crash is the same query. Actions are seen,
completed and pending; completed also means seen and ends pending until a later failure.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def fold_actions(actions: DataFrame, id_col: str = "source_id", order_col: str = "seq") -> DataFrame:
    """(source_id, seen, completed, pending) of all sources in the log."""
    at = {a: F.max(F.when(F.col("action") == a, F.col(order_col))) for a in ("completed", "pending")}
    rows = actions.groupBy(id_col).agg(at["completed"].alias("c"), at["pending"].alias("p"))
    pending = F.coalesce(F.col("p") > F.coalesce("c", F.lit(-1)), F.lit(False))
    return rows.select(id_col, F.lit(True).alias("seen"), F.col("c").isNotNull().alias("completed"), pending.alias("pending"))


def state_counts(state: DataFrame) -> DataFrame:
    return state.agg(F.count_if("seen").alias("seen_count"), F.count_if("completed").alias("completed_count"), F.count_if("pending").alias("pending_count"))


def reconcile_pending(pending: DataFrame, completed: DataFrame, id_col: str = "source_id") -> DataFrame:
    """Pending sources that the record log doesn't show as completed."""
    return pending.join(completed.select(id_col), id_col, "left_anti")


def unseen(items: DataFrame, state: DataFrame, id_col: str = "source_id") -> DataFrame:
    """Items that are neither seen nor completed, each source once."""
    return items.dropDuplicates([id_col]).join(state.where("seen OR completed").select(id_col), id_col, "left_anti")


def status_counters(items: DataFrame, selected: Column, id_col: str = "source_id", order_col: str = "seq", status_col: str = "status") -> DataFrame:
    """(status, status_count, skipped_count): sources by status when first seen; unselected items every time."""
    first = F.row_number().over(W.partitionBy(id_col).orderBy(order_col)) == 1
    return items.withColumn("first", first).groupBy(status_col).agg(F.count_if("first").alias("status_count"), F.count_if(~selected).alias("skipped_count"))


def total_drift(pages: DataFrame, by: list[str], order_col: str, total_col: str = "total") -> DataFrame:
    """Pages whose reported total isn't that of the page before them."""
    before = F.lag(total_col).over(W.partitionBy(*by).orderBy(order_col))
    return pages.withColumn("before", before).where(F.col("before") != F.col(total_col)).select(*by, order_col, "before", total_col)
