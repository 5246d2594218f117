"""As-of joins: for each row the version that was in force at its time.

A version of a key is in force from its start until the next version of that key starts, and no longer than its own end (none
means open); both its first and its last moment count. So of overlapping versions the one that started last decides, and a
version that is over doesn't give way to an earlier one.

Both sides are sorted together by key and time and the last version is carried on; nothing is paired by range. Time is cut into
slices: a key is sorted slice by slice in different tasks, and what is in force where a slice begins comes from the last version
of the slices before it, of which there is one row each. So a key that holds most rows is many tasks' work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLICE_DAYS = 64


def as_of(rows: DataFrame, versions: DataFrame, key: str, at: str, start: str = "start", end: str = "end", keep: tuple[str, ...] = (), slice_days: int = SLICE_DAYS) -> DataFrame:
    """All columns of ``rows`` and the columns ``keep`` of the version in force at ``at``, null where none is.

    Rows without key or time have no version; versions without key or start never are in force. Of versions of one key that start
    together the one with the larger end (open is largest), then the larger ``keep`` counts.
    """
    if slice_days < 1:
        raise ValueError("slice_days must be positive")

    def sliced(time):
        return F.floor(F.unix_seconds(time.cast("timestamp")) / (86_400 * slice_days))

    told = F.struct(F.col(start).cast("timestamp").alias("start"), F.col(end).isNull().alias("open"), F.col(end).cast("timestamp").alias("end"), *keep)
    held = versions.where(F.col(key).isNotNull() & F.col(start).isNotNull())
    held = held.select(F.col(key).alias("k"), F.col(start).cast("timestamp").alias("t"), told.alias("v"), sliced(F.col(start)).alias("s"))
    asked = rows.select(F.col(key).alias("k"), F.col(at).cast("timestamp").alias("t"), sliced(F.col(at)).alias("s"), F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row"))
    loose = asked.where("k IS NULL OR t IS NULL")

    # one row for each slice of a key, which tells what is in force where the slice begins
    last = held.groupBy("k", "s").agg(F.max("v").alias("v"))
    slices = last.unionByName(asked.where("k IS NOT NULL AND t IS NOT NULL").select("k", "s").distinct(), allowMissingColumns=True).groupBy("k", "s").agg(F.max("v").alias("v"))
    before = F.max("v").over(W.partitionBy("k").orderBy("s").rowsBetween(W.unboundedPreceding, -1))
    carried = slices.select("k", "s", before.alias("v")).where("v IS NOT NULL").withColumn("t", F.lit(None).cast("timestamp"))

    both = held.unionByName(carried).withColumn("is_row", F.lit(False)).unionByName(asked.where("k IS NOT NULL AND t IS NOT NULL").withColumn("is_row", F.lit(True)), allowMissingColumns=True)
    running = W.partitionBy("k", "s").orderBy(F.col("t").asc_nulls_first(), "is_row").rowsBetween(W.unboundedPreceding, W.currentRow)
    found = both.withColumn("v", F.max("v").over(running)).where("is_row").select("row", "v", "t")
    valid = F.col("v.open") | (F.col("t") <= F.col("v.end"))
    found = found.withColumn("v", F.when(valid, F.col("v"))).select("row", "v")
    found = found.unionByName(loose.select("row").withColumn("v", F.lit(None).cast(found.schema["v"].dataType)))
    return found.select("row.*", *[F.col(f"v.{c}").alias(c) for c in keep])
