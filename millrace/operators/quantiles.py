"""Exact order statistics of groups by distributed selection: values are counted in ranges that are refined until the rank is met.

No group is sorted or gathered. A round counts the rows of each range of each group (partial counts come before the exchange),
takes the range that holds the asked rank, and keeps its least and largest value; the next round looks at rows between these
alone. The first round cuts by sign and power of two, which holds for values of any spread; later ones cut the range
evenly. A range is settled when it has one value. A round needs at most ``CUTS`` counters a group, and after the first
one each narrows by that factor, so a few rounds do (at most about six, as a double has 52 bits within a power of two).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.sources.session import kept

CUTS = 4096
MOST_ROUNDS = 64


def median_rank(n: Column) -> Column:
    """The rank (from 0) of the upper median of n rows."""
    return F.floor(n / 2)


def nearest_rank(share: float):
    """The rank (from 0) of the nearest-rank percentile."""
    return lambda n: F.least(n - 1, F.ceil(n * F.lit(share)) - 1)


def _power(value: Column) -> Column:
    """A number that doesn't fall as the value rises: its sign and power of two."""
    size = F.abs(value)
    power = F.when(size == float("inf"), 2000).otherwise(F.floor(F.log2(F.greatest(size, F.lit(5e-324)))) + 1100)
    return F.when(value == 0, F.lit(0)).otherwise(F.signum(value) * power).cast("int")


def _picked(counted: DataFrame, by: list[str]) -> DataFrame:
    """Of the counters (by, name, cut, n, low, high, rank) the one that holds the rank, with what is left of it."""
    w = W.partitionBy(*by, "name").orderBy("cut")  # counters, CUTS at most
    before = F.coalesce(F.sum("n").over(w.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    held = counted.withColumn("before", before).where((F.col("before") <= F.col("rank")) & (F.col("rank") < F.col("before") + F.col("n")))
    return held.select(*by, "name", "low", "high", (F.col("rank") - F.col("before")).alias("rank"))


def order_statistics(rows: DataFrame, value: str, ranks: dict, by: tuple[str, ...] = (), told: list | None = None) -> DataFrame:
    """(by..., a column for each name of ``ranks``): values at the ranks, given as functions of a group's row count.

    Nulls and NaN aren't counted; a group without other values has no row. ``told`` gets the groups still open after each round.
    """
    own = ["__all"] if not by else list(by)
    given = rows.withColumn("__all", F.lit(0)) if not by else rows
    values = given.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).select(*own, F.col(value).cast("double").alias("v"))
    same = [F.col(f"r.{b}").eqNullSafe(F.col(f"b.{b}")) for b in own]

    def on():
        out = same[0]
        for s in same[1:]:
            out = out & s
        return out

    # round 0: every group's counters by power of two, shared by all ranks
    cut = values.groupBy(*own, _power(F.col("v")).alias("cut")).agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    total = F.sum("n").over(W.partitionBy(*own))  # some 4000 counters at most
    asked = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), rank(F.col("total")).cast("long").alias("rank")) for name, rank in ranks.items()]))
    state = kept(_picked(cut.withColumn("total", total).select(*own, "cut", "n", "low", "high", asked.alias("a")).select("*", "a.name", "a.rank"), own), "ranks")
    done = []
    for _ in range(MOST_ROUNDS):
        done.append(state.where("low = high"))
        open_ = state.where("low < high")
        left = open_.count()
        if told is not None:
            told.append(left)
        if left == 0:
            break
        r, b = values.alias("r"), open_.alias("b")
        near = r.join(b, on() & F.col("r.v").between(F.col("b.low"), F.col("b.high"))).select(*[F.col(f"b.{c}") for c in (*own, "name", "rank", "low", "high")], "r.v")
        # halves first, so that the width of a range can't overflow
        part = (F.col("v") / 2 - F.col("low") / 2) / (F.col("high") / 2 - F.col("low") / 2)
        placed = near.withColumn("cut", F.least(F.floor(part * CUTS), F.lit(CUTS - 1)).cast("int"))
        # the ends stand alone, so that every round narrows the range
        placed = placed.withColumn("cut", F.when(F.col("v") == F.col("low"), -1).when(F.col("v") == F.col("high"), CUTS).otherwise(F.col("cut")))
        counted = placed.groupBy(*own, "name", "rank", "cut").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        state = kept(_picked(counted, own), "ranks")
    else:
        raise RuntimeError("ranges did not settle")
    found = done[0]
    for part in done[1:]:
        found = found.unionByName(part)
    out = found.groupBy(*own).pivot("name", list(ranks)).agg(F.first("low"))
    return out.drop("__all")


def latency_percentiles(rows: DataFrame, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """p50: the upper median; p95: the nearest rank."""
    return order_statistics(rows, value, {"p50": median_rank, "p95": nearest_rank(0.95)}, by)
