"""What of a ranking goes into a context: chosen in the order of scores, against overlap and within a budget of tokens.

A candidate is a span of a document. What counts of it is the part that no chosen span of the same document covers: its score is
weighed by that part's share, and only that part's tokens are charged. A candidate whose weighed score falls below ``least`` of the
query's best score, or that doesn't fit in what is left of the budget, is passed over; later ones may still fit.

The choice of one query is a fold over its candidates, of which a ranking has a bounded number. Queries don't meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPAN = "array<struct<start:int,end:int>>"
HELD = "array<struct<document_id:string,start:int,end:int>>"
TAKEN = f"array<struct<rank:bigint,document_id:string,start:int,end:int,parts:{SPAN},tokens:bigint,used:bigint>>"


def minus(parts: Column, start: Column, end: Column) -> Column:
    """Stretches without what lies between start and end."""

    def rest(p):
        both = F.array(F.struct(p["start"].alias("start"), F.least(p["end"], start).alias("end")), F.struct(F.greatest(p["start"], end).alias("start"), p["end"].alias("end")))
        return F.filter(both, lambda x: x["start"] < x["end"])

    return F.flatten(F.transform(parts, rest))


def size_of(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0).cast("bigint"), lambda n, p: n + p["end"] - p["start"])


def pack_context(ranked: DataFrame, budget: int, least: float = 0.25, by: str = "query_id") -> DataFrame:
    """(by, rank, document_id, start, end, parts, tokens, used) of what is chosen; ``parts`` are the stretches it adds.

    ``ranked``: (by, rank, score, document_id, source_start, source_end, n_tokens), of bounded length for each query. Spans that are
    empty, and candidates without document or score, are passed over; tokens of a part are its share of the span's, rounded up.
    """
    if budget < 1 or not 0 <= least <= 1:
        raise ValueError("budget must be positive and least a share")
    sound = ranked.where("source_start < source_end AND document_id IS NOT NULL AND score IS NOT NULL")
    one = F.struct(F.col("rank").cast("bigint").alias("rank"), F.col("score").cast("double").alias("score"), F.col("document_id").cast("string").alias("document_id"), F.col("source_start").cast("int").alias("start"), F.col("source_end").cast("int").alias("end"), F.col("n_tokens").cast("bigint").alias("n"))
    lists = sound.groupBy(by).agg(F.sort_array(F.collect_list(one)).alias("candidates"), F.max(F.col("score").cast("double")).alias("top"))

    def step(state, c):
        whole = F.array(F.struct(c["start"].alias("start"), c["end"].alias("end")))
        own = F.filter(state["held"], lambda h: h["document_id"] == c["document_id"])
        parts = F.aggregate(own, whole.cast(SPAN), lambda p, h: minus(p, h["start"], h["end"]))
        new, size = size_of(parts), c["end"] - c["start"]
        cost = F.ceil(c["n"] * new / size).cast("bigint")
        fits = (new > 0) & (c["score"] * new / size >= F.col("top") * least) & (state["used"] + cost <= budget)
        taken = F.struct(c["rank"].alias("rank"), c["document_id"].alias("document_id"), c["start"].alias("start"), c["end"].alias("end"), parts.alias("parts"), cost.alias("tokens"), (state["used"] + cost).alias("used"))
        added = F.transform(parts, lambda p: F.struct(c["document_id"].alias("document_id"), p["start"].alias("start"), p["end"].alias("end")))
        return F.struct(F.when(fits, state["used"] + cost).otherwise(state["used"]).alias("used"), F.when(fits, F.concat(state["held"], added)).otherwise(state["held"]).alias("held"), F.when(fits, F.concat(state["taken"], F.array(taken))).otherwise(state["taken"]).alias("taken"))

    start = F.struct(F.lit(0).cast("bigint").alias("used"), F.array().cast(HELD).alias("held"), F.array().cast(TAKEN).alias("taken"))
    return lists.select(by, F.inline(F.aggregate("candidates", start, step, lambda s: s["taken"])))
