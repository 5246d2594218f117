"""Chat formatting with the perspective rotated: one rendering of a dialogue for each of its participants.

In the rendering for a participant, what that speaker says is the assistant's and is trained on; all other speakers
are users under their names; system turns stay system turns. The result has a row for each segment, with its place in
the dialogue's rendering (code points, end exclusive), so that a dialogue of any length is never gathered in one task:
ordering the segments by ``start`` and joining their texts gives the dialogue. Offsets are sums within blocks of turns,
carried on from block to block. Only built-in functions are used.

Defined cases: rows without a conversation id belong to no dialogue and are left out; turns are ordered by number (null
first), then speaker, then text; rows repeated in all four columns are one turn; a null text is empty and a null speaker
is called "unknown"; white space within names becomes "_" and "<|" within names or texts becomes "< |", so neither can
end a segment early; a dialogue of system turns alone has no participant and gives no row; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.shared import quoted

BLOCK_TURNS = 64


def rotate_perspectives(chats: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", speaker_col: str = "role", text_col: str = "text", system: str = "system", block_turns: int = BLOCK_TURNS) -> DataFrame:
    """(conv_id, perspective, segment, turn, role, name, rendered, start, end, mask_start, mask_end); masks null where untrained."""
    turns = (
        chats.where(quoted(conv_col).isNotNull())
        .select(
            quoted(conv_col).alias("conv_id"),
            quoted(turn_col).cast("long").alias("turn"),
            F.coalesce(quoted(speaker_col).cast("string"), F.lit("unknown")).alias("speaker"),
            F.coalesce(quoted(text_col).cast("string"), F.lit("")).alias("content"),
        )
        .distinct()
    )
    speakers = turns.where(F.col("speaker") != system).select("conv_id", F.col("speaker").alias("perspective")).distinct()
    own = F.col("speaker") == F.col("perspective")
    role = F.when(F.col("speaker") == system, system).when(own, "assistant").otherwise("user")
    name = F.when(role == "user", F.replace(F.regexp_replace("speaker", r"[ \t\r\n]", "_"), F.lit("<|"), F.lit("< |")))
    head = F.concat(F.lit("<|im_start|>"), F.col("role"), F.coalesce(F.concat(F.lit(" name="), F.col("name")), F.lit("")), F.lit("\n"))
    segments = (
        turns.join(speakers, "conv_id")
        .withColumn("role", role)
        .withColumn("name", name)
        .withColumn("head", head)
        .withColumn("body", F.concat(F.replace("content", F.lit("<|"), F.lit("< |")), F.lit("<|im_end|>")))
        .withColumn("rendered", F.concat("head", "body", F.lit("\n")))
        .withColumn("size", F.length("rendered").cast("long"))
        .withColumn("block", F.coalesce(F.floor(F.col("turn") / block_turns), F.lit(-(1 << 62)).cast("long")))
    )
    key = ["conv_id", "perspective"]
    before = W.partitionBy(*key).orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    carried = (
        segments.groupBy(*key, "block")
        .agg(F.sum("size").alias("block_size"), F.count(F.lit(1)).alias("block_rows"))
        .select(*key, "block", F.coalesce(F.sum("block_size").over(before), F.lit(0)).alias("size_before"), F.coalesce(F.sum("block_rows").over(before), F.lit(0)).alias("rows_before"))
    )
    inside = W.partitionBy(*key, "block").orderBy(F.col("turn").asc_nulls_first(), "speaker", "content")
    placed = (
        segments.join(carried, [*key, "block"])
        .withColumn("segment", F.col("rows_before") + F.row_number().over(inside))
        .withColumn("end", F.col("size_before") + F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("start", F.col("end") - F.col("size"))
    )
    trained = F.col("role") == "assistant"
    mask_start = F.col("start") + F.length("head")
    return placed.select(
        *key,
        F.col("segment").cast("long").alias("segment"),
        "turn",
        "role",
        "name",
        "rendered",
        "start",
        "end",
        F.when(trained, mask_start).alias("mask_start"),
        F.when(trained, mask_start + F.length("body")).alias("mask_end"),
    )
