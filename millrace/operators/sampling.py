"""Deterministic stratified sampling: eligibility, hash order within strata, round robin across them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.text import col, sha256_hex


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds, else null; a rule that is null holds not."""
    out = F.lit(None).cast("string")
    for name, broken in reversed(rules):
        out = F.when(broken, name).otherwise(out)
    return out


def hash_rank(seed: str, id_col: str = "source_id") -> Column:
    return sha256_hex(F.lit(seed), id_col)


def rank_in_stratum(rows: DataFrame, strata: list[str], seed: str, id_col: str = "source_id") -> DataFrame:
    w = W.partitionBy(*strata).orderBy("hash_rank", id_col)
    return rows.withColumn("hash_rank", hash_rank(seed, id_col)).withColumn("turn", F.row_number().over(w).cast("long"))


def round_robin(rows: DataFrame, strata: list[str], limit: int, seed: str, id_col: str = "source_id") -> DataFrame:
    """``limit`` rows: one of each stratum in the order of the strata, then a second one, and so on.

    In that order a stratum's row n comes before any row n + 1, so no stratum needs more than its first ``limit``
    rows and the sorted limit runs without a full sort.
    """
    if limit < 1:
        raise ValueError("limit must be positive")
    ranked = rank_in_stratum(rows, strata, seed, id_col).where(F.col("turn") <= limit)
    return ranked.orderBy("turn", *strata).limit(limit)


def stratum_counts(rows: DataFrame, selected: DataFrame, strata: list[str], id_col: str = "source_id") -> DataFrame:
    """How many of each stratum were selected, those without any included."""
    all_strata = rows.select(*strata).distinct()
    chosen = selected.groupBy(*strata).agg(F.count(F.col(id_col)).alias("n_selected"))
    same = [all_strata[s].eqNullSafe(chosen[s]) for s in strata]
    return all_strata.join(chosen, same, "left").select(*[all_strata[s] for s in strata], F.coalesce("n_selected", F.lit(0)).cast("long").alias("n_selected"))


def repeated_ids(rows: DataFrame, id_col: str = "source_id") -> DataFrame:
    return rows.groupBy(col(id_col)).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def top_per_group(rows: DataFrame, group: list[str], order: list, n: int) -> DataFrame:
    return rows.withColumn("place", F.row_number().over(W.partitionBy(*group).orderBy(*order)).cast("long")).where(F.col("place") <= n)


def first_occurrence(rows: DataFrame, key: list[str], order: list) -> DataFrame:
    """Of rows with the same key the first; nulls in the key are equal."""
    return top_per_group(rows, key, order, 1).drop("place")
