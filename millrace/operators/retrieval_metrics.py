"""Scoring of ranked chunks against evidence spans.

``evidence``: (query_id, evidence_id, document_id, start, end, article, clause, point). ``ranked``: (query_id, rank,
document_id, source_start, source_end, citation_verified, article, clause, point), with any columns ``by`` that split
the results (such as variant) in both the results and the output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

KEYS = ("article", "clause", "point")


def _meets(ranked: DataFrame, evidence: DataFrame, by: tuple[str, ...]) -> DataFrame:
    e = evidence.select("query_id", "evidence_id", "document_id", F.col("start").alias("e_start"), F.col("end").alias("e_end"), *[F.col(k).alias(f"e_{k}") for k in KEYS])
    return ranked.join(e, ["query_id", "document_id"])


def prefix_coverage(ranked: DataFrame, evidence: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, query_id, evidence_id, rank, covered, size): characters of the evidence that the chunks up to each rank cover.

    Each chunk that meets the evidence adds what the better ranked ones leave open; chunks that lie within what is
    covered add nothing.
    """
    hit = _meets(ranked, evidence, by).where((F.col("source_start") < F.col("e_end")) & (F.col("source_end") > F.col("e_start")))
    key = [*by, "query_id", "evidence_id"]
    spans = hit.select(*key, "rank", F.greatest("source_start", "e_start").alias("s"), F.least("source_end", "e_end").alias("t"), (F.col("e_end") - F.col("e_start")).alias("size"))
    # at most k spans for each evidence: every prefix is united on its own
    prefix = spans.select(*key, F.col("rank").alias("upto")).distinct().join(spans, key).where("rank <= upto")
    w = W.partitionBy(*key, "upto").orderBy("s", "t").rowsBetween(W.unboundedPreceding, -1)
    prefix = prefix.withColumn("reach", F.coalesce(F.max("t").over(w), F.col("s")))
    return prefix.groupBy(*key, F.col("upto").alias("rank")).agg(F.sum(F.greatest(F.lit(0), F.col("t") - F.greatest("s", "reach"))).cast("long").alias("covered"), F.max("size").alias("size"))


def covering_rank(ranked: DataFrame, evidence: DataFrame, by: tuple[str, ...] = (), share: float = 0.8) -> DataFrame:
    """(by, query_id, evidence_id, first_rank): the first rank at which the share of the evidence is covered."""
    done = prefix_coverage(ranked, evidence, by).where(F.col("covered") >= F.lit(float(share)) * F.col("size"))
    return done.groupBy(*by, "query_id", "evidence_id").agg(F.min("rank").alias("first_rank"))


def exact_citations(ranked: DataFrame, evidence: DataFrame, by: tuple[str, ...] = (), share: float = 0.8) -> DataFrame:
    """(by, query_id, rank) of verified chunks that cover an evidence alone and name the same article, clause and point."""
    rows = _meets(ranked, evidence, by).where("citation_verified")
    overlap = F.greatest(F.lit(0), F.least("source_end", "e_end") - F.greatest("source_start", "e_start"))
    same = F.lit(True)
    for k in KEYS:
        same = same & (F.col(f"e_{k}").isNull() | F.col(k).eqNullSafe(F.col(f"e_{k}")))
    return rows.where((overlap >= F.lit(float(share)) * (F.col("e_end") - F.col("e_start"))) & same).select(*by, "query_id", "rank").distinct()


def relevant_ranks(ranked: DataFrame, evidence: DataFrame, by: tuple[str, ...] = (), share: float = 0.5) -> DataFrame:
    """(by, query_id, rank) of chunks that hold the share of some evidence."""
    rows = _meets(ranked, evidence, by)
    overlap = F.least("source_end", "e_end") - F.greatest("source_start", "e_start")
    return rows.where(overlap >= F.lit(float(share)) * (F.col("e_end") - F.col("e_start"))).select(*by, "query_id", "rank").distinct()


def ndcg(relevant: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """(by, query_id, ndcg): binary gains, against the best order of the relevant chunks that were found."""
    gain = F.sum(F.lit(1.0) / F.log2(F.col("rank") + 1))
    ideal = F.aggregate(F.sequence(F.lit(1), F.count(F.lit(1)).cast("int")), F.lit(0.0), lambda a, r: a + F.lit(1.0) / F.log2(r + 1))
    return relevant.groupBy(*by, "query_id").agg((gain / ideal).alias("ndcg"))


def per_query(ranked: DataFrame, evidence: DataFrame, groups: DataFrame, ks: tuple[int, ...] = (5, 10, 20), by: tuple[str, ...] = ()) -> DataFrame:
    """Metrics of every (by, query_id) in ``groups``; those without results score 0."""
    key = [*by, "query_id"]
    count = evidence.groupBy("query_id").agg(F.count(F.lit(1)).alias("n_evidence"))
    first = covering_rank(ranked, evidence, by).groupBy(*key).agg(F.min("first_rank").alias("best"), *[F.sum((F.col("first_rank") <= k).cast("long")).alias(f"c{k}") for k in ks])
    exact = exact_citations(ranked, evidence, by).groupBy(*key).agg(F.min("rank").alias("exact_rank"))
    gain = ndcg(relevant_ranks(ranked, evidence, by), by)
    rows = groups.join(count, "query_id").join(first, key, "left").join(exact, key, "left").join(gain, key, "left")
    return rows.select(
        *key,
        *[(F.coalesce(F.col(f"c{k}"), F.lit(0)) / F.col("n_evidence")).alias(f"recall_at_{k}") for k in ks],
        *[F.coalesce((F.col("exact_rank") <= k).cast("double"), F.lit(0.0)).alias(f"exact_citation_at_{k}") for k in ks],
        F.coalesce(F.lit(1.0) / F.col("best"), F.lit(0.0)).alias("reciprocal_rank"),
        F.coalesce("ndcg", F.lit(0.0)).alias("ndcg"),
    )


def summary(metrics: DataFrame, by: tuple[str, ...] = ("variant",)) -> DataFrame:
    """Means over queries."""
    own = [c for c in metrics.columns if c not in (*by, "query_id")]
    names = {"reciprocal_rank": "mrr"}
    return metrics.groupBy(*by).agg(F.count(F.lit(1)).alias("case_count"), *[F.avg(c).alias(names.get(c, c)) for c in own])


def resolvable(evidence: DataFrame, units: DataFrame, documents: DataFrame) -> DataFrame:
    """Evidence that names an article, ends within its document and lies in one verified unit with the same keys."""
    e, u = evidence.alias("e"), units.where("citation_verified").alias("u")
    inside = (F.col("e.document_id") == F.col("u.document_id")) & (F.col("u.start") <= F.col("e.start")) & (F.col("e.end") <= F.col("u.end"))
    for k in KEYS:
        inside = inside & (F.col(f"e.{k}").isNull() | (F.col(f"u.{k}") == F.col(f"e.{k}")))
    sized = documents.select(F.col("document_id").alias("own_id"), F.char_length("source_text").alias("n_text"))
    d = (F.col("document_id") == F.col("own_id")) & (F.col("end") <= F.col("n_text"))
    return e.where("e.article IS NOT NULL").join(u, inside, "left_semi").join(sized, d, "left_semi")


def leaked_documents(cases: DataFrame) -> DataFrame:
    """Documents that evidence of both splits points to; ``cases``: (split, document_id)."""
    return cases.where("split = 'dev'").select("document_id").intersect(cases.where("split = 'test'").select("document_id"))


def annotation_candidates(units: DataFrame, documents: DataFrame, per_document: int = 3) -> DataFrame:
    """The first verified points, then clauses, then articles of each document."""
    if per_document < 1:
        raise ValueError("per_document must be positive")
    priority = F.when(F.col("kind") == "point", 0).when(F.col("kind") == "clause", 1).otherwise(2)
    w = W.partitionBy("document_id").orderBy("priority", "start")
    rows = units.where(F.col("citation_verified") & F.col("kind").isin(*KEYS)).withColumn("priority", priority).withColumn("n", F.row_number().over(w)).where(F.col("n") <= per_document)
    extra = documents.select("document_id", "title", "source_url", "source_hash", "source_text")
    return rows.join(extra, "document_id").select("document_id", "title", "source_url", "source_hash", "start", "end", "article", "clause", "point", F.substring(F.col("source_text"), F.col("start") + 1, F.col("end") - F.col("start")).alias("text"))
