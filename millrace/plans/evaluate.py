"""Retrieval quality of the chunk variants of a pilot against labelled questions."""

from __future__ import annotations

import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import bm25, chunks, retrieval_metrics
from millrace.operators.hierarchy import LEVELS
from millrace.sources.folder_set import OWN, publish

GOLD = "query string, split string, answerable boolean, evidence array<struct<document_id:string,start:int,end:int,article:string,clause:string,point:string>>"

_LEVELS = ", ".join(f"{level} string" for level in LEVELS)
#: Columns of a pilot's folders; dates are read as they are written.
PILOT = {
    "documents": "document_id string, source_identifier string, source_url string, source_hash string, fetched_at string, source_status_label string, title string, document_number string, document_type string, effective_status string, effective_from string, effective_to string, source_text string",
    "units": f"document_id string, pos int, text string, start int, end int, kind string, label string, {_LEVELS}, citation_verified boolean, warning string",
    "chunks": f"chunk_id string, document_id string, source_identifier string, source_url string, source_hash string, fetched_at string, source_status_label string, document_number string, title string, effective_status string, effective_from string, effective_to string, source_start int, source_end int, content string, embed_text string, heading string, {_LEVELS}, chunk_part int, citation_verified boolean, warnings array<string>",
}


def read_pilot(spark: SparkSession, folder: Path) -> tuple[DataFrame, ...]:
    """documents, units and chunks of a pilot; a line that doesn't fit fails the read, a folder without lines is an empty table."""
    return tuple(spark.read.schema(columns).option("mode", "FAILFAST").json(str(folder / name)) for name, columns in PILOT.items())


def checked_gold(gold: DataFrame, units: DataFrame, documents: DataFrame) -> DataFrame:
    """Evidence rows of all cases; ValueError for cases that break a rule, evidence that can't be found or leaks."""
    cases = gold.withColumn("query_id", F.monotonically_increasing_id()).withColumn("answerable", F.coalesce("answerable", F.lit(True)))
    bad = cases.where("query IS NULL OR query = '' OR split NOT IN ('dev', 'test') OR (answerable AND size(coalesce(evidence, array())) = 0)").first()
    if bad is not None:
        raise ValueError(f"invalid case: {bad['query']}")
    evidence = cases.select("query_id", "query", "split", "answerable", F.posexplode("evidence").alias("evidence_id", "e")).select("query_id", "evidence_id", "query", "split", "answerable", "e.*")
    broken = evidence.where("start < 0 OR end <= start").first()
    known = retrieval_metrics.resolvable(evidence, units, documents)
    broken = broken or evidence.join(known.select("query_id", "evidence_id"), ["query_id", "evidence_id"], "left_anti").first()
    if broken is not None:
        raise ValueError(f"no verified unit holds the evidence at {broken['start']} to {broken['end']} of {broken['document_id']}")
    if retrieval_metrics.leaked_documents(evidence.select("split", "document_id")).first() is not None:
        raise ValueError("a document is evidence in both splits")
    return evidence


def evaluate_variants(spark: SparkSession, folder: Path, gold_path: Path, top_k: int = 20, split: str = "test") -> dict:
    """For each variant its summary and metrics by question; metrics at k exist up to ``top_k``."""
    if top_k < 1:
        raise ValueError("top_k must be positive")
    held: list[DataFrame] = []
    try:
        return _evaluate(spark, folder, gold_path, top_k, split, held)
    finally:
        for df in held:
            df.unpersist()


def _evaluate(spark: SparkSession, folder: Path, gold_path: Path, top_k: int, split: str, held: list[DataFrame]) -> dict:
    def keep(df: DataFrame) -> DataFrame:
        held.append(df.persist())
        return df

    documents, units, verified = map(keep, read_pilot(spark, folder))
    gold = keep(spark.read.schema(GOLD).option("mode", "FAILFAST").json(str(gold_path)).coalesce(1))
    if gold.where((F.col("split") == split) & F.coalesce("answerable", F.lit(True))).first() is None:
        raise ValueError(f"no answerable case is labelled {split}")
    evidence = keep(checked_gold(gold, units, documents))
    asked = evidence.where((F.col("split") == split) & F.col("answerable"))
    questions = asked.select("query_id", "query").distinct()
    size = spark.read.option("multiLine", True).json(str(folder / "pilot_manifest.json")).first()["max_chars"]
    known = keep(chunks.variant_union(chunks.fixed_chunks(documents, size), chunks.article_chunks(units, documents, size), verified))
    began = time.perf_counter()
    best = keep(bm25.top_k(bm25.scores(known, questions, keep=("variant",)), top_k, by=("variant", "query_id")))
    best.count()
    took = (time.perf_counter() - began) * 1000
    ranked = best.join(known.drop("embed_text", "content"), ["variant", "chunk_id"])
    groups = known.select("variant").distinct().crossJoin(questions.select("query_id"))
    rows = keep(retrieval_metrics.per_query(ranked, asked, groups, tuple(k for k in (5, 10, 20) if k <= top_k), ("variant",)))
    report = {}
    totals = {r["variant"]: r["count"] for r in known.groupBy("variant").count().collect()}
    for r in retrieval_metrics.summary(rows).collect():
        report[r["variant"]] = {**r.asDict(), "chunk_count": totals[r["variant"]], "batch_latency_ms": took}
    texts = {r["query_id"]: r["query"] for r in questions.collect()}
    order = F.transform(F.sort_array(F.collect_list(F.struct("rank", "chunk_id"))), lambda x: x["chunk_id"])
    found = {(r["variant"], r["query_id"]): r["ids"] for r in best.groupBy("variant", "query_id").agg(order.alias("ids")).collect()}
    for r in rows.collect():
        own = {**r.asDict(), "query": texts[r["query_id"]], "ranked_chunk_ids": found.get((r["variant"], r["query_id"]), [])}
        report[own.pop("variant")].setdefault("per_query", []).append(own)
    return report


def export_candidates(spark: SparkSession, folder: Path, output: Path, per_document: int = 3) -> int:
    """Units to label, as JSON lines in a new folder; returns how many."""
    documents, units, _ = read_pilot(spark, folder)
    rows = retrieval_metrics.annotation_candidates(units, documents, per_document).persist()
    publish(spark, {OWN: (rows, ["document_id", "start"])}, str(output.resolve()))
    n = rows.count()
    rows.unpersist()
    return n


