"""Audit of a raw dataset folder: all rules, counters and reconciliations in one report. The dataset isn't changed.

Findings are a table in the shared folder. Its rows, orphans and usable documents are counted in the pass that writes it, so only
counts come to the driver.
"""

from __future__ import annotations

import json
import sqlite3
from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from millrace.operators import quality_audit as qa
from millrace.sources import raw_dataset as raw
from millrace.sources.session import shared_folder

ORPHAN, USABLE = "#orphan", "#usable"  # marks of rows that are counted with the findings


def audit_dataset(spark: SparkSession, root: Path) -> dict:
    """The whole report with its issues as a list; for datasets whose findings fit the driver."""
    report, issues = audit_tables(spark, root)
    return report | {"issues": [r.asDict() for r in issues.collect()]}


def write_report(path: Path, report: dict, issues: DataFrame) -> None:
    """A new file with the report and its issues, which pass through the driver partition by partition."""
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("x", encoding="utf-8") as out:
        out.write(json.dumps(report, ensure_ascii=False, indent=2).removesuffix("\n}") + ',\n  "issues": [')
        for n, r in enumerate(issues.toLocalIterator()):
            out.write(f"{',' if n else ''}\n    {json.dumps(r.asDict(), ensure_ascii=False)}")
        out.write("\n  ]\n}\n")


def audit_tables(spark: SparkSession, root: Path) -> tuple[dict, DataFrame]:
    """(the report without its issues, issues (source_id, code) in order)."""
    manifest = raw.read_manifest(root)
    log = raw.record_log_path(root, manifest)
    folder = root / "artifacts"
    if not folder.is_dir():
        raise FileNotFoundError(folder)
    parsed = raw.parse_log(raw.numbered_lines(spark, str(log)))
    records = parsed.where("problem IS NULL").persist()
    files = raw.read_files(spark, str(root)) if any(folder.iterdir()) else spark.createDataFrame([], raw.FILES)
    files = files.persist()
    discovery = spark.createDataFrame([(str(a.get("source_id") or "discovery"), i, {k: a.get(k) for k in ("kind", "source_id", "source_url", "fetched_at", "sha256", "relative_path", "http_status")}) for i, a in enumerate(manifest.get("discovery_artifacts") or [])], "source_id string, pos int, a struct<kind:string,source_id:string,source_url:string,fetched_at:string,sha256:string,relative_path:string,http_status:int>")
    kept = F.col("a.kind").isin("document_json", "document_html")
    checked = qa.checked_references(qa.references(records).where(kept), files)
    checked_discovery = qa.checked_references(discovery, files)
    state = qa.document_state(records, checked).persist()
    found = qa.line_issues(parsed).unionByName(qa.repeated_records(records))
    for part in (qa.reference_issues(checked), qa.reference_issues(checked_discovery), qa.document_issues(state)):
        found = found.unionByName(part)
    named = checked.select(F.col("path").alias("relative_path")).unionByName(checked_discovery.select(F.col("path").alias("relative_path")))
    for mark, rows in ((ORPHAN, qa.orphans(files.select("relative_path"), named)), (USABLE, qa.usable(state))):
        found = found.unionByName(rows.select(F.lit(None).cast("string").alias("source_id"), F.lit(mark).alias("code")))
    told, path = Observation(), shared_folder(spark, "findings")
    counted = found.observe(told, *[F.count_if(F.col("code") == c).alias(c) for c in (ORPHAN, USABLE, *qa.CODES)])
    counted.where(~F.col("code").isin(ORPHAN, USABLE)).write.parquet(path)
    by_code = told.get
    statuses = {r["status"]: r["n"] for r in qa.count_by_status(records.select("r.source_status_label")).collect()}
    n_records, listed = sum(statuses.values()), []
    checkpoint = manifest.get("checkpoint") or {}
    if n_records != manifest.get("record_count"):
        listed.append(("manifest", "record_count_mismatch"))
    if checkpoint.get("completed_count") != n_records:
        listed.append(("manifest", "completed_count_mismatch"))
    observed, seen = checkpoint.get("observed_total"), checkpoint.get("seen_count")
    counts = {"records": n_records, "observed_total": observed or 0, "seen_count": seen or 0, "pending_count": checkpoint.get("pending_count") or 0}
    counts["unseen_vs_observed"] = max(0, observed - seen) if isinstance(observed, int) and isinstance(seen, int) else 0
    state_counts, state_path = None, root / "sync-state.sqlite3"
    if state_path.is_file():
        try:
            state_counts = raw.state_counts(state_path)
            listed += qa.mismatches(state_counts, checkpoint, "sync-state", "state_{}_mismatch")
        except sqlite3.DatabaseError:
            listed.append(("sync-state", "state_unreadable"))
    counts["orphan_artifacts"], counts["usable_documents"] = by_code.pop(ORPHAN), by_code.pop(USABLE)
    counts |= dict.fromkeys(("empty_html", "missing_html", "hash_mismatch"), 0) | {c: n for c, n in by_code.items() if n}
    for _, code in listed:
        counts[code] = counts.get(code, 0) + 1
    for df in (records, files, state):
        df.unpersist()
    issues = spark.read.schema("source_id string, code string").parquet(path)
    if listed:
        issues = issues.unionByName(spark.createDataFrame(listed, "source_id string, code string"))
    keys = ("dataset_version", "schema_version", "config_version")
    report = {
        **{k: manifest.get(k) for k in keys},
        "discovery_complete": manifest.get("discovery_complete", False),
        "discovery_incomplete": manifest.get("discovery_incomplete", False),
        "counts": counts,
        "statuses": statuses,
        "state_counts": state_counts,
    }
    return report, issues.orderBy("source_id", "code")
