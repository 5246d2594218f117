"""Command line: audit, sample, evaluate, candidates, discover, crawl, sync and PDF extraction."""

from __future__ import annotations

import argparse
import hashlib
import json
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from millrace.functions.text import bucket_contains
from millrace.plans import audit, collect, evaluate, pilot
from millrace.sources import raw_dataset as raw
from millrace.sources import remote
from millrace.sources.access import AccessBlocked, OutOfScope, request
from millrace.sources.profile import SourceProfile
from millrace.streaming import ingest

IDENTITY = ("dataset_version", "schema_version", "config_version", "source_identifier", "source_base_url", "seed_sha256")


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="millrace")
    commands = top.add_subparsers(dest="command", required=True)

    def command(name, *flags):
        p = commands.add_parser(name)
        for flag, options in flags:
            p.add_argument(flag, **options)
        return p

    must = {"required": True}
    access = [("--source-mode", {"choices": ("api", "html", "hybrid"), "default": "hybrid"}), ("--request-delay-seconds", {"type": float, "default": 1.5}), ("--confirm-public-source-access", {"action": "store_true"}), ("--transport", {"default": None})]
    version = [("--dataset-version", must), ("--data-root", {"default": "data/raw"})]
    command("discover", ("--listing-url", {}), ("--api-list-url", {}), ("--api-detail-url-template", {}), ("--document-url-template", {}), ("--seed-out", must), ("--limit", {"type": int, "default": 50}), ("--prefix", {"default": "doc"}), *access)
    command("crawl", ("--seed", must), ("--source-base-url", must), ("--resume", {"action": "store_true"}), *version, *access)
    command("sync", ("--api-base-url", must), ("--page-size", {"type": int, "default": 10}), ("--max-pages", {"type": int, "default": 100}), ("--all-pages", {"action": "store_true"}), ("--status-scope", {"choices": ("selected", "all"), "default": "selected"}), ("--max-discovery-passes", {"type": int, "default": 1}), ("--resume", {"action": "store_true"}), ("--prefix", {"default": "doc"}), *version, *access)
    command("extract-pdf", ("--pdf-reader", must), *version)
    command("audit-corpus", ("--dataset-root", must), ("--report-out", must))
    command("build-pilot", ("--dataset-root", must), ("--output", must), ("--limit", {"type": int, "default": 200}), ("--seed", {"default": "pilot-v1"}), ("--max-chars", {"type": int, "default": 1800}))
    command("evaluate-chunking", ("--pilot-dir", must), ("--gold-file", must), ("--split", {"choices": ("dev", "test"), "default": "test"}), ("--top-k", {"type": int, "default": 20}), ("--report-out", must))
    command("prepare-gold-candidates", ("--pilot-dir", must), ("--output", must), ("--per-document", {"type": int, "default": 3}))
    return top


def prepare(root: Path, identity: dict, resume: bool) -> dict:
    """The manifest to go on with; a folder that holds something else fails closed."""
    if (root / "manifest.json").is_file():
        known = raw.read_manifest(root)
        differs = [k for k in IDENTITY if known.get(k) != identity.get(k)]
        if not resume:
            raise FileExistsError(f"{root}: there is a manifest; use --resume")
        if differs:
            raise ValueError(f"the dataset isn't the same: {', '.join(differs)}")
        return known
    if root.exists() and any(root.iterdir()):
        raise ValueError(f"{root}: files without a manifest")
    return {**identity, "record_log_path": "records.jsonl", "record_count": 0, "checkpoint": {"stable_total_passes": 0}, "discovery_artifacts": [], "retrieval_errors": [], "status_counts": {}, "skipped_status_counts": {}, "pending_seeds": [], "discovery_complete": False, "discovery_incomplete": False}


def discover(spark: SparkSession, a) -> int:
    SourceProfile(a.prefix, a.source_mode, a.listing_url, a.api_list_url, a.api_detail_url_template, a.document_url_template, a.request_delay_seconds)
    rows, send, policy = [], remote.transport(a.transport), {"pause": a.request_delay_seconds}
    try:
        if a.source_mode != "html":
            data = request(send, "POST", a.api_list_url, json_body=remote.listing_body(1, a.limit, "id"), **policy).json().get("data", {})
            if not isinstance(data.get("items", []), list):
                raise ValueError("the listing has no data.items")
            found = remote.listing_seeds(data.get("items", [])[: a.limit], a.api_detail_url_template, a.prefix)
            own = len(a.prefix) + 1
            rows = [{**r, "canonical_url": a.document_url_template.replace("{doc_id}", r["source_id"][own:]), "selection_reason": "api_listing"} for r in found]
    except (AccessBlocked, OutOfScope):
        raise
    except Exception:
        if a.source_mode == "api" or not a.listing_url:
            raise
    if not rows and a.listing_url and a.source_mode != "api":
        found = remote.listing_links(send, a.listing_url, a.prefix, **policy)[: a.limit]
        rows = [{**r, "api_detail_url": None, "source_status_label": None, "selection_reason": "listing_link"} for r in found]
    seeds = spark.createDataFrame(rows, "source_id string, canonical_url string, api_detail_url string, source_status_label string, selection_reason string")
    seeds = seeds.withColumn("selection_bucket", bucket_contains("source_status_label"))
    raw.replace_text(Path(a.seed_out), "".join(json.dumps(r.asDict(), ensure_ascii=False) + "\n" for r in seeds.collect()))
    print(json.dumps({"seeds": len(rows)}))
    return 0


def _collect(spark: SparkSession, a, root: Path, manifest: dict, mode: str, work) -> int:
    """Run ``work`` on the collection; a refusal ends it with 2, and what was fetched before stays."""
    own = collect.Collection(spark, root, manifest, collect.Access(mode, a.transport, a.request_delay_seconds), lambda row: print(json.dumps(row), file=sys.stderr))
    try:
        work(own)
        code = 0
    except collect.Stopped:
        code = 2
    print(json.dumps(own.state.counts()))
    own.state.close()
    return code


def crawl(spark: SparkSession, a) -> int:
    seed, root = Path(a.seed), Path(a.data_root) / a.dataset_version
    identity = {"dataset_version": a.dataset_version, "schema_version": "1", "config_version": "1", "source_identifier": "seeds", "source_base_url": a.source_base_url, "seed_sha256": hashlib.sha256(seed.read_bytes()).hexdigest()}
    manifest = prepare(root, identity, a.resume)
    seeds = spark.read.schema(collect.SEED).option("mode", "FAILFAST").json(str(seed))
    done = ingest.completed_ids(spark, str(root / "records.jsonl"), raw.RECORD)
    todo = seeds.withColumn("place", F.monotonically_increasing_id()).join(done, "source_id", "left_anti").orderBy("place")
    return _collect(spark, a, root, manifest, a.source_mode, lambda own: own.fetch(r.asDict() for r in todo.toLocalIterator()))


def sync(spark: SparkSession, a) -> int:
    root, base = Path(a.data_root) / a.dataset_version, a.api_base_url.rstrip("/")
    if a.page_size < 1 or a.max_pages < 1 or a.max_discovery_passes < 1:
        raise ValueError("page size, pages and passes must be positive")
    schema = "3" if a.status_scope == "all" else "2"
    settings = json.dumps({"page_size": a.page_size, "status_scope": a.status_scope}, sort_keys=True)
    identity = {"dataset_version": a.dataset_version, "schema_version": schema, "config_version": schema, "source_identifier": a.prefix, "source_base_url": base, "seed_sha256": hashlib.sha256(settings.encode()).hexdigest()}
    manifest = prepare(root, identity, a.resume)
    most = None if a.all_pages else a.max_pages
    return _collect(spark, a, root, manifest, "detail", lambda own: collect.collect_listing(own, collect.Listing(base, a.prefix, a.page_size, most), a.max_discovery_passes, a.status_scope))


def extract(spark: SparkSession, a) -> int:
    print(json.dumps(collect.extract_pdfs(spark, Path(a.data_root) / a.dataset_version, a.pdf_reader)))
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    a = parser().parse_args(argv)
    if hasattr(a, "confirm_public_source_access") and not a.confirm_public_source_access:
        print("--confirm-public-source-access is needed", file=sys.stderr)
        return 2
    spark = spark or SparkSession.builder.appName("millrace").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if a.command == "audit-corpus":
        report, issues = audit.audit_tables(spark, Path(a.dataset_root))
        audit.write_report(Path(a.report_out), report, issues)
        print(json.dumps(report["counts"], ensure_ascii=False))
    elif a.command == "build-pilot":
        print(json.dumps(pilot.build_pilot(spark, Path(a.dataset_root), Path(a.output), a.limit, a.seed, a.max_chars), ensure_ascii=False))
    elif a.command == "evaluate-chunking":
        report = evaluate.evaluate_variants(spark, Path(a.pilot_dir), Path(a.gold_file), a.top_k, a.split)
        raw.write_json_once(Path(a.report_out), report)
        print(json.dumps({k: {n: v for n, v in r.items() if n != "per_query"} for k, r in report.items()}))
    elif a.command == "prepare-gold-candidates":
        print(json.dumps({"candidates": evaluate.export_candidates(spark, Path(a.pilot_dir), Path(a.output), a.per_document)}))
    else:
        return {"discover": discover, "crawl": crawl, "sync": sync, "extract-pdf": extract}[a.command](spark, a)
    return 0


if __name__ == "__main__":
    sys.exit(main())
