"""Collecting records from remote sources, batch by batch: fetch, store, append, checkpoint.

Each batch of seeds is one job. When it ends, its artifacts are stored, its records stand in the log, and manifest and state
file say so; a run that is stopped or refused loses nothing that was fetched before.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime, timezone
from itertools import batched
from math import ceil
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.text import bucket_exact, is_selected, or_unknown
from millrace.sources import raw_dataset as raw
from millrace.sources import remote
from millrace.sources.content_store import store_payloads
from millrace.sources.session import shared_folder
from millrace.sources.state_file import StateFile
from millrace.streaming import sync_state
from millrace.streaming.ingest import discovery_complete

SEED = "source_id string, canonical_url string, api_detail_url string, source_status_label string, selection_bucket string"


class Stopped(RuntimeError):
    """The source refuses access or leads elsewhere; all that came before is kept."""


@dataclass
class Access:
    """How a source is asked: which parts, through what transport, with what pause between two requests to it."""

    mode: str = "hybrid"
    transport: str | None = None
    pause: float = 1.5
    lanes: int = 1  # tasks that ask at the same time; the source sees the same rate


class Collection:
    def __init__(self, spark: SparkSession, root: Path, manifest: dict, access: Access, report: Callable[[dict], None] | None = None):
        self.spark, self.root, self.manifest, self.access, self.report = spark, root, manifest, access, report
        self.state = StateFile(root / "sync-state.sqlite3", raw.logged_ids(root / "records.jsonl"))
        self.checkpoint()

    def checkpoint(self, **progress) -> None:
        counts = self.state.counts()
        self.manifest["record_count"] = counts["completed_count"]
        self.manifest["checkpoint"] |= counts
        raw.replace_json(self.root / "manifest.json", self.manifest)
        if self.report and progress:
            self.report({**progress, **counts, "discovery_complete": self.manifest["discovery_complete"], "discovery_incomplete": self.manifest["discovery_incomplete"]})

    def stop(self, reason: str) -> None:
        self.manifest["checkpoint"]["stopped_reason"] = reason
        self.manifest["retrieval_errors"].append(reason)
        self.checkpoint()
        raise Stopped(reason)

    def fetch(self, seeds: Iterable[dict], size: int = 50, again: bool = False) -> None:
        """Bring in the seeds that aren't completed; those that fail stay pending."""
        names = [c.split()[0] for c in SEED.split(", ")]
        for batch in batched(seeds, size):
            todo = {s["source_id"]: s for s in batch if not self.state.status(s["source_id"])[1]}
            if not todo:
                continue
            rows = self.spark.createDataFrame([tuple(s.get(n) for n in names) for s in todo.values()], SEED)
            fetched = remote.fetch_documents(rows, self.access.mode, self.access.transport, lanes=self.access.lanes, pause=self.access.pause).persist()
            done, failed, refused = self._append(fetched, todo)
            fetched.unpersist()
            self.state.note(seen=failed, completed=done, pending=failed)
            waiting = {s["source_id"]: s for s in self.manifest["pending_seeds"]}
            for name in done:
                waiting.pop(name, None)
            waiting |= {name: {n: todo[name].get(n) for n in names} for name in failed}
            self.manifest["pending_seeds"] = list(waiting.values())
            self.manifest["retrieval_errors"] += [f"{name}:{'retry:' * again}{why}" for name, why in failed.items()]
            self.manifest["checkpoint"].setdefault("failed_source_ids", []).extend(failed)
            if refused:
                self.stop(refused)
            self.checkpoint()

    def retry_pending(self) -> None:
        """What an earlier run left open comes first, in the order of its ids."""
        waiting = {s["source_id"]: s for s in self.manifest["pending_seeds"]}
        self.fetch([waiting[i] for i in self.state.pending() if i in waiting], again=True)

    def _append(self, fetched, seeds: dict[str, dict]) -> tuple[list[str], dict[str, str], str | None]:
        """Store the payloads of one batch and append its records; only their descriptions come to the driver."""
        known = {(r["sha256"], r["relative_path"]): r["deduplicated"] for r in store_payloads(fetched, str(self.root)).collect()}
        described = fetched.withColumn("sha256", F.sha2("payload", 256)).drop("payload").collect()
        failed = {r["source_id"]: r["error"] for r in described if r["error"] and not r["refused"]}
        refused = next((r["error"] for r in described if r["refused"]), None)
        open_ = {r["source_id"] for r in described if r["error"]}
        records: dict[str, dict] = {}
        for r in described:
            if r["source_id"] in open_:
                continue
            path = f"artifacts/{r['sha256']}{r['suffix']}"
            seed = seeds[r["source_id"]]
            record = records.setdefault(r["source_id"], {"source_id": r["source_id"], "canonical_url": r["canonical_url"], "source_status_label": seed.get("source_status_label"), "selection_bucket": seed.get("selection_bucket"), "deduplicates_artifact_id": None, "errors": [], "artifacts": [], "pdf_extractions": []})
            record["artifacts"].append(raw.artifact(r["sha256"], path, **{k: r[k] for k in ("kind", "source_id", "source_url", "fetched_at", "media_type", "http_status")}, source_artifact_id=r["parent"]))
            if r["kind"] == "original_pdf" and known.get((r["sha256"], path)):
                record["deduplicates_artifact_id"] = f"sha256:{r['sha256']}"
        raw.append_lines(self.root / "records.jsonl", records.values())
        return list(records), failed, refused


@dataclass
class Listing:
    """A paged listing: where it is, how large its pages are, how many of them are read at most."""

    base: str
    prefix: str
    size: int
    most: int | None

    def read(self, own: Collection) -> DataFrame:
        """The replies of one pass, asked for once and kept in the shared folder."""
        remote.register(own.spark)
        a, path = own.access, shared_folder(own.spark, "listing")
        options = {"listUrl": f"{self.base}/public/doc/all", "detailUrl": f"{self.base}/public/doc/{{doc_id}}", "prefix": self.prefix, "pageSize": self.size, "maxPages": self.most or "", "lanes": a.lanes, "pause": a.pause, "transport": a.transport or ""}
        own.spark.read.format("listing_replies").options(**options).load().write.parquet(path)
        return own.spark.read.schema(remote.REPLIES).parquet(path)


def judged(pages: DataFrame, known: DataFrame, scope: str) -> DataFrame:
    """The items of a pass with what is known of their sources: (source_id, ..., place, label, fresh, wanted, skipped).

    ``fresh``: met for the first time; ``wanted``: to be fetched, once a source; ``skipped``: of a status that isn't asked for.
    """
    items = pages.select("page", F.posexplode("seeds").alias("at", "seed")).select(F.struct("page", "at").alias("place"), "seed.*")
    rows = items.join(known, "source_id", "left")
    first = F.row_number().over(W.partitionBy("source_id").orderBy("place")) == 1
    good = F.lit(True) if scope == "all" else F.coalesce(is_selected("source_status_label"), F.lit(False))
    open_ = ~F.coalesce("completed", F.lit(False))
    marks = {"label": or_unknown("source_status_label"), "fresh": first & F.col("completed").isNull(), "wanted": first & open_ & good, "skipped": open_ & ~good}
    return rows.withColumns(marks | {"selection_bucket": bucket_exact("source_status_label")})


def take_in(own: Collection, pages: DataFrame, number: int, scope: str) -> None:
    """Keep the replies of a pass as artifacts, count its statuses and fetch what is wanted of it."""
    m, good = own.manifest, pages.where("error IS NULL")
    store_payloads(good, str(own.root)).count()
    described = good.withColumn("sha256", F.sha2("payload", 256)).drop("payload", "seeds").orderBy("page")
    for r in described.toLocalIterator():
        own_id = f"{m['source_identifier']}:list:pass:{number}:page:{r['page']}"
        m["discovery_artifacts"].append(raw.artifact(r["sha256"], f"artifacts/{r['sha256']}{r['suffix']}", kind="discovery_json", source_id=own_id, **{k: r[k] for k in ("source_url", "fetched_at", "media_type", "http_status")}))
    known = own.spark.createDataFrame(own.state.rows(), "source_id string, completed boolean")
    items = judged(good, known, scope).persist()
    for name, mark in (("status_counts", "fresh"), ("skipped_status_counts", "skipped")):
        for r in items.where(mark).groupBy("label").count().collect():  # a row for each status
            m[name][r["label"]] = m[name].get(r["label"], 0) + r["count"]
    own.state.note(seen=(r[0] for r in items.where("fresh").select("source_id").toLocalIterator()))
    seeds = items.where("wanted").orderBy("place").select(*[c.split()[0] for c in SEED.split(", ")])
    own.fetch(r.asDict() for r in seeds.toLocalIterator())
    items.unpersist()


def collect_listing(own: Collection, listing: Listing, passes: int, scope: str) -> None:
    """What an earlier run left open, then passes over a listing until all of it was seen while its total held.

    A pass is one read of the listing, whose items are judged together; records and state are kept up batch by batch, so a
    run that breaks off lists again and fetches only what is missing.
    """
    m, c = own.manifest, own.manifest["checkpoint"]
    own.retry_pending()
    for number in range(1, passes + 1):
        pages = listing.read(own)
        told = pages.where("error IS NULL").agg(F.max("page").alias("page"), F.max_by(F.struct("total", F.size("seeds").alias("n")), "page").alias("end")).first()
        drift = sync_state.total_drift(pages.where("error IS NULL").withColumn("pass", F.lit(number)), ["pass"], "page").collect() if told["page"] else []
        m["retrieval_errors"] += [f"pass {r['pass']}: the total is {r['total']} on page {r['page']}, {r['before']} on the page before" for r in drift]
        if told["page"]:
            total, n = told["end"]
            if c.get("observed_total") not in (None, total):
                m["retrieval_errors"].append(f"pass {number}: the total is {total}, {c['observed_total']} before")
            c["observed_total"], c["last_completed_page"] = total, told["page"]
            take_in(own, pages, number, scope)
        refused = pages.where("error IS NOT NULL").orderBy("page").select("error").first()
        if refused:
            own.stop(refused["error"])
        if n and told["page"] * listing.size < total:  # the page limit came first
            own.checkpoint()
            return
        c["stable_total_passes"] = 0 if drift else c.get("stable_total_passes", 0) + 1
        m["discovery_complete"] = not drift and discovery_complete(own.state.counts()["seen_count"], total, c["stable_total_passes"], passes)
        m["discovery_incomplete"] = not m["discovery_complete"] and number == passes
        own.checkpoint(discovery_pass=number, passes=passes, page=told["page"], pages=ceil(total / listing.size))
        if m["discovery_complete"]:
            return


def extract_pdfs(spark: SparkSession, root: Path, reader: str, version: str = "1") -> dict[str, int]:
    """Read the PDFs of records that have no extraction yet; text or quarantine is written into their records."""
    log = root / "records.jsonl"
    records = raw.read_records(spark, str(log))
    pdfs = records.select(F.explode("artifacts").alias("a")).where("a.kind = 'original_pdf'").select("a.*").dropDuplicates(["artifact_id"])
    finished = records.select(F.explode("pdf_extractions").alias("e")).select(F.col("e.source_artifact_id").alias("artifact_id"))
    todo = pdfs.join(finished, "artifact_id", "left_anti")
    names = F.element_at(F.split("path", "/"), -1)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.pdf").load(str(root / "artifacts")).withColumn("relative_path", F.concat(F.lit("artifacts/"), names))
    made = remote.extract_pdfs(files.join(todo.select("relative_path").distinct(), "relative_path", "left_semi"), reader)
    made = made.withColumn("relative_path", F.concat(F.lit("artifacts/"), names)).drop("path").join(todo, "relative_path")
    head = F.concat(F.lit('{"source_artifact_id":'), F.to_json(F.struct("artifact_id")).substr(F.lit(16), F.length("artifact_id") + 2), F.lit(","))
    made = made.withColumn("payload", F.when(F.col("status") == "extracted", F.encode(F.concat(head, F.substring("text", 2, 1 << 30)), "UTF-8"))).withColumn("suffix", F.lit(".pdf-text.json")).persist()
    store_payloads(made, str(root)).count()
    told: dict[str, tuple[dict, dict | None]] = {}
    now = datetime.now(timezone.utc).isoformat()
    for r in made.withColumn("digest", F.sha2("payload", 256)).drop("payload", "text").toLocalIterator():
        text = None
        if r["digest"]:
            text = raw.artifact(r["digest"], f"artifacts/{r['digest']}.pdf-text.json", kind="pdf_text", source_id=r["source_id"], source_url=r["source_url"], fetched_at=now, media_type="application/json", http_status=r["http_status"], source_artifact_id=r["artifact_id"])
        told[r["artifact_id"]] = {"source_artifact_id": r["artifact_id"], "status": r["status"], "extractor_version": version, "page_count": r["page_count"], "warning": r["warning"], "text_artifact": text}, text

    def with_extractions(record: dict) -> dict:
        has = {e["source_artifact_id"] for e in record.get("pdf_extractions") or []}
        for a in [a["artifact_id"] for a in record.get("artifacts") or []]:
            if a in told and a not in has:
                record.setdefault("pdf_extractions", []).append(told[a][0])
                record["artifacts"] += [told[a][1]] if told[a][1] else []
        return record

    raw.rewrite_lines(log, with_extractions)
    counts = {r["status"]: r["count"] for r in made.groupBy("status").count().collect()}
    made.unpersist()
    return counts
