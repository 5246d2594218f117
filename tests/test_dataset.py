import hashlib
import json
import sqlite3
from pathlib import Path

import pytest

from millrace import cli
from millrace.functions.html import links, source_lines, visible_length
from millrace.operators import quality_audit
from millrace.plans import audit, evaluate, pilot
from millrace.sources import access, raw_dataset, remote
from millrace.sources.access import AccessBlocked, OutOfScope, Reply, request
from millrace.streaming import ingest, sync_state

HTML = "<p>Điều 1. Phạm vi</p><p>1. Khoản một</p><p>a) Điểm a</p><p>b) Điểm b</p>"


def dataset(root: Path, pages: list[dict]) -> Path:
    """A raw folder with a record for each page; a page may override its html, data, artifacts or record."""
    (root / "artifacts").mkdir(parents=True)
    lines = []
    for i, page in enumerate(pages):
        name, html = f"doc:{i}", page.get("html", HTML)
        data = {"id": i + 1, "title": f"T{i}", "docNum": f"N{i}", "docType": {"name": "Luật"}, "effStatus": {"name": "Còn hiệu lực"}, "effFrom": "2024-01-02", "documentContent": {"content": html}, **page.get("data", {})}
        artifacts = []
        for kind, suffix, payload in (("document_json", ".json", json.dumps({"data": data}).encode()), ("document_html", ".html", html.encode())):
            digest = hashlib.sha256(payload).hexdigest()
            (root / "artifacts" / f"{digest}{suffix}").write_bytes(payload)
            artifacts.append({"kind": kind, "source_id": name, "source_url": f"https://h/{i}", "fetched_at": "2024-01-01T00:00:00Z", "sha256": digest, "relative_path": f"artifacts/{digest}{suffix}", "http_status": 200, **page.get(kind, {})})
        lines.append(json.dumps({"source_id": name, "canonical_url": f"https://h/{i}", "source_status_label": "Còn hiệu lực", "artifacts": artifacts[: page.get("keep", 2)], **page.get("record", {})}))
    (root / "records.jsonl").write_text("\n".join(lines) + "\n", encoding="utf-8")
    manifest = {"dataset_version": "v", "source_identifier": "doc", "record_log_path": "records.jsonl", "record_count": len(pages), "checkpoint": {"completed_count": len(pages), "seen_count": 2, "observed_total": 5, "pending_count": 0}}
    (root / "manifest.json").write_text(json.dumps(manifest), encoding="utf-8")
    return root


def test_audit_findings(spark, tmp_path):
    root = dataset(tmp_path / "raw", [{}, {"html": "<script>x</script>"}, {"document_html": {"sha256": "0" * 64}}, {"data": {"effTo": "2023-01-01", "title": "", "issueDate": "x"}}, {"keep": 1}, {"document_html": {"source_id": "doc:0", "fetched_at": None, "http_status": 404}}, {"document_html": {"relative_path": "../x"}}, {"data": {"documentContent": {"content": "other"}}}, {"document_html": {"source_url": "https://h/z"}, "record": {"errors": ["e"]}}])
    log = root / "records.jsonl"
    log.write_text(log.read_text(encoding="utf-8") + "\nnot json\n" + json.dumps({"source_id": 5}) + "\n" + log.read_text(encoding="utf-8").splitlines()[0] + "\n", encoding="utf-8")
    (root / "artifacts" / "extra.pdf").write_bytes(b"x")
    with sqlite3.connect(root / "sync-state.sqlite3") as db:
        db.executescript("CREATE TABLE documents(source_id TEXT PRIMARY KEY, seen INT, completed INT); CREATE TABLE pending(source_id TEXT PRIMARY KEY); INSERT INTO documents VALUES ('a', 1, 0), ('b', 1, 1);")
    report = audit.audit_dataset(spark, root)
    got = {(i["source_id"], i["code"]) for i in report["issues"]}
    want = {("line:11", "invalid_record_json"), ("line:12", "missing_source_id"), ("doc:0", "duplicate_record_id"), ("doc:1", "empty_html"), ("doc:2", "hash_mismatch"), ("doc:3", "reversed_effective_dates"), ("doc:3", "missing_title"), ("doc:3", "invalid_issueDate"), ("doc:4", "missing_html")}
    want |= {("doc:5", c) for c in ("artifact_source_id_mismatch", "missing_provenance", "non_200_artifact")} | {("doc:6", "unsafe_path"), ("doc:7", "json_html_mismatch"), ("doc:8", "artifact_source_url_mismatch"), ("doc:8", "missing_document_data"), ("doc:8", "record_error")}
    want |= {("manifest", "record_count_mismatch"), ("manifest", "completed_count_mismatch"), ("sync-state", "state_completed_mismatch")}
    assert got == want
    counts = report["counts"]
    assert (counts["records"], counts["usable_documents"], counts["unseen_vs_observed"], counts["missing_html"]) == (10, 4, 3, 1)
    assert report["state_counts"] == {"seen_count": 2, "completed_count": 1, "pending_count": 0} and report["statuses"] == {"Còn hiệu lực": 10}
    assert counts["orphan_artifacts"] == 1
    assert all(counts.get(c, 0) == sum(i["code"] == c for i in report["issues"]) for c in quality_audit.CODES)
    table, issues = audit.audit_tables(spark, root)
    audit.write_report(tmp_path / "report.json", table, issues)
    assert json.loads((tmp_path / "report.json").read_text(encoding="utf-8")) == report
    with pytest.raises(FileExistsError):
        audit.write_report(tmp_path / "report.json", table, issues)


def test_pilot_evaluation_and_candidates(spark, tmp_path):
    root = dataset(tmp_path / "raw", [{}, {"html": HTML + "<p>Điều 2. Khác</p>"}, {"keep": 1}, {"document_json": {"fetched_at": ""}}, {"html": "<p></p>"}])
    made = pilot.build_pilot(spark, root, tmp_path / "pilot", limit=5, max_chars=50)
    assert made["rejected_candidates"] == {"doc:2": "missing_json_or_html", "doc:3": "missing_provenance", "doc:4": "empty_or_mismatched_content"}
    assert sorted(made["document_ids"]) == ["doc:0", "doc:1"] and made["chunk_count"] == 9 and made["stratum_counts"] == {"Còn hiệu lực|Luật|short": 2}
    with pytest.raises(FileExistsError):
        pilot.build_pilot(spark, root, tmp_path / "pilot")
    pilot.build_pilot(spark, root, tmp_path / "again", limit=5, max_chars=50)
    one, two = (next((tmp_path / p / "chunks").glob("*.json")).read_bytes() for p in ("pilot", "again"))
    assert one == two
    gold = tmp_path / "gold.jsonl"
    text = "\n".join(source_lines(HTML))
    start = text.index("a) Điểm a")
    case = {"query": "điểm a", "split": "test", "evidence": [{"document_id": "doc:0", "start": start, "end": start + 9, "article": "1", "clause": "1", "point": "a"}]}
    gold.write_text(json.dumps(case) + "\n", encoding="utf-8")
    report = evaluate.evaluate_variants(spark, tmp_path / "pilot", gold, top_k=10)
    assert set(report) == {"fixed", "article", "hierarchy"} and report["hierarchy"]["exact_citation_at_5"] == 1.0 and report["fixed"]["exact_citation_at_5"] == 0.0
    assert "recall_at_20" not in report["fixed"]
    gold.write_text(json.dumps({**case, "evidence": [{**case["evidence"][0], "end": 999}]}) + "\n", encoding="utf-8")
    with pytest.raises(ValueError, match="no verified unit"):
        evaluate.evaluate_variants(spark, tmp_path / "pilot", gold)
    assert evaluate.export_candidates(spark, tmp_path / "pilot", tmp_path / "cand", 2) == 4


def test_pilot_without_verified_chunks(spark, tmp_path):
    root = dataset(tmp_path / "raw", [{"html": "<p>Lời nói đầu</p>"}])
    made = pilot.build_pilot(spark, root, tmp_path / "pilot", limit=5)
    assert (made["chunk_count"], made["discovery_chunk_count"]) == (0, 1)
    documents, units, verified = evaluate.read_pilot(spark, tmp_path / "pilot")
    assert (documents.count(), units.count(), verified.count()) == (1, 1, 0) and "embed_text" in verified.columns
    written = {f.name for f in spark.read.json(str(tmp_path / "pilot" / "documents")).schema} | {f.name for f in spark.read.json(str(tmp_path / "pilot" / "discovery_chunks")).schema}
    assert written == set(documents.columns) | set(verified.columns)
    assert evaluate.export_candidates(spark, tmp_path / "pilot", tmp_path / "cand") == 0


def replies(*answers):
    left = list(answers)

    def send(method, url, body=None):
        a = left.pop(0)
        if isinstance(a, Exception):
            raise a
        return Reply(a[0], a[2] if len(a) > 2 else url, a[1], a[3] if len(a) > 3 else {})

    return send


def test_access_policy():
    slept = []
    assert request(replies(access.TransportError("x"), (503, b""), (429, b"", "https://h/a", {"retry-after": "7"}), (200, b"ok")), "GET", "https://h/a", attempts=4, sleep=slept.append).body == b"ok"
    assert slept == [1.0, 2.0, 7.0]
    for answer in ((403, b""), (429, b""), (200, b"<title>Captcha</title>")):
        with pytest.raises(AccessBlocked):
            request(replies(answer), "GET", "https://h/a", attempts=1, sleep=slept.append)
    assert request(replies((200, b"<script>captcha</script><p>text</p>")), "GET", "https://h/a").status == 200
    for url, answer in (("http://h/a", None), ("https://h/a", (200, b"", "https://other/a"))):
        with pytest.raises(OutOfScope):
            request(replies(answer), "GET", url)


def test_html_lines():
    assert source_lines("<p>a<b>b</b><p>c<ul><li>d<p>e</p></li></ul><table><tr><td>x<td>y</tr></table><p>c</p><p>c</p>") == ["a b", "c", "d e", "x y", "c"]
    assert source_lines("one<br>two<style>z</style>") == ["one", "two"] and source_lines(None) == []
    assert visible_length("<script>abc</script> <p> hé </p>") == 2
    assert links('<a href="/a.pdf">x</a><a href="/a.pdf">y</a><a href="b">z</a>', "https://h/d/", ".pdf") == ["https://h/a.pdf"]
    assert remote.published_pdfs('<a class="x original-file" href="/f">f</a><a href="q.pdf">', "https://h/d/") == ["https://h/f", "https://h/d/q.pdf"]


def listing_transport(method, url, body=None):
    """A listing of three documents over two pages, and their details."""
    if url.endswith("/all"):
        items = [{"id": i, "effStatus": {"name": s}} for i, s in enumerate(["Còn hiệu lực", "Hết hiệu lực toàn bộ", "Chưa có hiệu lực"])]
        page = items[(body["pageNumber"] - 1) * 2 : body["pageNumber"] * 2]
        return Reply(200, url, json.dumps({"data": {"total": 3, "items": page}}).encode())
    return Reply(200, url, json.dumps({"data": {"documentContent": {"content": f"<p>{url}</p>"}}}).encode())


def test_sync_is_checkpointed(spark, tmp_path):
    flags = ["--api-base-url", "https://h", "--dataset-version", "v1", "--data-root", str(tmp_path), "--page-size", "2", "--all-pages", "--request-delay-seconds", "0", "--transport", "test_dataset:listing_transport"]
    assert cli.main(["sync", *flags], spark) == 2  # without the confirmation
    assert cli.main(["sync", *flags, "--confirm-public-source-access"], spark) == 0
    root = tmp_path / "v1"
    manifest = raw_dataset.read_manifest(root)
    assert manifest["record_count"] == 2 and manifest["discovery_complete"] and manifest["checkpoint"]["seen_count"] == 3
    before = (root / "records.jsonl").read_text(encoding="utf-8")
    assert cli.main(["sync", *flags, "--confirm-public-source-access", "--resume"], spark) == 0
    assert (root / "records.jsonl").read_text(encoding="utf-8") == before
    with pytest.raises(FileExistsError):
        cli.main(["sync", *flags, "--confirm-public-source-access"], spark)
    assert cli.main(["audit-corpus", "--dataset-root", str(root), "--report-out", str(tmp_path / "report.json")], spark) == 0


def test_paged_listing_source(spark):
    remote.register(spark)
    rows = spark.read.format("paged_listing").options(listUrl="https://h/all", detailUrl="https://h/{doc_id}", pageSize="2", transport="test_dataset:listing_transport").load()
    assert [(r["page"], r["source_id"], r["total"]) for r in rows.collect()] == [(1, "doc:0", 3), (1, "doc:1", 3), (2, "doc:2", 3)]


def test_stream_ingests_once(spark, tmp_path):
    items, schema = tmp_path / "items", "source_id string, url string"
    items.mkdir()
    (items / "a.json").write_text('{"source_id":"1","url":"u"}\n{"source_id":"1","url":"u"}\n{"source_id":"2","url":"v"}\n', encoding="utf-8")
    args = (spark, str(items), schema, str(tmp_path / "log"), schema, str(tmp_path / "ck"), lambda df: df)
    ingest.run_ingest(*args)
    (items / "b.json").write_text('{"source_id":"2","url":"v"}\n{"source_id":"3","url":"w"}\n', encoding="utf-8")
    ingest.run_ingest(*args)
    assert sorted(r["source_id"] for r in spark.read.schema(schema).json(str(tmp_path / "log")).collect()) == ["1", "2", "3"]


def test_state_is_a_fold(spark):
    rows = [("a", 1, "seen"), ("a", 2, "pending"), ("a", 3, "completed"), ("b", 4, "pending"), ("c", 5, "completed"), ("c", 6, "pending")]
    got = {r["source_id"]: (r["completed"], r["pending"]) for r in sync_state.fold_actions(spark.createDataFrame(rows, "source_id string, seq long, action string")).collect()}
    assert got == {"a": (True, False), "b": (False, True), "c": (True, True)}
    assert not ingest.discovery_complete(3, 3, 1, 2) and ingest.discovery_complete(3, 3, 1, 1)


def test_pdf_quarantine():
    assert remote.pdf_pages(b"x", lambda b: 1 / 0)["warning"] == "pdf_read_error:ZeroDivisionError"
    assert remote.pdf_pages(b"x", lambda b: [" ", None])["warning"] == "no_extractable_text"
    assert remote.pdf_pages(b"x", lambda b: ["a"])["status"] == "extracted"


def test_a_challenge_field_counts_within_a_form_only():
    field = '<input name="g-recaptcha-response">'
    assert access.is_blocked(Reply(200, "https://h/a", f"<form><div>{field}</div></form>".encode()))
    assert not access.is_blocked(Reply(200, "https://h/a", f"<form></form><p>{field}</p>".encode()))


def test_names_are_followed_to_where_they_lead(tmp_path):
    root, other = tmp_path / "root", tmp_path / "root2"
    for p in (root, other):
        (p / "a").mkdir(parents=True)
    (root / "a" / "out").symlink_to(other)
    (root / "a" / "in").symlink_to(root / "a")
    for name, good in (("a/x", True), ("a/../a/x", True), ("a/in/x", True), ("a/out/x", False), ("../root2/x", False), ("/etc/x", False), (None, False), (7, False)):
        assert (raw_dataset.confined(root, name) is not None) == good, name
