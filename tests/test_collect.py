import json

import pytest

from millrace import cli
from millrace.plans import collect
from millrace.sources import raw_dataset as raw
from millrace.sources import remote
from millrace.sources.access import Reply
from millrace.sources.profile import SourceProfile
from millrace.sources.state_file import StateFile

LABELS = ["Còn hiệu lực", "Hết hiệu lực toàn bộ", "Chưa có hiệu lực", "Còn hiệu lực"]


def sound(method, url, body=None):
    """A listing of four documents over two pages, their details, and pages with one PDF."""
    if url.endswith(("/all", "/list")):
        items = [{"id": i, "effStatus": {"name": s}, "document_url": "http://h/x"} for i, s in enumerate(LABELS)]
        size, page = body["pageSize"], body["pageNumber"]
        return Reply(200, url, json.dumps({"data": {"total": 4, "items": items[(page - 1) * size : page * size]}}).encode())
    if url.endswith(".pdf"):
        return Reply(200, url, b"blank" if "d1" in url else b"pdf bytes")
    if "/page/" in url:
        return Reply(200, url, f'<p>text</p><a href="{url}.pdf">x</a><a href="/q?ItemID=7">y</a>'.encode())
    return Reply(200, url, json.dumps({"data": {"documentContent": {"content": f"<p>{url}</p>"}}}).encode())


def flaky(method, url, body=None):
    return Reply(404, url, b"") if url.endswith("/2") else sound(method, url, body)


def refusing(method, url, body=None):
    return Reply(403, url, b"") if url.endswith("/d2") else sound(method, url, body)


def no_interface(method, url, body=None):
    return Reply(404, url, b"") if url.endswith("/list") else sound(method, url, body)


def read_pdf(content):
    return ["one", None] if content != b"blank" else [" "]


def ids(root):
    return [json.loads(x)["source_id"] for x in (root / "records.jsonl").read_text(encoding="utf-8").splitlines()]


def common(tmp_path, transport):
    return ["--dataset-version", "v", "--data-root", str(tmp_path), "--request-delay-seconds", "0", "--transport", f"test_collect:{transport}", "--confirm-public-source-access"]


def test_sync_retries_what_is_pending_first(spark, tmp_path, capsys):
    flags, root = ["sync", "--api-base-url", "https://h", "--page-size", "2", "--all-pages"], tmp_path / "v"
    assert cli.main([*flags, *common(tmp_path, "flaky")], spark) == 0
    told = [json.loads(x) for x in capsys.readouterr().err.splitlines() if x.startswith("{")]
    assert [(x["page"], x["pages"], x["seen_count"]) for x in told] == [(2, 2, 4)]
    m = raw.read_manifest(root)
    assert ids(root) == ["doc:0", "doc:3"] and [s["source_id"] for s in m["pending_seeds"]] == ["doc:2"]
    assert m["status_counts"] == {"Còn hiệu lực": 2, "Hết hiệu lực toàn bộ": 1, "Chưa có hiệu lực": 1} and m["skipped_status_counts"] == {"Hết hiệu lực toàn bộ": 1}
    assert [a["source_id"] for a in m["discovery_artifacts"]] == ["doc:list:pass:1:page:1", "doc:list:pass:1:page:2"]
    assert m["checkpoint"]["last_completed_page"] == 2 and m["checkpoint"]["failed_source_ids"] == ["doc:2"] and m["discovery_complete"]
    assert raw.state_counts(root / "sync-state.sqlite3") == {"seen_count": 4, "completed_count": 2, "pending_count": 1}
    assert cli.main([*flags, "--resume", *common(tmp_path, "sound")], spark) == 0
    m = raw.read_manifest(root)
    assert ids(root) == ["doc:0", "doc:3", "doc:2"] and not m["pending_seeds"] and m["record_count"] == 3
    assert m["status_counts"]["Còn hiệu lực"] == 2 and m["skipped_status_counts"] == {"Hết hiệu lực toàn bộ": 2}
    assert cli.main(["audit-corpus", "--dataset-root", str(root), "--report-out", str(tmp_path / "r.json")], spark) == 0
    codes = {i["code"] for i in json.loads((tmp_path / "r.json").read_text(encoding="utf-8"))["issues"]}
    assert not [c for c in codes if "mismatch" in c or "state" in c]
    with pytest.raises(ValueError, match="isn't the same"):
        cli.main(["sync", "--api-base-url", "https://h", "--page-size", "3", "--resume", *common(tmp_path, "sound")], spark)


def test_two_passes_and_a_page_limit(spark, tmp_path):
    flags, root = ["sync", "--api-base-url", "https://h", "--page-size", "3", "--status-scope", "all"], tmp_path / "v"
    assert cli.main([*flags, "--max-pages", "1", *common(tmp_path, "sound")], spark) == 0
    m = raw.read_manifest(root)
    assert ids(root) == ["doc:0", "doc:1", "doc:2"] and not m["discovery_complete"] and not m["discovery_incomplete"]
    assert cli.main([*flags, "--max-discovery-passes", "2", "--resume", *common(tmp_path, "sound")], spark) == 0
    m = raw.read_manifest(root)
    assert len(ids(root)) == 4 and m["discovery_complete"] and m["checkpoint"]["stable_total_passes"] == 2


def seeds(tmp_path, n=3):
    path = tmp_path / "seeds.jsonl"
    path.write_text("".join(json.dumps({"source_id": f"doc:{i}", "canonical_url": f"https://h/page/d{i}"}) + "\n" for i in range(1, n + 1)), encoding="utf-8")
    return ["--seed", str(path), "--source-base-url", "https://h"]


def test_a_refusal_keeps_what_came_before(spark, tmp_path):
    given, root = seeds(tmp_path), tmp_path / "v"
    assert cli.main(["crawl", *given, *common(tmp_path, "refusing")], spark) == 2
    m = raw.read_manifest(root)
    assert ids(root) == ["doc:1"] and m["record_count"] == 1 and "403" in m["checkpoint"]["stopped_reason"]
    assert cli.main(["crawl", *given, "--resume", *common(tmp_path, "sound")], spark) == 0
    assert ids(root) == ["doc:1", "doc:2", "doc:3"]


def test_pdfs_are_read_once(spark, tmp_path):
    root = tmp_path / "v"
    assert cli.main(["crawl", *seeds(tmp_path), *common(tmp_path, "sound")], spark) == 0
    flags = ["--dataset-version", "v", "--data-root", str(tmp_path), "--pdf-reader", "test_collect:read_pdf"]
    assert cli.main(["extract-pdf", *flags], spark) == 0
    records = {r["source_id"]: r for r in map(json.loads, (root / "records.jsonl").read_text(encoding="utf-8").splitlines())}
    told = {i: [(e["status"], e["page_count"], e["warning"]) for e in r["pdf_extractions"]] for i, r in records.items()}
    assert told == {"doc:1": [("quarantined", 1, "no_extractable_text")], "doc:2": [("extracted", 2, None)], "doc:3": [("extracted", 2, None)]}
    text = records["doc:2"]["artifacts"][-1]
    assert text["kind"] == "pdf_text" and json.loads((root / text["relative_path"]).read_text(encoding="utf-8")) == {"source_artifact_id": text["source_artifact_id"], "pages": ["one", ""]}
    before = (root / "records.jsonl").read_bytes()
    assert collect.extract_pdfs(spark, root, "test_collect:read_pdf") == {} and (root / "records.jsonl").read_bytes() == before


def test_discover(spark, tmp_path):
    out = tmp_path / "seeds.jsonl"
    urls = ["--api-list-url", "https://h/list", "--api-detail-url-template", "https://h/doc/{doc_id}", "--document-url-template", "https://h/page/{doc_id}"]
    rest = ["--seed-out", str(out), "--limit", "2", "--request-delay-seconds", "0", "--confirm-public-source-access"]
    assert cli.main(["discover", *urls, *rest, "--transport", "test_collect:sound"], spark) == 0
    got = [json.loads(x) for x in out.read_text(encoding="utf-8").splitlines()]
    assert [(r["source_id"], r["canonical_url"], r["api_detail_url"], r["selection_bucket"]) for r in got] == [("doc:0", "https://h/page/0", "https://h/doc/0", "active"), ("doc:1", "https://h/page/1", "https://h/doc/1", "expired")]
    assert cli.main(["discover", *urls, "--listing-url", "https://h/page/l", *rest, "--transport", "test_collect:no_interface"], spark) == 0
    assert [json.loads(x)["source_id"] for x in out.read_text(encoding="utf-8").splitlines()] == ["doc:7"]
    with pytest.raises(ValueError, match="needs listing_url"):
        cli.main(["discover", "--source-mode", "html", *rest], spark)


def test_profiles():
    with pytest.raises(ValueError, match="api_list_url"):
        SourceProfile("x", "api")
    with pytest.raises(ValueError):
        SourceProfile("x", "html", "https://h", pause=-1)
    assert SourceProfile("x", "html", "https://h").pause == 1.5


def test_fallback_to_the_page():
    seed = {"source_id": "a", "canonical_url": "https://h/page/d9", "api_detail_url": "https://h/none"}
    send = lambda method, url, body=None: Reply(200, url, b"not json") if url.endswith("none") else sound(method, url, body)
    assert [r["kind"] for r in remote.artifact_rows(seed, "hybrid", send)] == ["document_json", "document_html", "original_pdf"]
    assert [r["kind"] for r in remote.artifact_rows(seed, "detail", send)] == ["document_json"]


def test_state_follows_the_log(tmp_path):
    state = StateFile(tmp_path / "s.sqlite3")
    state.note(seen=["a", "b"], pending=["c", "b"])
    assert state.pending() == ["b", "c"] and state.status("a") == (True, False)
    state.close()
    state = StateFile(tmp_path / "s.sqlite3", completed=["b", "d"])
    assert state.pending() == ["c"] and state.status("b") == state.status("d") == (True, True) and state.counts() == {"seen_count": 3, "completed_count": 2, "pending_count": 1}


def shifting(method, url, body=None):
    """A listing whose total falls from page to page, with a source that stands on two of them."""
    if url.endswith("/all"):
        page = body["pageNumber"]
        items = [{"id": i, "effStatus": {"name": s}} for i, s in [[(0, LABELS[0]), (1, LABELS[1])], [(0, LABELS[0]), (1, LABELS[1])], [(2, LABELS[0])]][page - 1]]
        return Reply(200, url, json.dumps({"data": {"total": 7 - page, "items": items}}).encode())
    return sound(method, url, body)


def test_totals_that_move_and_sources_on_two_pages(spark, tmp_path):
    flags, root = ["sync", "--api-base-url", "https://h", "--page-size", "2", "--max-pages", "3"], tmp_path / "v"
    assert cli.main([*flags, *common(tmp_path, "shifting")], spark) == 0
    m = raw.read_manifest(root)
    assert ids(root) == ["doc:0", "doc:2"] and len(m["retrieval_errors"]) == 2 and not m["discovery_complete"]
    assert m["status_counts"] == {LABELS[0]: 2, LABELS[1]: 1} and m["skipped_status_counts"] == {LABELS[1]: 2}


def test_lanes_read_every_page_once(spark):
    remote.register(spark)
    for lanes in (1, 2, 3, 5):
        rows = spark.read.format("listing_replies").options(listUrl="https://h/all", detailUrl="https://h/{doc_id}", pageSize="1", lanes=str(lanes), transport="test_collect:sound").load()
        got = rows.where("size(seeds) > 0").selectExpr("page", "seeds[0].source_id AS id").orderBy("page").collect()
        assert [(r["page"], r["id"]) for r in got] == [(i + 1, f"doc:{i}") for i in range(4)] and rows.rdd.getNumPartitions() == lanes
