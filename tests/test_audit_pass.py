"""The audit reads each file of a reference once, whatever number of rules looks at it."""

import re

from pyspark.sql import functions as F

from millrace import queries
from millrace.operators import quality_audit


def test_references_meet_their_files_once(spark):
    plan = queries.audit_issues(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("+- == Initial Plan ==")[-1]
    assert len(re.findall("ArrowEvalPython", initial)) == 1
    assert len(re.findall("FileScan", initial)) <= 5


def test_all_codes_of_a_record_and_of_its_references(spark):
    a = "struct<kind:string,source_id:string,source_url:string,fetched_at:string,sha256:string,relative_path:string,http_status:int>"
    r = "struct<source_id:string,errors:array<string>>"
    records = spark.createDataFrame([(1, ("a", None)), (2, ("b", ["e", "f"])), (3, ("c", [])), (4, ("d", []))], f"line_no int, r {r}")
    body = '{"data":{"id":1,"title":"","docNum":0,"docType":{},"effStatus":"x","issueDate":"2020-13-01","effFrom":"2020-02-01","effTo":"2020-01-01","documentContent":{"content":"<p>x</p>"}}}'
    refs = [
        (1, "a", 0, ("document_json", "a", "u", "t", "h1", "1.json", 200)),
        (1, "a", 1, ("document_html", "z", "u", None, "h2", "1.html", 404)),
        (1, "a", 2, ("document_html", "a", "u", "t", "h2", "1.html", 200)),
        (1, "a", 3, ("document_html", "a", "u", "t", "h2", "1.html", 200)),
        (2, "b", 0, ("document_json", "b", "u", "t", "h3", "2.json", 200)),
        (2, "b", 1, ("document_pdf", "b", "u", "t", "h4", "/x", 200)),
        (3, "c", 0, ("document_pdf", "q", "", "t", "h1", "1.json", 500)),
    ]
    refs = spark.createDataFrame(refs, f"line_no int, source_id string, pos int, a {a}")
    files = spark.createDataFrame([("1.json", "h1", True, body), ("1.html", "h2", True, "<p>y</p>"), ("2.json", "h3", True, "{")], "relative_path string, sha256 string, is_text boolean, content string")
    checked = quality_audit.checked_references(refs, files)
    state = quality_audit.document_state(records, checked)
    got = quality_audit.document_issues(state, with_references=True)
    apart = quality_audit.reference_issues(checked).unionByName(quality_audit.document_issues(state))
    want = [("a", c) for c in ("artifact_source_id_mismatch", "missing_provenance", "non_200_artifact", "html_reference_count", "missing_title", "missing_docNum", "missing_docType", "invalid_issueDate", "reversed_effective_dates", "json_html_mismatch", "json_html_mismatch")]
    want += [("b", c) for c in ("unsafe_path", "missing_html", "missing_document_data", "record_error", "invalid_document_json")]
    want += [("c", c) for c in ("missing_provenance", "non_200_artifact", "json_reference_count", "missing_html", "missing_document_data")]
    want += [("d", c) for c in ("json_reference_count", "missing_html", "missing_document_data")]
    assert sorted(map(tuple, got.collect())) == sorted(want) == sorted(map(tuple, apart.select("source_id", F.col("code")).collect()))
