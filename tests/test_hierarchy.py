import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.operators import chunks, hierarchy

RULES = [
    ("part", re.compile(r"(?:PHẦN|Phần)\s+([IVXLCDM]+|\d+)\b")),
    ("chapter", re.compile(r"(?:CHƯƠNG|Chương)\s+([IVXLCDM]+|\d+)\b")),
    ("section", re.compile(r"(?:MỤC|Mục)\s+([IVXLCDM]+|\d+)\b")),
    ("article", re.compile(r"(?:ĐIỀU|Điều)\s+(\d+[a-zA-Z]?)\s*[.:]?(?:\s|$)")),
    ("clause", re.compile(r"(\d+)\.\s+")),
    ("point", re.compile(r"([a-zđ])\)\s+", re.I)),
]
LINES = ["Phần I Một", "Chương 2 Hai", "Mục 3 Ba", "Điều 1. Tên", "ĐIỀU 2a: X", "Điều 5.Liền", "Điều này", "1. khoản", "2.  khoản", "a) điểm", "Đ) điểm", "tiếp theo", "thêm"]


def model(lines):
    """One line after another; a dictionary of levels that headings set and clear."""
    order, path, at, out = [k for k, _ in RULES], dict.fromkeys(hierarchy.LEVELS), 0, []
    for line in lines:
        kind = next((k for k, r in RULES if r.match(line)), "text")
        ok = False
        if kind != "text":
            path[kind] = dict(RULES)[kind].match(line)[1]
            path.update(dict.fromkeys(order[order.index(kind) + 1 :]))
            if kind == "point" and path["clause"] is None:
                path["article"] = path["point"] = None
            else:
                ok = kind in ("article", "clause", "point") and path["article"] is not None
        elif re.match(r"(?:Điều|ĐIỀU)\b", line):
            path.update(article=None, clause=None, point=None)
        else:
            ok = path["article"] is not None
        out.append((at, at + len(line), kind, path.get(kind), *path.values(), ok))
        at += len(line) + 1
    return out


def units_of(spark, docs):
    rows = [(str(i), p, t) for i, lines in enumerate(docs) for p, t in enumerate(lines)]
    return hierarchy.parse_units(spark.createDataFrame(rows, "document_id string, pos int, text string"))


@settings(max_examples=4, deadline=None)
@given(docs=st.lists(st.lists(st.sampled_from(LINES), min_size=1, max_size=12), min_size=40, max_size=60))
def test_windows_equal_the_sequential_model(spark, docs):
    got = {}
    for r in units_of(spark, docs).orderBy("pos").collect():
        got.setdefault(r["document_id"], []).append((r["start"], r["end"], r["kind"], r["label"], *[r[k] for k in hierarchy.LEVELS], r["citation_verified"]))
    assert got == {str(i): model(lines) for i, lines in enumerate(docs)}


def test_chunks_tile_the_units(spark):
    docs = [["Chương 1 Đầu", "Điều 1. Tên", "1. khoản " + "x" * 50, "tiếp theo", "a) điểm", "Điều này"], ["không tiêu đề"], ["a) mồ côi"]]
    units = units_of(spark, docs)
    meta = spark.createDataFrame([(str(i), f"h{i}", "No", None, "\n".join(x)) for i, x in enumerate(docs)], "document_id string, source_hash string, document_number string, title string, source_text string")
    made = chunks.hierarchy_chunks(units, meta, 20)
    assert chunks.coverage_errors(units, meta, made).count() == 0
    rows = made.where("document_id = '0'").orderBy("source_start").collect()
    texts = [r["content"] for r in rows]
    assert "".join(t for t, r in zip(texts, rows) if r["clause"] == "1" and r["point"] is None) == docs[0][2] + "\n" + docs[0][3]
    assert rows[-2]["embed_text"] == "No | chapter:1 / article:1 / clause:1 / point:a | Điều 1. Tên | " + docs[0][2] + " | a) điểm"
    assert not rows[-1]["citation_verified"] and rows[-1]["warnings"] == ["unverified_citation_path"]
    assert {e["error"] for e in chunks.coverage_errors(units, meta, made.limit(0)).collect()} == {"unit not covered"}
    twice = {e["error"] for e in chunks.coverage_errors(units, meta, made.unionByName(made)).collect()}
    assert {"repeated chunk id", "chunk overlaps the one before"} <= twice
    with pytest.raises(ValueError):
        chunks.fixed_chunks(meta, 0)


def test_one_exchange_serves_all_windows(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = spark.range(10).selectExpr("cast(id as string) document_id", "cast(id as int) pos", "'x' text")
        plan = hierarchy.parse_units(rows)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange") == 1
