import unicodedata

from pyspark.sql import functions as F

from millrace import queries
from millrace.functions import text as T
from millrace.operators import chunks, hierarchy


def test_lines_are_stripped_of_all_white_space(spark):
    rows = [(str(i), f"{c}a{c}b{c}{c}\n{c}") for i, c in enumerate(hierarchy.WHITE) if c != "\n"]
    docs = spark.createDataFrame(rows, "document_id string, text string")
    got = {(r["document_id"], r["pos"]): r["text"] for r in hierarchy.split_lines(docs).collect()}
    assert got == {(i, 0): t[1:-4] for i, t in rows}
    every = spark.range(0x30000).where("id < 55296 OR id > 57343").select("id", F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "utf-32").alias("c"))
    assert {r["c"] for r in every.where(F.col("c").rlike(r"(?U)^\s$")).collect()} == set(hierarchy.WHITE)


def test_islands_are_not_grouped(spark):
    rows = [("d", 0, "Điều 1. A"), ("d", 1, "x"), ("d", 2, "y"), ("d", 3, "1. k"), ("d", 4, "z"), ("e", 0, "t"), ("e", 1, "u")]
    units = hierarchy.parse_units(spark.createDataFrame(rows, "document_id string, pos int, text string"))
    merged = chunks.merge_continuations(units)
    assert "Aggregate" not in merged._jdf.queryExecution().optimizedPlan().toString()
    got = sorted((r["document_id"], r["pos"], r["start"], r["end"], r["text"], r["kind"], r["label"]) for r in merged.collect())
    assert got == [("d", 0, 0, 13, "Điều 1. A\nx\ny", "article", "1"), ("d", 3, 14, 20, "1. k\nz", "clause", "1"), ("e", 0, 0, 3, "t\nu", "text", None)]


def test_coverage_and_variants_read_the_documents_once(spark, monkeypatch):
    reads, own = [], queries.table
    monkeypatch.setattr(queries, "table", lambda s, d, name: reads.append(name) or own(s, d, name))
    for name in ("chunk_coverage_check", "chunk_coverage_broken", "variant_sizes"):
        reads.clear()
        queries.QUERIES[name](spark, "/root/testdata/sf0.001")
        assert reads == ["documents"]


def test_tokens_are_counted_without_folding_what_need_not_be(spark):
    odd = [chr(c) for c in range(0x80, 0x30000) if not 0xD800 <= c < 0xE000 and (unicodedata.category(chr(c))[0] in "LNM" or chr(c).lower() != chr(c))]
    rows = [(f"a{c}b {c} {c}{c}",) for c in odd] + [("",), (None,), ("_ A1, b\n-c",)]
    got = spark.createDataFrame(rows, "t string").select("t", T.token_count("t").alias("n"), F.size(T.tokens("t")).alias("own"))
    assert got.where("t IS NOT NULL AND n <> own").collect() == []
    assert got.where("t IS NULL").select("n").first()[0] is None
