import math

import pytest

from millrace.operators import bm25, retrieval_metrics as rm
from millrace.operators.sampling import round_robin, stratum_counts

EVIDENCE = "query_id long, evidence_id long, document_id string, start int, end int, article string, clause string, point string"
RANKED = "query_id long, rank long, document_id string, source_start int, source_end int, citation_verified boolean, article string, clause string, point string"


def test_bm25_by_hand(spark):
    texts = ["a b b c", "b c d", "Straße x", ""]
    rows = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "chunk_id string, embed_text string")
    asked = spark.createDataFrame([(1, "b B d"), (2, "STRASSE"), (3, "none")], "query_id long, query string")
    got = {(r["query_id"], r["chunk_id"]): r["score"] for r in bm25.scores(rows, asked).collect()}
    average = (4 + 3 + 2) / 4

    def w(tf, df, n):
        return math.log(1 + (4 - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / max(1, average)))

    want = {(1, "0"): w(2, 2, 4), (1, "1"): w(1, 2, 3) + w(1, 1, 3), (2, "2"): w(1, 1, 2)}
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-8 for k in want)
    assert [r["chunk_id"] for r in bm25.top_k(bm25.scores(rows, asked), 1).where("query_id = 1").collect()] == ["1"]
    with pytest.raises(ValueError):
        bm25.top_k(rows, 0)


def test_coverage_and_citation(spark):
    evidence = spark.createDataFrame([(1, 0, "d", 0, 100, "1", None, None), (2, 0, "d", 0, 10, "1", "2", None)], EVIDENCE)
    ranked = spark.createDataFrame([(1, 1, "x", 0, 100, True, "1", None, None), (1, 2, "d", 0, 50, True, "1", None, None), (1, 3, "d", 40, 85, True, "1", None, None), (2, 1, "d", 0, 9, True, "1", "3", None), (2, 2, "d", 1, 10, True, "1", "2", None)], RANKED)
    covered = {(r["query_id"], r["rank"]): r["covered"] for r in rm.prefix_coverage(ranked, evidence).collect()}
    assert covered == {(1, 2): 50, (1, 3): 85, (2, 1): 9, (2, 2): 10}
    rows = {r["query_id"]: r for r in rm.per_query(ranked, evidence, evidence.select("query_id"), (1, 5)).collect()}
    assert rows[1]["recall_at_1"] == 0 and rows[1]["recall_at_5"] == 1 and abs(rows[1]["reciprocal_rank"] - 1 / 3) < 1e-9
    assert rows[1]["exact_citation_at_5"] == 0 and rows[2]["exact_citation_at_1"] == 0 and rows[2]["exact_citation_at_5"] == 1


def test_ndcg_by_hand(spark):
    rows = spark.createDataFrame([(1, 2), (1, 3)], "query_id long, rank long")
    assert abs(rm.ndcg(rows).first()["ndcg"] - 0.693426) < 1e-5


def test_gold_rules(spark):
    units = spark.createDataFrame([("d", 0, 20, "1", None, None, True), ("d", 21, 40, None, None, None, False)], "document_id string, start int, end int, article string, clause string, point string, citation_verified boolean")
    docs = spark.createDataFrame([("d", "x" * 40)], "document_id string, source_text string")
    cases = [(1, 0, "d", 0, 20, "1", None, None), (2, 0, "d", 0, 41, "1", None, None), (3, 0, "d", 22, 30, "1", None, None), (4, 0, "d", 0, 5, None, None, None), (5, 0, "e", 0, 5, "1", None, None)]
    assert [r["query_id"] for r in rm.resolvable(spark.createDataFrame(cases, EVIDENCE), units, docs).collect()] == [1]


def test_round_robin_equals_queues(spark):
    rows = [(f"s{i}", "abc"[i % 7 % 3], str(i % 2)) for i in range(60)]
    table = spark.createDataFrame(rows, "source_id string, a string, b string")
    import hashlib

    queues = {}
    for s, a, b in rows:
        queues.setdefault((a, b), []).append((hashlib.sha256(f"k|{s}".encode()).hexdigest(), s))
    queues, want = {k: sorted(v) for k, v in queues.items()}, []
    while len(want) < 17:
        for k in sorted(queues):
            if queues[k] and len(want) < 17:
                want.append(queues[k].pop(0)[1])
    got = round_robin(table, ["a", "b"], 17, "k")
    assert [r["source_id"] for r in got.collect()] == want
    counts = stratum_counts(table, round_robin(table, ["a", "b"], 2, "k"), ["a", "b"]).collect()
    assert len(counts) == len(queues) and sum(r["n_selected"] for r in counts) == 2
