import random

import pytest

from millrace.operators import bm25, term_index
from millrace.operators.term_index import TermIndex, append, peaks_of


def chunks_of(spark, seed=1, n=1500):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        tongue = i // 300  # neighbours share a vocabulary, as documents of one language do
        words = [f"t{tongue}w{int(rng.paretovariate(0.7)) % 300}" for _ in range(rng.randrange(1, 50))] + ["the"] * rng.randrange(4)
        rows.append((f"{i:05d}", " ".join(words)))
    rows += [("x1", "the " * 3000), ("x2", ""), ("x3", None), ("x4", "t1w1 t1w1"), ("x5", "t1w1 t1w1"), (None, "t1w1")]
    return spark.createDataFrame(rows, "chunk_id string, embed_text string").repartition(3)


QUERIES = [(1, "t0w1 t0w2 t0w7"), (2, "The t1w1"), (3, "t2w3 t2w3 t3w4 t4w1 the"), (4, "absent"), (5, None), (6, "t4w250 t4w251 t4w252"), (7, "the")]


def ranked(df):
    return sorted((r["query_id"], r["rank"], r["chunk_id"], round(r["score"], 6)) for r in df.collect())


def plain(spark, chunks, queries, k):
    return ranked(bm25.top_k(bm25.scores(chunks.where("chunk_id IS NOT NULL"), queries), k))


def test_same_ranking_with_blocks_skipped(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(term_index, "RANGE", 64)
    chunks, queries = chunks_of(spark), spark.createDataFrame(QUERIES, "query_id long, query string")
    index = TermIndex(spark, str(tmp_path / "index"))
    assert ranked(term_index.top_k(index, queries, 10)) == []  # no segment yet
    append(index, chunks)
    told = {}
    assert ranked(term_index.top_k(index, queries, 10, told=told)) == plain(spark, chunks, queries, 10)
    assert told["read"] < told["blocks"]
    # "the" is in every range, but alone it can't reach the third score
    far = {}
    one = spark.createDataFrame([(8, "t0w1 t0w2 t0w3 the")], "query_id long, query string")
    assert ranked(term_index.top_k(index, one, 3, told=far)) == plain(spark, chunks, one, 3)
    assert far["read"] < 0.6 * far["blocks"] and far["blocks"] > 30


def test_appended_segments_rank_like_one_collection(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(term_index, "RANGE", 32)
    chunks, queries = chunks_of(spark, 2, 600), spark.createDataFrame(QUERIES, "query_id long, query string")
    index = TermIndex(spark, str(tmp_path / "index"))
    names = [append(index, chunks.where(f"hash(chunk_id) % 3 = {part}")) for part in (-2, -1, 0, 1, 2)]
    assert index.segments() == sorted(names)
    before = {n: sorted(p.name for p in (tmp_path / "index" / "postings" / f"segment={n}").rglob("*.parquet")) for n in names}
    assert ranked(term_index.top_k(index, queries, 5)) == plain(spark, chunks, queries, 5)
    again = append(index, chunks)  # all of it is known
    assert index.forward().where(f"segment = '{again}'").count() == 0
    assert before == {n: sorted(p.name for p in (tmp_path / "index" / "postings" / f"segment={n}").rglob("*.parquet")) for n in names}
    assert ranked(term_index.top_k(index, queries, 5)) == plain(spark, chunks, queries, 5)


def test_a_segment_without_totals_is_not_there(spark, tmp_path):
    index = TermIndex(spark, str(tmp_path / "index"))
    queries = spark.createDataFrame(QUERIES, "query_id long, query string")
    chunks = chunks_of(spark, 3, 100)
    append(index, chunks)
    broken = append(index, spark.createDataFrame([("new", "t0w1")], "chunk_id string, embed_text string"))
    for p in sorted((tmp_path / "index" / "stats" / f"segment={broken}").iterdir()):
        p.unlink()
    (tmp_path / "index" / "stats" / f"segment={broken}").rmdir()
    assert ranked(term_index.top_k(index, queries, 5)) == plain(spark, chunks, queries, 5)


@pytest.mark.parametrize("seed", range(3))
def test_peaks_hold_every_blocks_largest_weight(spark, seed):
    rng = random.Random(seed)
    rows = [[(i, rng.randrange(1, 6), rng.randrange(1, 40)) for i in range(rng.randrange(1, 30))] for _ in range(40)]
    made = spark.createDataFrame([(r,) for r in rows], "p array<struct<place:int,tf:bigint,len:bigint>>").select("p", peaks_of("p").alias("peaks")).collect()

    def weight(tf, length, average):
        return tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / average))

    for r in made:
        for average in (1.0, 17.0, 500.0):
            assert max(weight(p["tf"], p["len"], average) for p in r["p"]) == max(weight(p["tf"], p["len"], average) for p in r["peaks"])
        assert len(r["peaks"]) <= 5
