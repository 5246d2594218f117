import random

import pytest

from millrace.operators import bm25


def texts(n, seed, words=40):
    rng = random.Random(seed)
    return [" ".join(f"w{int(rng.paretovariate(0.7)) % words}" for _ in range(rng.randrange(30))) for _ in range(n)]


@pytest.mark.parametrize("k, cells, again", [(1, 4_000_000, False), (5, 60, False), (5, 60, True), (40, 4_000_000, True)])
def test_best_gives_the_rows_of_ranking_every_pair(spark, monkeypatch, k, cells, again):
    """Ties, empty and null texts, unknown terms, queries that share an id and chunks that share one; blocks of one chunk too."""
    monkeypatch.setattr(bm25, "CELLS", cells)
    found = texts(120, 1) + ["w1 w2"] * 9 + ["", None]
    chunks = spark.createDataFrame([(f"c{i % 50 if again else i}", t) for i, t in enumerate(found)], "chunk_id string, embed_text string")
    asked = spark.createDataFrame([*enumerate(texts(20, 2)), (3, "w1 w1 w5"), (98, "w1 w2 unheard"), (99, "unheard"), (100, None)], "query_id long, query string")
    told = bm25.top_k(bm25.scores(chunks, asked), k)
    assert sorted(map(tuple, bm25.best(chunks, asked, k).select(*told.columns).collect())) == sorted(map(tuple, told.collect()))


def test_best_shuffles_no_pair_of_chunk_and_query(spark):
    chunks = spark.range(3000).selectExpr("id AS chunk_id", "concat('a b c', id) AS embed_text")
    asked = spark.range(50).selectExpr("id AS query_id", "concat('a c', id) AS query")
    found = bm25.best(chunks, asked, 3)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan and "Join" not in plan and found.count() == 150


def test_no_query_and_no_chunk_give_no_row(spark):
    some, none = spark.createDataFrame([(1, "a b")], "query_id long, query string"), spark.createDataFrame([], "query_id long, query string")
    chunks = spark.createDataFrame([("c", "a")], "chunk_id string, embed_text string")
    assert bm25.best(chunks, none, 3).count() == 0 and bm25.best(chunks.limit(0), some, 3).count() == 0 and bm25.best(chunks, some, 3).count() == 1
