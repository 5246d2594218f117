from millrace.operators import bm25


def test_tasks_follow_the_pairs_of_postings_and_queries(spark, monkeypatch):
    chunks = spark.createDataFrame([(f"c{i}", f"w{i % 5} w{i % 3} all") for i in range(60)], "chunk_id string, embed_text string")
    queries = spark.createDataFrame([(i, "all w1 w2") for i in range(10)], "query_id int, query string")
    whole = bm25.scores(chunks, queries)
    # 60 chunks hold "all", w1 and w2 are each in 28: 1,160 pairs for ten queries, 200 of them at most in a task
    monkeypatch.setattr(bm25, "TASK_ROWS", 200)
    dealt = bm25.scores(chunks, queries)
    assert dealt.rdd.getNumPartitions() == 6
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, whole.collect())) and whole.count() == 600
