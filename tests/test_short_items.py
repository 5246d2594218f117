from millrace import queries


def test_gold_spans_of_short_items(spark, tmp_path):
    words = "one two three four five six seven eight nine ten".split()
    docs = [(1, "so " + " ".join(words) + "th, one two three"), (2, "Eight nine. seven eight"), (3, "none"), (4, None), (5, "")]
    items = [" ".join(words[:n]) for n in range(1, 11)] + ["seven eight nine ten", "ne tw", "eight", "nine. seven eigh", "?", "."]
    items = [(i, t) for i, t in enumerate(items)] + [(99, None)]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(tuple(r) for r in queries.QUERIES["gold_spans"](spark, str(tmp_path)).collect())
    want = sorted((i, str(d), x.find(t), x.find(t) + len(t)) for i, t in items for d, x in docs if t and x and t in x)
    assert got == want and len({r[0] for r in want}) == 15
