import random

from millrace.operators import term_index


def test_blocks_are_made_in_batches_and_hold_the_same_peaks(spark):
    rng = random.Random(5)
    rows = [(r, p, rng.randrange(0, 9), [(f"t{t}", rng.randrange(1, 5)) for t in rng.sample(range(12), rng.randrange(0, 6))]) for r in (3, 1 << 33, 7) for p in range(40)]
    rows += [(9, 0, 0, [])]
    forward = spark.createDataFrame(rows, "range long, place int, len long, runs array<struct<term:string,tf:bigint>>").coalesce(1)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "25")  # ranges go on in the next batch
    try:
        made = term_index.blocks_of(forward).withColumn("own", term_index.peaks_of("postings"))
        got = made.collect()
        assert "Aggregate" not in made._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = {}
    for number, place, length, runs in rows:
        for term, tf in runs:
            want.setdefault((term, number), []).append((place, tf, length))
    assert {(r["term"], r["range"]): [tuple(p) for p in r["postings"]] for r in got} == want and len(got) == len(want)
    assert all(r["n"] == len(r["postings"]) and r["peaks"] == r["own"] for r in got)


def test_only_the_best_of_a_range_are_rows(spark, tmp_path):
    rng = random.Random(6)
    chunks = spark.createDataFrame([(f"{i:03d}", " ".join(rng.choices("abcdef", k=rng.randrange(1, 9)))) for i in range(300)], "chunk_id string, embed_text string")
    queries = spark.createDataFrame([(1, "a b c"), (1, "a"), (2, "f"), (3, "zz"), (4, "d e")], "query_id long, query string")
    index = term_index.TermIndex(spark, str(tmp_path / "index"))
    term_index.append(index, chunks)
    asked, limits = term_index.bounds(index, queries)
    every = {}
    for r in term_index.scored_by_joins(index, asked, limits).collect():
        every.setdefault((r["query_id"], r["segment"], r["range"]), []).append((r["score"], r["place"]))
    got = {}
    for r in term_index.scored(index, asked, limits, 3).collect():
        got.setdefault((r["query_id"], r["segment"], r["range"]), []).append((r["score"], r["place"]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(x for x in v if x[0] >= sorted(v, reverse=True)[:3][-1][0]) for k, v in every.items()}
