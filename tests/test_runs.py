import random

from millrace.operators import runs


def test_all_pairs_of_a_text_and_a_run_that_it_holds_are_met(spark):
    """Runs of several lengths, equal ones, texts that are null, empty or shorter, and none that goes on in the next text."""
    rng = random.Random(3)
    texts = [[f"w{rng.randrange(6)}" for _ in range(rng.randrange(25))] for _ in range(80)] + [[], None, ["w1", "w2"], ["w3", "w4"]]
    keys = [[f"w{rng.randrange(6)}" for _ in range(rng.choice([1, 2, 3, 6]))] for _ in range(30)] + [["w2", "w3"], ["w2", "w3"], ["w9", "w1"], []]
    found = runs.meeting(spark.createDataFrame(list(enumerate(texts)), "id long, words array<string>").repartition(3), spark.createDataFrame(list(enumerate(keys)), "query_id long, key array<string>"))
    want = {(i, q) for i, t in enumerate(texts) for q, k in enumerate(keys) if k and t and any(t[a : a + len(k)] == k for a in range(len(t)))}
    got = [(r["id"], r["query_id"]) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want


def test_no_run_gives_no_row(spark):
    none = spark.createDataFrame([], "query_id long, key array<string>")
    assert runs.meeting(spark.createDataFrame([(1, ["a"])], "id long, words array<string>"), none).count() == 0
