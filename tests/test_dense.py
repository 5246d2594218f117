import math

import numpy as np

from millrace.operators import dense


def brute(rows, queries, k):
    def unit(v):
        if v is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        return np.array(v) / math.sqrt(sum(x * x for x in v))

    out = {}
    for q in queries:
        own = unit(q[1])
        if own is None:
            continue
        found = [(-round(float(own @ unit(v)), 6), i) for i, v in rows if i is not None and i != q[0] and unit(v) is not None and len(v) == len(q[1])]
        out[q[0]] = [(i, rank + 1, -s) for rank, (s, i) in enumerate(sorted(found)[:k])]
    return {q: found for q, found in out.items() if found}


def test_top_k_equals_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, rng.standard_normal(6).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(40)]  # ties
    rows += [(2000, None), (2001, []), (2002, [0.0] * 6), (2003, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2004, [float("nan")] + [1.0] * 5), (2005, [1.0, 2.0]), (None, rows[1][1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    chosen = [r for r in rows if r[0] is not None and r[0] % 100 == 0]
    for block in (dense.BLOCK, 16):
        monkeypatch.setattr(dense, "BLOCK", block)
        got = {}
        for r in dense.cosine_top_k(vectors, vectors.where("vec_id % 100 = 0"), 7).orderBy("query_id", "rank").collect():
            got.setdefault(r["query_id"], []).append((r["vec_id"], r["rank"], r["score"]))
        assert got == brute(rows, chosen, 7) and 2000 not in got


def test_text_ids_and_no_vectors(spark):
    vectors = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [1.0, 1.0]), ("c", [0.0, 1.0])], "vec_id string, embedding array<float>")
    got = [(r["query_id"], r["vec_id"], r["score"]) for r in dense.cosine_top_k(vectors, vectors.where("vec_id = 'a'"), 1).collect()]
    assert got == [("a", "b", 0.707107)]
    assert dense.cosine_top_k(vectors.limit(0), vectors, 3).count() == 0 and dense.cosine_top_k(vectors, vectors.limit(0), 3).count() == 0
