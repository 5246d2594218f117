import math
import random

import pytest

from millrace.operators.context import pack_context

RANKED = "query_id long, rank long, score double, document_id string, source_start int, source_end int, n_tokens long"


def brute(rows, budget, least):
    out = []
    for q in sorted({r[0] for r in rows}):
        own = sorted(r[1:] for r in rows if r[0] == q and r[4] < r[5] and r[3] is not None and r[2] is not None)
        top, used, covered = max((r[1] for r in own), default=0), 0, {}
        for rank, score, doc, a, b, n in own:
            new = [p for p in range(a, b) if p not in covered.setdefault(doc, set())]
            if not new or score * len(new) / (b - a) < top * least:
                continue
            cost = math.ceil(n * len(new) / (b - a))
            if used + cost > budget:
                continue
            used += cost
            covered[doc] |= set(new)
            out.append((q, rank, doc, a, b, frozenset(new), cost, used))
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("budget, least", [(40, 0.25), (15, 0.0), (200, 0.6)])
def test_equals_brute_force(spark, seed, budget, least):
    rng = random.Random(seed)
    rows = []
    for q in range(8):
        scores = sorted((rng.choice([1.0, 2.5, rng.random() * 10]) for _ in range(12)), reverse=True)
        for rank, score in enumerate(scores, 1):
            a = rng.randrange(0, 60)
            rows.append((q, rank, score, f"d{rng.randrange(3)}", a, a + rng.randrange(0, 30), rng.randrange(1, 12)))
    rows += [(50, 1, None, "d", 0, 5, 1), (50, 2, 1.0, None, 0, 5, 1), (51, 1, 3.0, "d", 0, 10, 1000), (51, 2, 2.0, "d", 0, 10, 2)]
    got = pack_context(spark.createDataFrame(rows, RANKED).repartition(3), budget, least).collect()
    made = [(r["query_id"], r["rank"], r["document_id"], r["start"], r["end"], frozenset(p for x in r["parts"] for p in range(x["start"], x["end"])), r["tokens"], r["used"]) for r in got]
    assert sorted(made, key=lambda r: r[:2]) == brute(rows, budget, least)
    assert all(sum(x["end"] - x["start"] for x in r["parts"]) == len({p for x in r["parts"] for p in range(x["start"], x["end"])}) for r in got)


def test_limits(spark):
    empty = spark.createDataFrame([], RANKED)
    assert pack_context(empty, 10).count() == 0
    for budget, least in ((0, 0.5), (10, 2.0)):
        with pytest.raises(ValueError):
            pack_context(empty, budget, least)
