import random
from datetime import datetime, timedelta

import pytest

from millrace.operators.validity import as_of

DAY = datetime(2020, 1, 1)


def brute(rows, versions):
    out = []
    for i, k, t in rows:
        best = None
        for vk, s, e, label in versions:
            if vk is not None and vk == k and s is not None and t is not None and s <= t:
                rank = (s, e is None, e or datetime.min, label)
                best = max(best, rank) if best else rank
        out.append((i, best[3] if best and (best[1] or t <= best[2]) else None))
    return sorted(out)


@pytest.mark.parametrize("slice_days, seed", [(1, 1), (7, 2), (64, 3), (5000, 4)])
def test_equals_brute_force(spark, slice_days, seed):
    rng = random.Random(seed)
    day = lambda: DAY + timedelta(days=rng.randrange(-400, 900), hours=rng.choice([0, 0, 7]))
    keys = ["hot"] * 12 + [f"k{n}" for n in range(12)]
    versions = []
    for n in range(300):
        start = day()
        versions.append((rng.choice(keys), start, rng.choice([None, start + timedelta(days=rng.randrange(0, 200)), start]), f"v{n}"))
    versions += [("same", DAY, None, "open"), ("same", DAY, DAY + timedelta(days=3), "short"), (None, DAY, None, "lost"), ("k1", None, None, "never")]
    rows = [(n, rng.choice(keys + ["same", "without"]), day()) for n in range(1500)] + [(5000, None, DAY), (5001, "hot", None), (5002, "same", DAY), (5003, "same", DAY - timedelta(seconds=1))]
    left = spark.createDataFrame(rows, "id long, k string, t timestamp").repartition(4)
    right = spark.createDataFrame(versions, "k string, start timestamp, end timestamp, label string").repartition(3)
    got = as_of(left, right, "k", "t", keep=("label",), slice_days=slice_days)
    assert got.columns == ["id", "k", "t", "label"]
    assert sorted((r["id"], r["label"]) for r in got.collect()) == brute(rows, versions)


def test_no_range_join_and_empty_sides(spark):
    left = spark.createDataFrame([(1, "a", DAY)], "id long, k string, t timestamp")
    right = spark.createDataFrame([("a", DAY, None, "x")], "k string, start timestamp, end timestamp, label string")
    plan = as_of(left, right, "k", "t", keep=("label",))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
    assert [r["label"] for r in as_of(left, right.limit(0), "k", "t", keep=("label",)).collect()] == [None]
    assert as_of(left.limit(0), right, "k", "t", keep=("label",)).count() == 0
