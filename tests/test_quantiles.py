import math
import random

from pyspark.sql import functions as F

from millrace.operators import quantiles


def brute(values, share=None):
    values = sorted(values)
    return values[len(values) // 2] if share is None else values[min(len(values) - 1, math.ceil(share * len(values)) - 1)]


def groups(seed=1):
    rng = random.Random(seed)
    out = {
        "hot": [round(rng.expovariate(0.1), 2) for _ in range(20_000)],  # two thirds of all rows
        "ties": [7.0] * 4000 + [8.0] * 3,
        "wide": [rng.choice([-1, 1]) * 10.0 ** rng.randrange(-300, 300) for _ in range(999)],
        "close": [1.0 + k * 2.0**-52 for k in range(800)],
        "signs": [-3.5, -0.0, 0.0, 2.0, 1e308, -1e308],
        "ends": [float("-inf"), 5.0, float("inf")],
        "one": [4.25],
        None: [3.0, 1.0, 2.0],
    }
    return {k: rng.sample(v, len(v)) for k, v in out.items()}


def test_equals_sorting(spark):
    data = groups()
    rows = [(k, v) for k, vs in data.items() for v in vs] + [("one", None), ("one", float("nan")), ("empty", None)]
    frame = spark.createDataFrame(rows, "kind string, value double").repartition(6)
    told = []
    ranks = {"p50": quantiles.median_rank, "p95": quantiles.nearest_rank(0.95), "least": lambda n: F.lit(0), "most": lambda n: n - 1}
    got = {r["kind"]: r for r in quantiles.order_statistics(frame, "value", ranks, ("kind",), told).collect()}
    assert got.keys() == data.keys()
    for kind, values in data.items():
        assert (got[kind]["p50"], got[kind]["p95"], got[kind]["least"], got[kind]["most"]) == (brute(values), brute(values, 0.95), min(values), max(values)), kind
    assert len(told) <= 8 and told[-1] == 0


def test_no_group_is_ordered_and_all_rows_are_one_group(spark):
    frame = spark.range(10_001).select((F.col("id") * 37 % 10_001).cast("double").alias("value"))
    made = quantiles.latency_percentiles(frame, "value")
    assert [tuple(r) for r in made.collect()] == [(5000.0, 9500.0)] and made.columns == ["p50", "p95"]
    assert quantiles.latency_percentiles(frame.limit(0), "value").count() == 0
