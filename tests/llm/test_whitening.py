import math

import numpy as np
import pytest

from millrace.llm import whitening
from millrace.llm.whitening import Moments, whiten


def brute(rows):
    kept = [(i, [math.floor(256.0 * c) for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({tuple(x) for _, x in kept})
    n, d = len(fit), len(fit[0])
    sums = [sum(x[k] for x in fit) for k in range(d)]
    centred = np.array([[float(x[k] - sums[k] / n) for k in range(d)] for x in fit])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    deviation = [sum((n * x[k] - sums[k]) ** 2 for k in range(d)) for _, x in kept]
    z = [[float(np.dot(np.array(x) - np.array(sums) / n, vectors[:, -c])) / math.sqrt(values[-c]) for c in range(1, 5)] for _, x in kept]
    return kept, n, deviation, z, [values[-c] / values.sum() for c in range(1, 5)]


def planted(m=700, d=12, seed=3):
    rng = np.random.default_rng(seed)
    base = (rng.normal(size=(m, d)) * np.linspace(3, 0.2, d) + rng.normal(size=d)).astype(np.float32)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[0][1]) for i in range(m // 2)]  # one vector holds a third of all rows
    return rows + [(5000, None), (5001, [math.nan] * d), (5002, [math.inf] + [0.0] * (d - 1)), (5003, [None] + [0.0] * (d - 1)), (5004, []), (None, rows[1][1]), (7, rows[7][1])]


def test_equals_brute_force(spark):
    rows = planted()
    frame = spark.createDataFrame([(i, v, 1.0) for i, v in rows], "vec_id long, embedding array<float>, component double").repartition(7)
    got = whiten(frame).collect()
    kept, n, deviation, z, explained = brute(rows)
    assert len(got) == 4 * len(kept)
    by = {}
    for r in got:
        by.setdefault((r["vec_id"], r["component"]), []).append(r)
    sign = {}
    for (i, _), dev, row in zip(kept, deviation, z):
        for c in range(4):
            found = by[i, c + 1]
            r = found[0]
            assert all(x["deviation"] == r["deviation"] and x["whitened"] == r["whitened"] for x in found)
            assert r["n"] == n and r["deviation"] == dev and r["identity_error"] < 1e-10
            assert abs(r["explained"] - explained[c]) < 1e-10 * explained[c]
            if abs(row[c]) > 1e-3:
                sign.setdefault(c, math.copysign(1, row[c] * r["whitened"]))
            assert abs(sign.get(c, 1) * r["whitened"] - row[c]) < 1e-8 * max(1, abs(row[c]))


def test_far_from_zero_and_large_values_stay_exact(spark):
    rng = np.random.default_rng(5)
    values = 2.0**40 + rng.integers(-4, 5, (300, 5)) / 256
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(values)]
    got = {(r["vec_id"], r["component"]): r for r in whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)).collect()}
    kept, n, deviation, _, explained = brute(rows)
    for (i, _), dev in zip(kept, deviation):
        assert got[i, 1]["deviation"] == dev
    assert all(abs(got[0, c + 1]["explained"] - explained[c]) < 1e-4 * explained[c] for c in range(4))
    assert got[0, 1]["identity_error"] < 1e-4


def test_merging_equals_one_pass():
    rng = np.random.default_rng(1)
    rows = rng.integers(-1000, 1000, (1000, 6)) + 10**6
    whole, parts = Moments.of(rows), [Moments.of(rows[a:b]) for a, b in ((0, 1), (1, 400), (400, 403), (403, 1000))]
    merged = (parts[0].merged(parts[1])).merged(parts[2].merged(parts[3]))
    assert merged.n == whole.n and list(merged.sums) == list(whole.sums)
    assert np.allclose(merged.mean, whole.mean, rtol=1e-14) and np.allclose(merged.scatter, whole.scatter, rtol=1e-11, atol=1e-4)


@pytest.mark.parametrize("rows, components, null", [([(1, [1.0, 2.0])], 2, True), ([(1, [0.5, 1.0]), (2, [0.75, 1.0])], 2, False), ([(1, [1.0])] * 3, 1, True)])
def test_without_variance(spark, rows, components, null):
    got = sorted(whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect(), key=lambda r: (r["vec_id"], r["component"]))
    assert len(got) == components * len(rows)
    assert (got[0]["whitened"] is None) == null and (got[0]["identity_error"] is None) == null
    if not null:
        assert [round(abs(r["whitened"]), 12) for r in got if r["component"] == 1] == [1, 1] and all(r["whitened"] is None for r in got if r["component"] == 2)


def test_lengths_and_empty(spark):
    frame = spark.createDataFrame([(1, [1.0, 2.0]), (2, [3.0, 1.0]), (3, [1.0])], "vec_id string, embedding array<float>")
    assert {r["vec_id"] for r in whiten(frame).collect()} == {"1", "2"}
    assert whiten(frame.limit(0)).count() == 0 and whiten(frame.where("vec_id = '9'")).columns[0] == "vec_id"
    assert whitening.SCALE == 256
