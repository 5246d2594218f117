import numpy as np
import pytest

from millrace.llm import embedding_dedup
from millrace.llm.embedding_dedup import CrossPolytope, embedding_components, first_met, hadamard, stars


def brute(ids, vectors, threshold=0.95):
    good = [k for k, v in enumerate(vectors) if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {k: set() for k in range(len(ids))}
    for i in good:
        for j in good:
            if i < j and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                a, b = a / np.abs(a).max(), b / np.abs(b).max()
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= threshold:
                    links[i].add(j)
                    links[j].add(i)
    part = {}
    for k in sorted(links, key=lambda k: ids[k]):
        if k not in part:
            todo = [k]
            while todo:
                x = todo.pop()
                if x not in part:
                    part[x] = ids[k]
                    todo += links[x]
    return sorted((ids[k], len(links[k]), part[k], ids[k] == part[k]) for k in links)


def near(rng, v, cosine):
    g = rng.normal(size=len(v))
    g -= (g @ v) / (v @ v) * v
    return cosine * v / np.linalg.norm(v) + np.sqrt(1 - cosine**2) * g / np.linalg.norm(g)


def data(rng, d=24):
    out = [rng.normal(size=d) for _ in range(60)]
    for v in out[:12]:
        out += [near(rng, v, c) for c in (0.999, 0.98, 0.953, 0.94)]
    hot = rng.normal(size=d)
    out += [near(rng, hot, 0.995) for _ in range(70)] + [hot] * 30 + [hot * 1e200, hot * 1e-200]
    return [v.tolist() for v in out]


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)  # so that buckets have several blocks
    monkeypatch.setattr(embedding_dedup, "HOT_COPIES", 4)
    monkeypatch.setattr(embedding_dedup, "TILE", 5)
    monkeypatch.setattr(embedding_dedup, "FEW", 9)
    vectors = data(np.random.default_rng(2))
    vectors += [None, [], [0.0] * 24, [float("nan")] * 24, [None, 1.0], [float("inf")] + [0.0] * 23, vectors[0][:10], vectors[0][:10]]
    ids = [int(i) for i in np.random.default_rng(3).permutation(len(vectors))]
    table = spark.createDataFrame([(i, v, 1) for i, v in zip(ids, vectors)], "vec_id long, embedding array<double>, vector int")
    got = sorted(tuple(r) for r in embedding_components(table).collect())
    want = brute(ids, vectors)
    assert got == want and sum(r[1] for r in want) > 500


def test_repeated_and_missing_ids(spark):
    rows = [(3, [1.0, 0.0]), (3, [1.0, 0.0]), (1, [1.0, 0.01]), (None, [1.0, 0.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {tuple(r) for r in embedding_components(table).collect()}
    assert got == {(3, 2, 1, False), (1, 2, 1, True), (None, 0, None, False)}
    assert embedding_components(table.limit(0)).count() == 0


@pytest.mark.parametrize("width", [16, 64, 384])
def test_recall_at_the_threshold(width):
    rng = np.random.default_rng(4)
    a = rng.normal(size=(1500, width))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = np.stack([near(rng, v, 0.9501) for v in a])
    h = CrossPolytope(width, 16, 3, 4, 7)
    (own, near_a), (other, near_b) = h.keys(a), h.keys(b)
    met = (own == other).any(1) | (own[:, :, None] == near_b).any((1, 2)) | (other[:, :, None] == near_a).any((1, 2))
    assert met.mean() > 0.99


def test_a_pair_counts_in_one_bucket():
    rng = np.random.default_rng(5)
    tables, probes, n = 5, 2, 40
    own = rng.integers(0, 6, size=(n, tables)).astype(np.uint32)
    reach = rng.integers(0, 6, size=(n, tables, probes)).astype(np.uint32)
    seen = {}
    for t in range(tables):
        for key in range(6):
            a, b = np.triu_indices(n, 1)
            at = (own[:, t] == key), (own[:, t] == key) | (reach[:, t] == key).any(1)
            meet = (at[0][a] & at[1][b]) | (at[0][b] & at[1][a])
            a, b = a[meet], b[meet]
            for k in first_met((t << 32) | key, a, b, own, reach):
                seen[int(a[k]), int(b[k])] = seen.get((int(a[k]), int(b[k])), 0) + 1
    met = {(i, j) for i in range(n) for j in range(i + 1, n) if any(own[i, t] == own[j, t] or own[j, t] in reach[i, t] or own[i, t] in reach[j, t] for t in range(tables))}
    assert set(seen) == met and set(seen.values()) == {1}


def test_parts():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(hadamard(hadamard(x)), x)
    assert stars(6, np.array([5, 3, 1]), np.array([3, 1, 4])).tolist() == [0, 1, 2, 1, 1, 1]
