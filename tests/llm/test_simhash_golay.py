import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from millrace.llm.simhash_golay import PAIRS, fingerprint, golay_indices, keep_one, near_pairs, neighbour_indices, simhash_components, with_hex


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", re.sub(rb"[A-Z]", lambda m: m[0].lower(), text.encode()))
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    names = {i: i for i in prints}

    def root(i):
        while names[i] != i:
            i = names[i]
        return i

    ids = sorted(prints)
    for i in ids:
        for j in ids:
            if j < i and bin(prints[i] ^ prints[j]).count("1") <= 3:
                a, b = sorted((root(i), root(j)))
                names[b] = a
    return {i: root(i) for i in ids}


def test_golay_code_is_perfect_and_keys_meet():
    index = golay_indices()
    around = neighbour_indices(index)
    rng = np.random.default_rng(0)
    for w in rng.integers(0, 1 << 16, 500).tolist():
        for b in range(16):
            assert index[w] in around[w ^ (1 << b)]
    assert len(PAIRS) == 12 and max(map(len, around)) <= 6


def test_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-(1 << 63), 1 << 63, 60)
    prints = set(base.tolist())
    for f in base[:40].tolist():
        for _ in range(5):
            g = f & ((1 << 64) - 1)
            for b in rng.choice(64, rng.integers(1, 6), replace=False).tolist():
                g ^= 1 << b
            prints.add(g - (1 << 64) if g >> 63 else g)
    got = {(r["a"], r["b"]) for r in near_pairs(spark.createDataFrame([(p,) for p in prints], "simhash long")).collect()}
    want = {(a, b) for a in prints for b in prints if a < b and bin((a ^ b) & ((1 << 64) - 1)).count("1") <= 3}
    assert got == want and len(want) > 50


def test_components_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}É" for i in range(60)]
    texts = []
    for _ in range(12):
        words = rng.choice(vocabulary, 120).tolist()
        for k in range(4):
            copy = list(words)
            for at in rng.choice(120, k, replace=False):
                copy[at] = "Changed"
            texts.append("\t".join(copy))
    texts += ["", None, "one", "ONE", "one two", texts[0], "a b c " * 30_000]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, simhash string")
    got = {r["doc_id"]: r for r in with_hex(simhash_components(docs)).collect()}
    prints = {i: brute_print(t or "") for i, t in enumerate(texts)}
    assert {i: r["fingerprint"] for i, r in got.items()} == {i: f"{p:016x}" for i, p in prints.items()}
    want = brute_components(prints)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert sorted(r["doc_id"] for r in keep_one(docs).collect()) == sorted(i for i in want if want[i] == i)


def test_empty_and_repeated(spark):
    docs = spark.createDataFrame([(5, "same text here"), (5, "same text here"), (2, "same text here")], "doc_id long, text string")
    assert [r["component_id"] for r in simhash_components(docs).collect()] == [2, 2, 2]
    assert simhash_components(docs.limit(0)).count() == 0
    assert fingerprint([]) == 0
