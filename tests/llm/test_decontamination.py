import hashlib
import re

import numpy as np
import pytest

from millrace.llm import decontamination
from millrace.llm.decontamination import bit_table, decontaminate, may_be

COLUMNS = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def words(text):
    low = re.sub(r"[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(docs, items, window=10):
    runs = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n and item is not None else 0):
            runs.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for i, text in docs:
        w, hit, found = words(text), set(), set()
        for n in {len(r) for r in runs}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in runs:
                    found |= runs[tuple(w[k : k + n])]
                    hit |= set(range(k, k + n))
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, len(hit) > 0))
    return sorted(out, key=str)


def corpus(seed):
    rng = np.random.default_rng(seed)
    letters = ["alpha", "Beta", "gämma", "d1", "e", "f-g", "Öl", "zeta", "eta.", "x"]
    some = lambda n: " ".join(rng.choice(letters[: int(rng.integers(2, 10))], n))
    items = [(k, some(int(n))) for k, n in enumerate([25, 12, 10, 9, 3, 1, 0, 40, 11, 2, 30])]
    items += [(3, items[0][1]), (4, items[0][1]), (None, some(20)), (90, None), (91, "a a a a a a a a a a a a a a a a a a"), (92, "Only-Here once")]
    docs = [(k, some(int(rng.integers(0, 60)))) for k in range(40)]
    docs += [(100 + k, some(5) + " , " + (t or "") + "; " + some(4)) for k, (_, t) in enumerate(items)]
    docs += [(7, docs[3][1]), (7, docs[41][1]), (None, docs[40][1]), (200, None), (201, ""), (202, "  --  "), (203, "a " * 60), (204, "tree " * 50_000 + items[1][1] + " tree" * 1000)]
    docs += [(300 + k, docs[40][1]) for k in range(30)]
    return docs, items


@pytest.mark.parametrize("seed, dealt", [(1, False), (2, True), (3, True)])
def test_equals_brute_force(spark, monkeypatch, seed, dealt):
    if dealt:  # every key hot, no hit sent
        for name, value in (("HOT_TOKENS", 2), ("HOT_TEXTS", 2), ("MOST_SENT", 0)):
            monkeypatch.setattr(decontamination, name, value)
    docs, items = corpus(seed)
    got = decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    want = brute(docs, items)
    assert sorted((tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in got.collect()), key=str) == want
    assert 30 < sum(r[-1] for r in want)


def test_no_short_items(spark):
    docs, items = corpus(4)
    items = [(i, t) for i, t in items if len(words(t)) >= 10]
    got = decontaminate(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in got.collect()), key=str) == brute(docs, items)


def test_other_columns_and_empty_tables(spark):
    text = "one two three four five six seven eight nine ten eleven"
    docs = spark.createDataFrame([(1, text, 5, "k", 2)], "doc_id long, text string, items int, run string, n int")
    bench = spark.createDataFrame([("b", text, 1, 2), ("a", "ONE, two", 3, 4)], "item_id string, text string, n int, token int")
    row = decontaminate(docs, bench, carry=("doc_id", "run", "n")).first()
    assert (row["run"], row["n"], row["n_hit"], row["items"]) == ("k", 2, 11, ["a", "b"])
    assert row["items_sha256"] == hashlib.sha256(b"a,b").hexdigest()
    assert decontaminate(docs.limit(0), bench).count() == 0
    assert decontaminate(docs, bench.limit(0)).first()["n_hit"] == 0


def test_bits_have_no_false_negatives(spark):
    values = np.random.default_rng(0).integers(-(2**63), 2**63 - 1, 5000)
    table = bit_table(spark.createDataFrame([(int(v),) for v in values], "h long"), "h")
    assert len(may_be(table, values.view(np.uint64))) == 5000
    others = np.random.default_rng(1).integers(0, 2**63 - 1, 100_000).view(np.uint64)
    assert len(may_be(table, others)) < 3000
