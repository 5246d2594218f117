import math
import re
from collections import Counter

from millrace import queries


def brute_top10(docs, items):
    """Pieces of 1800 characters ranked with every word of each item."""
    pieces = {f"{i}:{at}": t[at : at + 1800] for i, t in docs for at in range(0, len(t), 1800)}
    counts = {c: Counter(re.findall(r"\w+", t.casefold())) for c, t in pieces.items()}
    average = sum(sum(n.values()) for n in counts.values()) / len(counts)
    df = Counter(w for n in counts.values() for w in n)
    out = []
    for item, text in items:
        terms = set(re.findall(r"\w+", text.casefold()))
        scores = {}
        for c, n in counts.items():
            if hits := terms & set(n):
                size = 1.2 * (0.25 + 0.75 * sum(n.values()) / max(1, average))
                scores[c] = round(sum(math.log(1 + (len(counts) - df[w] + 0.5) / (df[w] + 0.5)) * n[w] * 2.2 / (n[w] + size) for w in hits), 9)
        best = sorted(scores, key=lambda c: (-scores[c], c))[:10]
        out += [(item, rank, c, round(scores[c], 6)) for rank, c in enumerate(best, 1)]
    return out


def test_whole_items_are_queries(spark, tmp_path):
    head = "these opening words of the item are the same in every text of it"
    assert len(head) > 60
    docs = [(i, f"{head} " + " ".join(f"w{(i * k) % 17}" for k in range(1, 9))) for i in range(6)] + [(20, "rare tail ending"), (21, "x " * 2000)]
    items = [(1, f"{head} w3 w5 rare tail"), (2, f"{head} w2 W7 ending"), (3, "short x")]
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(tuple(r) for r in queries.QUERIES["bm25_top10"](spark, str(tmp_path)).collect())
    want = sorted(brute_top10(docs, items))
    assert [r[:3] for r in got] == [r[:3] for r in want] and all(abs(a[3] - b[3]) < 2e-6 for a, b in zip(got, want))
    assert (1, "20:0") in [(r[0], r[2]) for r in got]  # it has words of the item only after character 60
