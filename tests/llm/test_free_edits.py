import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm.levenshtein import LexiconAutomaton, Term
from millrace.llm.toxicity import fit_toxicity, score_toxicity
from test_toxicity import brute as first_kept

words = st.text(alphabet="abcé", min_size=1, max_size=7).map(str.encode)


def distance(a, b):
    """Insertions, deletions, substitutions and swaps of neighbours."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            least = min(rows[-1][j] + 1, row[-1] + 1, rows[-1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                least = min(least, rows[-2][j - 2] + 1)
            row.append(least)
        rows.append(row)
    return rows[-1][-1]


def brute(term, word):
    if not term.free:
        return first_kept(term, word)
    best = min(distance(term.text, word[:e]) for e in (range(1, len(word) + 1) if term.stem else [len(word)]))
    return best if best <= term.edits else None


def matches(terms, texts):
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    found = LexiconAutomaton(terms).match(data, np.concatenate([[0], ends[:-1]]), ends)
    return {w: e for w, _, e in zip(*(x.tolist() for x in found))}


@settings(max_examples=600, deadline=None)
@given(st.lists(st.builds(Term, words, st.booleans(), st.integers(0, 2), st.booleans()), min_size=1, max_size=4), st.lists(words, min_size=1, max_size=6))
def test_free_terms_equal_edit_distance(terms, texts):
    got = matches(terms, texts)
    for i, text in enumerate(texts):
        hits = [e for e in (brute(t, text) for t in terms) if e is not None]
        assert got.get(i) == min(hits, default=None)


def test_first_bytes_and_swaps():
    texts = [b"idiot", b"1diot", b"ldiot", b"diot", b"xidiot", b"idoit", b"diiot", b"1doit", b"scvm", b"cum"]
    assert matches([Term(b"idiot", False, 1, True), Term(b"scum", False, 1, True)], texts) == {0: 0, 1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 6: 1, 8: 1, 9: 1}


def test_misspelled_toxic_texts_are_found(spark):
    rng = np.random.default_rng(0)
    common = ["der", "la", "word", "and", "tree", "lamp", "green"]
    rows = []
    for i in range(400):
        text = rng.choice(common, 30).tolist()
        if i % 4 == 0:
            for _ in range(3):
                text.insert(int(rng.integers(30)), "zqum" if i % 8 else "grumblefox")
        rows.append((i, " ".join(text), int(i % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = fit_toxicity(docs, docs)
    odd = ["9rumblefox", "rumblefox", "xgrumblefox", "grumblefxo", "rgumblefox", "zqvm", "qzum", "lamp"]
    texts = spark.createDataFrame([(i, f"la {w} der {w} and {w} tree {w} la {w}") for i, w in enumerate(odd)], "doc_id long, text string")
    assert [r["predicted"] for r in score_toxicity(texts, model).orderBy("doc_id").collect()] == [1] * 7 + [0]
