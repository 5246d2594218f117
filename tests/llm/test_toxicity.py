import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import textvec as tv
from millrace.llm.levenshtein import LexiconAutomaton, Term
from millrace.llm.toxicity import ToxicityModel, fit_toxicity, held_out, is_quoted, score_toxicity


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, left = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(left[j] + 1, row[j - 1] + 1, left[j - 1] + (x != y)))
    return row[-1]


def brute(term, word):
    """The fewest edits within the term's, the first byte being kept; None if there are more."""
    if not word or word[0] != term.text[0]:
        return None
    ends = range(1, len(word) + 1) if term.stem else [len(word)]
    best = min(distance(term.text[1:], word[1:e]) for e in ends)
    return best if best <= term.edits else None


words = st.text(alphabet="abcé", min_size=1, max_size=7).map(str.encode)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.builds(Term, words, st.booleans(), st.integers(0, 2)), min_size=1, max_size=4), st.lists(words, min_size=1, max_size=6))
def test_automaton_equals_edit_distance(terms, texts):
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts = np.concatenate([[0], ends[:-1]])
    got = {w: e for w, _, e in zip(*(x.tolist() for x in LexiconAutomaton(terms).match(data, starts, ends)))}
    for i, text in enumerate(texts):
        hits = [e for e in (brute(t, text) for t in terms) if e is not None]
        assert got.get(i) == min(hits, default=None)


def test_quotation():
    raw = 'he said "you idiot" loudly, idiot'.encode()
    assert is_quoted(raw, 13, 18, 0, len(raw), 64)
    assert not is_quoted(raw, 28, 33, 0, len(raw), 64)


def rows(n):
    rng = np.random.default_rng(0)
    common = ["der", "la", "word", "and", "tree", "lamp", "green"]
    for i in range(n):
        text = " ".join(rng.choice(common, 30))
        toxic = int(i % 4 == 0)
        if toxic:
            text = " ".join(rng.choice(common, 5)) + f" grumblefox{'' if i % 8 else 'es'} " + text
        yield i, text, toxic


def test_learns_a_term_and_its_misspelling(spark):
    data = list(rows(400))
    docs = spark.createDataFrame([(i, t, i) for i, t, _ in data], "doc_id long, text string, score int")
    labels = spark.createDataFrame([(i, y) for i, _, y in data] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = fit_toxicity(docs, labels)
    assert any(t.text.startswith(b"grum") for t in model.terms)
    scored = score_toxicity(docs, model).withColumn("h", held_out()).collect()
    truth = {i: y for i, _, y in data}
    assert any(r["h"] for r in scored) and all(r["predicted"] == truth[r["doc_id"]] for r in scored if r["h"])
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "you grunblefox und " * 3), (3, "la lamp " * 20_000)], "doc_id long, text string")
    got = [r["predicted"] for r in score_toxicity(odd, model).orderBy("doc_id", "score").collect()]
    assert got == [0, 0, 0, 1] and score_toxicity(docs.limit(0), model).count() == 0


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert score_toxicity(docs, fit_toxicity(docs, none)).first()["score"] == 0.0


def test_every_score_equals_a_word_by_word_version(spark):
    import math
    import re

    rng = np.random.default_rng(7)
    model = ToxicityModel([Term(b"grumble", True, 1), Term(b"snark", False, 1), Term("fußel".encode(), False, 0), Term(b"zank", True, 0)], np.array([-2.0, 3.0, 1.5, 0.25]), 0.1, 24)
    said = ["grumble", "Grumbles", "grumbel", "grmble", "snark", "snarks", "snerk", "snrak", "FUßEL", "fussel", "zankapfel", "zan", "tree", "lamp", '"grumble"', "“snark”", "'zank'", '"', "é", "x1"]
    texts = [" ".join(rng.choice(said, rng.integers(0, 14))) for _ in range(200)] + ["", None, "grumble" * 50, "  ", '"' + "grumble " * 30 + '"']

    def score(text):
        raw, counts = (text or "").lower().encode(), [0, 0, 0]
        for w in re.finditer(rb"[0-9a-z\x80-\xff]+", raw):
            edits = min((e for e in (brute(t, w[0]) for t in model.terms) if e is not None), default=None)
            if edits is not None:
                counts[2 if is_quoted(raw, w.start(), w.end(), 0, len(raw), model.window) else min(edits, 1)] += 1
        return 1 / (1 + math.exp(-(model.weights[0] + sum(a * math.log1p(n) for a, n in zip(model.weights[1:], counts)))))

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: (r["score"], r["predicted"]) for r in score_toxicity(docs, model).collect()}
    want = {i: score(t) for i, t in enumerate(texts)}
    assert all(abs(got[i][0] - want[i]) < 1e-12 and got[i][1] == (want[i] >= 0.5) for i in want) and len({round(x, 6) for x in want.values()}) > 30


def test_a_row_labelled_both_ways_counts_as_toxic(spark):
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows(200)] + [(i, 0) for i, _, y in rows(200) if y], "doc_id long, toxic int")
    once = spark.createDataFrame([(i, y) for i, _, y in rows(200)], "doc_id long, toxic int")
    twice, plain = fit_toxicity(docs, labels), fit_toxicity(docs, once)
    assert twice.terms == plain.terms and np.allclose(twice.weights, plain.weights)
