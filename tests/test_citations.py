import random

from millrace.operators.citations import aligned, audit_citations

ANSWERS = "answer_id long, sentence_no int, sentence string, document_id string, start int, end int"


def test_local_alignment():
    given = "the quick brown fox jumps over the lazy dog".split()
    assert aligned("quick brown fox".split(), given) == (3, 1, 3)
    assert aligned("quick brown red fox".split(), given) == (3, 1, 3)  # one word more
    assert aligned("brown jumps over".split(), given) == (3, 2, 5)  # one word left out
    assert aligned("quick brown cat jumps over".split(), given) == (4, 1, 5)  # one word changed
    assert aligned(["nothing"], given)[0] == 0 and aligned([], given)[0] == 0 and aligned(["a"], [])[0] == 0


def best_by_all_pairs(sentence, words):
    """The best local alignment's score, by the textbook table."""
    table = [[0] * (len(words) + 1)]
    for w in sentence:
        row = [0]
        for k, x in enumerate(words):
            row.append(max(0, table[-1][k] + (2 if w == x else -1), table[-1][k + 1] - 1, row[-1] - 1))
        table.append(row)
    return max(map(max, table))


def test_alignment_equals_the_table():
    rng = random.Random(0)
    for _ in range(300):
        words = [rng.choice("abcd") for _ in range(rng.randrange(1, 14))]
        sentence = [rng.choice("abcde") for _ in range(rng.randrange(1, 9))]
        hits, first, last = aligned(sentence, words)
        score = best_by_all_pairs(sentence, words)
        assert (hits == 0) == (score == 0)
        if score:
            # the stretch alone reaches the score with these hits
            assert best_by_all_pairs(sentence, words[first : last + 1]) == score and hits <= min(len(sentence), last - first + 1)


def test_supported_misplaced_and_invented(spark):
    rng = random.Random(1)
    words = [f"{a}{b}" for a in "bcdfghjk" for b in ("an", "el", "io", "or", "us", "it")]
    texts = {f"d{n}": " ".join(rng.choice(words) for _ in range(400)) for n in range(30)}
    answers, want = [], {}
    for n in range(90):
        doc, other = f"d{n % 30}", f"d{(n + 7) % 30}"
        own = texts[doc].split()
        at = rng.randrange(20, 360)
        said = own[at : at + 14]
        start = len(" ".join(own[:at])) + 1
        end = start + len(" ".join(said))
        if n % 3 == 0:
            changed = list(said)
            changed[5] = "different"
            answers.append((n, 0, " ".join(changed).upper(), doc, start - 20, end + 20))
            want[n] = ("supported", doc)
        elif n % 3 == 1:
            where = (other, 0, 300) if n % 2 else (doc, *((0, start - 10) if at > 200 else (end + 10, end + 400)))
            answers.append((n, 0, " ".join(said), *where))
            want[n] = ("misplaced", doc)
        else:
            answers.append((n, 0, " ".join(rng.choice(words) for _ in range(14)), doc, 0, 500))
            want[n] = ("invented", None)
    answers += [(500, 0, "", "d1", 0, 50), (501, 0, None, None, None, None), (502, 0, " ".join(texts["d2"].split()[:9]), None, None, None), (503, 1, " ".join(texts["d3"].split()[:9]), "absent", 0, 10)]
    want |= {500: ("invented", None), 501: ("invented", None), 502: ("misplaced", "d2"), 503: ("misplaced", "d3")}
    docs = spark.createDataFrame(list(texts.items()) + [("null", None), ("empty", "")], "document_id string, text string").repartition(3)
    got = audit_citations(spark.createDataFrame(answers, ANSWERS), docs).collect()
    assert {int(r["answer_id"]): (r["verdict"], r["document_id"]) for r in got} == want and len(got) == len(want)
    assert all(r["share"] >= 0.9 for r in got if r["verdict"] == "supported")


def test_empty(spark):
    answers, docs = spark.createDataFrame([], ANSWERS), spark.createDataFrame([], "document_id string, text string")
    assert audit_citations(answers, docs).count() == 0
    assert [r["verdict"] for r in audit_citations(spark.createDataFrame([(1, 0, "some words here", "d", 0, 5)], ANSWERS), docs).collect()] == ["invented"]
