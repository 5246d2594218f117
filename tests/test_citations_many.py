import random

from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from millrace.operators.citations import aligned, aligned_many, audit_citations


def test_many_pairs_align_as_each_does_alone():
    rng = random.Random(3)
    asked = [[rng.choice("abcd") for _ in range(rng.choice([0, 1, 4, 14]))] for _ in range(1200)]
    given = [[rng.choice("abcde") for _ in range(rng.choice([0, 1, 9, 56]))] for _ in asked]
    assert list(zip(*(x.tolist() for x in aligned_many(asked, given)))) == [aligned(*p) for p in zip(asked, given)]


def test_copies_are_judged_by_what_each_answer_cites(spark):
    text = " ".join(f"word{k}" for k in range(60))
    docs = spark.createDataFrame([("a", text), ("b", text), ("c", "nothing of it"), ("d", "before " + text)], "document_id string, text string")
    said = " ".join(f"word{k}" for k in range(20, 32))
    rows = [("1", "a", 0, 400), ("2", "b", 0, 400), ("3", "a", 0, 20), ("4", "c", 0, 10), ("5", None, None, None), ("6", "a", 9, 9)]
    answers = spark.createDataFrame([(i, 0, said, d, s, e) for i, d, s, e in rows], "answer_id string, sentence_no int, sentence string, document_id string, start int, end int")
    got = {r["answer_id"]: (r["verdict"], r["document_id"], r["first"], r["last"]) for r in audit_citations(answers, docs).collect()}
    assert got == {"1": ("supported", "a", 20, 31), "2": ("supported", "b", 20, 31), "3": ("misplaced", "a", 20, 31)} | {i: ("misplaced", "b", 20, 31) for i in "456"}


def test_a_common_passage_is_not_aligned_with_all_that_hold_it(spark, monkeypatch):
    rng, common = random.Random(5), [f"line{k}" for k in range(40)]
    docs = []
    for k in range(60):
        at, own = rng.randrange(0, 50), [f"own{k}x{i}" for i in range(50)]
        docs.append((f"d{k}", " ".join(own[:at] + common + own[at:])))
    texts = dict(docs)
    rows = [(f"a{k}", 0, " ".join(texts[f"d{k}"].split()[rng.randrange(0, 60) :][:14]), f"d{k}", 0, 10_000) for k in range(60)]
    rows += [(f"c{k}", 0, " ".join([f"own{k}x3", *common[k % 20 :][:13]]), None, None, None) for k in range(5)]
    pairs, real = [], DataFrame.mapInArrow

    def counted(frame, *rest):
        each = F.sum(F.size("listed")) if "listed" in frame.columns else F.count(F.lit(1))
        pairs.append(frame.agg(each).first()[0] or 0)
        return real(frame, *rest)

    monkeypatch.setattr(DataFrame, "mapInArrow", counted)
    answers = spark.createDataFrame(rows, "answer_id string, sentence_no int, sentence string, document_id string, start int, end int")
    got = {r["answer_id"]: r for r in audit_citations(answers, spark.createDataFrame(docs, "document_id string, text string")).collect()}
    best = {}
    for answer, _, said, cited, _, _ in rows:
        found = [(n / len(said.split()), d == cited, -first, d) for d, t in docs for n, first, _ in [aligned(said.split(), t.split())]]
        best[answer] = max((f for f in found if f[1]), default=None) or max((f[0], False, *f[2:]) for f in found)
    for answer, (share, own, less, doc) in best.items():
        assert (got[answer]["share"], got[answer]["document_id"], got[answer]["first"]) == (share, doc, -less) and (got[answer]["verdict"] == "supported") == own
    assert 65 <= sum(pairs) < 1200, pairs
