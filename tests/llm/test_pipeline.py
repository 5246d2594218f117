import hashlib
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from millrace.llm.packing import _cache
from test_secret_scan import brute as brute_secrets
from test_simhash_golay import brute_components, brute_print


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage makes of all that its predecessor kept, as pandas, with planted rows in the input."""
    source, here = "/root/testdata/sf0.001", tmp_path_factory.mktemp("in")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{source}/{name}.parquet").write.parquet(f"{here}/{name}.parquet")
    docs = spark.read.parquet(f"{source}/documents.parquet")
    first = docs.orderBy("doc_id").first()["text"]
    item = spark.read.parquet(f"{here}/benchmark.parquet").first()["text"]
    extra = [(9001, first, "en", "x", 1), (9002, "so it goes " + item + " and on", "en", "x", 1), (9003, 'the token = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff" is here', "en", "x", 1), (9004, None, None, None, None), (9005, "", "en", "x", 0)]
    docs.unionByName(spark.createDataFrame(extra, docs.schema)).write.parquet(f"{here}/documents.parquet")
    docs = spark.read.parquet(f"{here}/documents.parquet")
    out = [docs.toPandas()]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(here)).write.parquet(f"{here}/stage{k}")
        docs = spark.read.parquet(f"{here}/stage{k}")
        out.append(docs.toPandas())
    return out


def texts(frame):
    return {int(i): t or "" for i, t in zip(frame.doc_id, frame.text)}


def test_names_and_columns(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "secrets", "packing"]
    assert all(list(s.columns) == list(stages[0].columns) for s in stages[:5])


def test_toxicity_keeps_clean_documents(stages):
    before, after = texts(stages[0]), texts(stages[1])
    gone = set(before) - set(after)
    assert len(gone) < 0.3 * len(before) and {9001, 9004, 9005} <= set(after)


def test_one_of_each_group_stays(stages):
    before, after = texts(stages[1]), texts(stages[2])
    part = brute_components({i: brute_print(t) for i, t in before.items()})
    assert set(after) == {i for i in before if part[i] == i} and 9001 not in after


def test_contaminated_documents_go(stages):
    before, after = texts(stages[2]), texts(stages[3])
    assert 9002 in before and 9002 not in after and set(after) < set(before)


def test_no_secret_is_left(stages):
    before, after = texts(stages[3]), texts(stages[4])
    assert set(before) == set(after)
    for i, t in before.items():
        assert (after[i] == t) == (not brute_secrets(t)) or corpus_pipeline.REDACTED in after[i]
        assert not [s for s in brute_secrets(after[i]) if s[0] != "assign"]
    sizes = {int(i): n for i, n in zip(stages[4].doc_id, stages[4].n_chars)}
    assert after[9003].startswith("the [secret]") and sizes[9003] == len(after[9003])


def test_every_token_is_packed_once(stages):
    docs, pieces = texts(stages[4]), stages[5]
    tokenizer = _cache(None).tokenizer
    for i, t in docs.items():
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], "<u4")
        mine = pieces[pieces.doc_id == i].sort_values("start")
        assert mine.length.sum() == len(ids) == mine.doc_tokens.iloc[0]
        for r in mine.itertuples():
            assert zlib.crc32(ids[r.start : r.start + r.length].tobytes()) == r.ids_crc32
    full = pieces.groupby("sequence_id").length.sum()
    assert ((full == 2048) | (full & (full - 1) == 0)).all()


def test_digest_of_a_mark():
    assert re.fullmatch(r"\[\w+\]", corpus_pipeline.REDACTED) and hashlib.sha256(b"").hexdigest()


CLASHING = "doc_id long, text string, score double, predicted string, items array<int>, secrets string, `a.b` int, simhash int, component_id string, n_words int, row int, __in0 int"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    here = tmp_path_factory.mktemp("clash")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{here}/{name}.parquet")
    return str(here)


def row(i, text):
    return (i, text, -7.0, "p", [1, 2], "mine", 3, 4, "c", 5, 6, 7)


def run_stages(spark, docs, folder):
    for _, stage in corpus_pipeline.STAGES[:4]:
        made = stage(spark, docs, folder)
        assert made.schema.simpleString() == docs.schema.simpleString()
        docs = spark.createDataFrame(made.collect(), docs.schema)
    return docs


def test_other_columns_come_through_whatever_their_names(spark, tables):
    text = "one two three four five six seven eight nine ten " * 3
    given = [row(1, text + "password=hunter2hunter2"), row(2, text + "and a very different ending of the text here " * 5), row(3, None)]
    left = run_stages(spark, spark.createDataFrame(given, CLASHING), tables).collect()
    assert sorted(r["doc_id"] for r in left) == [1, 2, 3]
    assert all(tuple(r)[2:] == given[0][2:] for r in left)
    assert {r["doc_id"]: r["text"] for r in left}[1].endswith(corpus_pipeline.REDACTED) and {r["doc_id"]: r["text"] for r in left}[3] is None


def test_repeated_rows_and_ids_leave_one(spark, tables):
    text, other = "a b c d e f g h i j k l m n o p", "quite another text that shares nothing with the first one at all"
    given = [row(1, text), row(1, text), row(2, text), row(None, text), row(5, other), row(5, other), row(5, text), row(None, "q r s t u v"), row(None, "q r s t u v")]
    left = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(given, CLASHING), tables).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in left) == sorted([(1, text), (5, other), (0, "q r s t u v")])


def test_empty_table_and_a_stage_that_keeps_nothing(spark, tables):
    none = spark.createDataFrame([], CLASHING)
    assert run_stages(spark, none, tables).count() == 0 and corpus_pipeline.pack_documents(spark, none, tables).count() == 0
    item = spark.read.parquet(f"{tables}/benchmark.parquet").first()["text"]
    docs = spark.createDataFrame([row(1, item)], CLASHING)
    assert corpus_pipeline.drop_contaminated(spark, docs, tables).count() == 0


def test_hot_stars_are_dealt_without_loss(spark):
    from millrace.llm.shared import connected_components

    links = [(7, k) for k in range(1000, 1400)] + [(1399, 5), (5, 6), (2000, 2001), (2001, 2002)]
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "u long, v long"), hub_links=16).collect()}
    assert got == {**{k: 5 for k in (5, 6, 7, *range(1000, 1400))}, **{k: 2000 for k in (2000, 2001, 2002)}}
