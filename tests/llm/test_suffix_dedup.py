import hashlib
import time

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import suffix_dedup
from millrace.llm.difference_cover import COVER, PERIOD, equal_runs, shifts, sort_suffixes, words_at
from millrace.llm.shared import DROP_SHUFFLES, write_table
from millrace.llm.suffix_dedup import dedup_substrings, sliding_least, spans_of, united


def brute(rows, length=100):
    first = {}
    for i, t in rows:
        raw = (t or "").encode()
        for s in range(len(raw) - length + 1):
            key = (-(1 << 63) if i is None else i, s)
            w = raw[s : s + length]
            first[w] = min(first.get(w, key), key)
    out = []
    for i, t in rows:
        raw = (t or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for s in range(len(raw) - length + 1):
            if first[raw[s : s + length]] < (-(1 << 63) if i is None else i, s):
                gone[s : s + length] = True
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + (gone[0] if len(raw) else 0))
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def texts(rng):
    words = [f"{w}é{k}" for k in range(40) for w in ("alpha", "beta", "gam")]
    say = lambda n: " ".join(rng.choice(words, n))
    line, page = say(25), say(120)
    out = [say(60) for _ in range(6)]
    out += [page, page, page[:400] + "X" + page[400:], page.replace("alpha", "beta", 3), page[50:]]
    out += [say(5) + line + say(5) for _ in range(45)]
    out += ["ab" * 300, "ab" * 200, "a" * 150, "a" * 99, "a" * 100, "", None, line, line[:99].strip(), say(10) + line + line]
    return out


def test_equals_brute_force(spark):
    rng = np.random.default_rng(0)
    rows = [(int(i), t) for i, t in zip(rng.permutation(100), texts(rng))] + [(None, "n" * 120), (3, "zz" * 80), (3, "zz" * 80), (3, "yy" + "zz" * 80)]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, doc int")
    assert sorted(map(tuple, dedup_substrings(docs.repartition(3)).collect()), key=str) == brute(rows)


def test_hot_grams_and_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "HOT_SPANS", 1)
    monkeypatch.setattr(suffix_dedup, "PIECE", 300)
    rng = np.random.default_rng(1)
    rows = [(i, t) for i, t in enumerate(texts(rng))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    length = 100
    batches = docs.selectExpr("doc_id AS doc", "xxhash64(coalesce(text, '')) & 4294967295 AS tag", "coalesce(text, '') AS text").toArrow().to_batches()
    # the same steps in this process, where the small limits hold
    blobs = []

    class Frame:
        def mapInArrow(self, run, _):
            for b in batches:
                for k in range(0, b.num_rows, 20):
                    blobs.extend(run(iter([b.slice(k, 20)])))

    suffix_dedup.read_spans(Frame(), length, 4)
    table, settled = pa.Table.from_batches(blobs), []

    class Grouped:
        def repartition(self, *_):
            return self

        def groupBy(self, _):
            return self

        def applyInArrow(self, run, _):
            for k in set(table.column("bucket").to_pylist()):
                settled.append(run(table.filter(pa.compute.equal(table.column("bucket"), k))))

    suffix_dedup.settle_buckets(Grouped(), length, 1)
    rows_ = pa.concat_tables(settled).to_pylist()
    assert any(r["hot"] for r in rows_)
    raw = {i: (t or "").encode() for i, t in rows}
    gone = [(r["doc"], r["start"], r["end"]) for r in rows_ if r["gone"]]
    open_ = [(r, k) for r in rows_ if not r["gone"] for k in (range(r["runs"]) if r["hot"] else [None])]
    args = [[raw[r["doc"]][r["start"] + (k or 0) : r["end"] if k is None else r["start"] + k + length] for r, k in open_]]
    args += [np.array([r["doc"] for r, _ in open_]), np.array([r["tag"] for r, _ in open_]), np.array([r["start"] + (k or 0) for r, k in open_]), np.array([r["runs"] if k is None else 1 for r, k in open_])]
    d, _, s, e = suffix_dedup.later_runs(*args, length)
    gone += zip(d.tolist(), s.tolist(), e.tolist())
    for i, n, removed, _, _ in brute(rows):
        cover = np.zeros(n, bool)
        for d, s, e in gone:
            if d == i:
                cover[s:e] = True
        assert cover.sum() == removed


def test_edges(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_substrings(empty).count() == 0
    with pytest.raises(ValueError):
        dedup_substrings(empty, length=10)
    docs = spark.createDataFrame([(1, "x" * 30 + "é" * 100), (2, "q" + "é" * 100)], "doc_id long, text string")
    got = {r["doc_id"]: bytes(r["kept"]) for r in dedup_substrings(docs, with_text=True).collect()}
    assert got == {1: b"x" * 30 + "é".encode(), 2: b"q"}


def test_difference_cover():
    assert shifts().max() < PERIOD and len({(a - b) % PERIOD for a in COVER for b in COVER}) == PERIOD


@settings(max_examples=60, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"ab" * 40, b"a" * 60, b"xyz"]), min_size=1, max_size=12).map(b"".join), st.integers(0, 5))
def test_sorted_like_suffixes(raw, seed):
    words = words_at(np.frombuffer(raw, np.uint8))
    at = np.random.default_rng(seed).permutation(len(raw))[:60]
    got = at[sort_suffixes(words, at, 100)]
    cut = [raw[a : a + 100].ljust(100, b"\0") for a in got]
    assert cut == sorted(cut)
    at = at[at + 100 <= len(raw)]
    order, group = equal_runs(words, at, 100)
    assert len(set(group.tolist())) == len({raw[a : a + 100] for a in at})


def test_parts():
    x = np.random.default_rng(0).integers(0, 1000, 50).astype(np.uint64)
    assert sliding_least(x, 7).tolist() == [int(x[i : i + 7].min()) for i in range(44)]
    d, _, s, e = united(*(np.array(c) for c in ([1, 1, 2, 1], [0] * 4, [0, 5, 2, 20], [10, 12, 4, 30])))
    assert list(zip(d, s, e)) == [(1, 0, 12), (1, 20, 30), (2, 2, 4)]
    raw = np.frombuffer(b"q" * 350, np.uint8)
    text, start, runs, *_ = spans_of(raw, np.array([0, 120, 350]), 100)
    assert runs.sum() == 21 + 131 and set(text) == {0, 1} and (start + runs + 99 <= np.array([120, 350])[text]).all()


def test_spans_are_equal_by_all_bits_of_their_digest():
    raw = b"q" * 40 + bytes(range(32)) + b"r" * 28
    other = b"s" * 40 + bytes(range(32)) + b"t" * 28
    for a in (raw, other):
        _, start, runs, _, content, more = spans_of(np.frombuffer(a, np.uint8), np.array([0, 100]), 100)
        assert content.tobytes() + more.tobytes() == hashlib.blake2b(a, digest_size=16).digest() and (start, runs) == (0, 1)
    # a text made to agree with another one in gram and 64 bits stays
    rows = np.zeros(3, suffix_dedup.SPAN)
    rows["gram"], rows["content"], rows["doc"], rows["runs"] = 7, 9, [1, 2, 3], 1
    rows["more"] = [5, 6, 5]
    kept, shared, gone = suffix_dedup.settle(rows, 100)
    assert sorted(kept["doc"]) == [1, 2] and gone["doc"].tolist() == [3] and shared.all()


@pytest.mark.parametrize("n", [0, 3, 5000])
def test_the_table_of_ids_has_no_false_negatives(spark, monkeypatch, n):
    monkeypatch.setattr(suffix_dedup, "LEAST_SLOTS", 1 << 15)
    rows = spark.range(20_000).selectExpr("id * 7919 - 1000000 AS doc")
    keys = rows.where(f"doc % 20000 < {n}") if n else rows.limit(0)
    near, far = suffix_dedup.may_hold(keys, rows)
    assert near.join(keys, "doc", "left_semi").count() == keys.count() and near.count() + far.count() == 20_000
    assert near.count() < keys.count() + 2000


def test_runs_are_dealt_one_by_one_for_grams_of_very_many_spans_only(spark, monkeypatch):
    rng, common = np.random.default_rng(2), "A passage of forty bytes that all share. "
    say = lambda n: bytes(rng.integers(97, 123, n).astype(np.uint8)).decode()
    rows = [(i, say(90) + common + say(90)) for i in range(80)] + [(100, "")]
    rows += [(101, rows[7][1][20:]), (102, rows[8][1][:150]), (103, rows[9][1][5:] + rows[9][1])]
    docs, gathered = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), []
    compare = suffix_dedup.compare_buckets

    def kept(found, *rest):
        gathered.append(found.selectExpr("runs", "octet_length(bytes) AS n").collect())
        return compare(found, *rest)

    monkeypatch.setattr(suffix_dedup, "compare_buckets", kept)
    assert sorted(map(tuple, dedup_substrings(docs).collect()), key=str) == brute(rows)
    monkeypatch.setattr(suffix_dedup, "MANY_SPANS", 10)
    assert sorted(map(tuple, dedup_substrings(docs).collect()), key=str) == brute(rows)
    few, many = (sum(r["n"] for r in g) for g in gathered)
    assert sum(r["runs"] for r in gathered[0]) == sum(r["runs"] for r in gathered[1]) and few * 8 < many


def test_nothing_shuffled_for_a_table_outlasts_its_write(spark):
    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        files = disk.getAllFiles()
        return {n for k in range(files.size()) if (n := files.apply(k).getName()).startswith("shuffle_")}

    rows = spark.range(5000).repartition(3, "id").selectExpr("id % 100 AS k").groupBy("k").count()
    before = shuffled()
    table = write_table(rows, "kept")
    for _ in range(50):  # files are deleted in the background
        left = shuffled() - before
        if not left:
            break
        time.sleep(0.1)
    assert not left and table.count() == 100 and spark.conf.get(DROP_SHUFFLES) == "false"


def test_no_plan_holds_the_table_of_ids(spark):
    rows = spark.range(20_000).selectExpr("id * 7919 - 1000000 AS doc")
    keys = rows.where("doc % 4 = 0")
    for part in suffix_dedup.may_hold(keys, rows):
        assert len(part._jdf.queryExecution().toString()) < suffix_dedup.LEAST_SLOTS // 16  # its bytes as text would take four times that
    near, far = suffix_dedup.may_hold(keys, rows)
    assert near.columns == far.columns == ["doc"] and near.join(far, "doc").count() == 0
