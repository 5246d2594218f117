import zlib

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import textvec as tv
from millrace.llm.packing import SumOfSquaresPacker, _cache, pack, with_digest

ODD = ["", " ", "it's a 'test' don't  we'll\n\n 's x're 've'm 12'd\t\tq", "'s", "a b 　c", "end  \n ", "<|endoftext|> x", "'", "''s", "né'll", "日本語 テスト 123", "a\r\n  b", "🙂🙂 x🙂", "x͸y"]


def encode(texts):
    cache, out = _cache(None), []
    for _, data, offsets in tv.blocks(pa.array(texts, pa.large_string()), 64):
        ids, at = cache.encode(data, offsets)
        out += [ids[a:b].tolist() for a, b in zip(at, at[1:])]
    return out


def test_tokens_equal_the_tokenizer():
    assert encode(ODD) == [_cache(None).tokenizer.encode(t, add_special_tokens=False).ids for t in ODD]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab1'st lré\n\t日 !"), max_size=30), min_size=1, max_size=5))
def test_tokens_equal_the_tokenizer_on_any_text(texts):
    assert encode(texts) == [_cache(None).tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_level_is_the_one_that_brute_force_finds():
    packer = SumOfSquaresPacker(16, 0)
    rng = np.random.default_rng(1)
    for k in range(300):
        size = int(rng.integers(1, 16))

        def total(level):
            n = packer.count.copy()
            if level:
                n[level] -= 1
            n[level + size] += 1
            return int((n[1:16] ** 2).sum())

        levels = [0, *[h for h in range(1, 17 - size) if packer.count[h]]]
        best = min(levels, key=lambda h: (total(h), -h))
        assert packer.level_for(size) == best
        packer.add(k, np.zeros(size, np.uint32))


def test_long_pretokens_that_begin_alike():
    texts = ["abcdefghijklmnop" + x + " abcdefgh" for x in ("", "q", "r", "\0", "qq")] * 2 + ["abcdefghi abcdefgh\0 abcdefgh"]
    assert encode(texts) == [_cache(None).tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_few_tokens_are_cut_end_to_end_at_any_partitioning(spark, monkeypatch):
    cut = []
    for parts in (2, 60):
        docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").repartition(parts)
        rows = pack(docs.unionByName(docs.withColumn("doc_id", docs["doc_id"] + 100_000)), length=256).select("doc_id", "start", "length", "doc_tokens", "sequence_id").collect()
        whole = sum(r["length"] for r in rows)
        # a piece that neither begins at a multiple of the length nor goes on to its document's end or a whole window was cut anew
        anew = sum(r["length"] for r in rows if r["start"] % 256 or (r["length"] < 256 and r["start"] + r["length"] < r["doc_tokens"]))
        cut.append(anew / whole)
    assert max(cut) < 0.05 and abs(cut[0] - cut[1]) < 0.03


def test_every_id_once_without_padding(spark):
    texts = ["one two three " * n for n in (1, 5, 700, 3000, 40)] + ["", None, "same", "same"]
    docs = spark.createDataFrame([(i % 8, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, length string")
    rows = pack(docs.repartition(2), length=64).collect()
    seen = {}
    for r in rows:
        seen.setdefault(r["sequence_id"], []).append(r)
    for pieces in seen.values():
        pieces.sort(key=lambda r: r["offset"])
        at = 0
        for r in pieces:
            assert r["offset"] == at and len(r["ids"]) == 4 * r["length"] > 0
            at += r["length"]
        assert at == 64 or at & (at - 1) == 0
    want = sorted(x for t in encode([t or "" for t in texts]) for x in [*t, 1])
    assert sorted(x for r in rows for x in np.frombuffer(r["ids"], "<u4").tolist()) == want
    one = {r["start"]: r for r in rows if r["doc_id"] == 3}
    ids = np.concatenate([np.frombuffer(one[s]["ids"], "<u4") for s in sorted(one)])
    assert ids.tolist() == [*encode([texts[3]])[0], 1] and all(r["doc_tokens"] == len(ids) for r in one.values())


def test_digest_and_empty_table(spark):
    docs = spark.createDataFrame([(7, "abc def")], "doc_id long, text string")
    row = with_digest(pack(docs)).first()
    assert row["ids_crc32"] == zlib.crc32(np.array([*encode(["abc def"])[0], 1], "<u4")[: row["length"]].tobytes())
    assert pack(docs.limit(0)).count() == 0
