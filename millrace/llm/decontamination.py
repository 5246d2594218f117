"""Benchmark decontamination: a prefix-filtered set join of document shingles with benchmark windows.

Every run of ``window`` item words is a set of shingles (up to ``shingle`` words each). Containment of a whole window
needs all of its shingles, so a single prefix token suffices: the shingle that is rarest in the documents. One pass over
the documents counts the benchmark's shingles; a second one picks the occurrences of prefix tokens, each with the words
around it. Both sides are joined on the token; positional and length bounds place the window around it, and its words
are compared exactly. A third pass adds the hits to the documents.

Nothing of the benchmark is held by the driver or in whole by a worker: the passes carry a table of bits that tells
which hashes may matter (its size is bounded, false hits fall out of the join), windows and counts are tables, and
tokens that occur often are dealt over tasks. Documents with equal texts have equal results, so their occurrences are one row.

Defined cases: null and empty texts have no words (n_words 0, not contaminated); an item of fewer words than a window
is one window; an item without words has none; repeated items and repeated documents each keep their own rows; items
with a null id are ignored; item ids of any type are sorted as strings; extra columns of either table are not read; an
empty table of documents gives no row, an empty benchmark no hit.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import textvec as tv
from millrace.llm.shared import cut, join_dealt, map_text, quoted, release_memory, ship_package

LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27  # of a table that tells which hashes may matter
HOT_TOKENS = 10_000  # occurrences of one token that a task takes, at least
HOT_TEXTS = 10_000  # documents of one text, likewise
MOST_SENT = 200_000  # texts with hits, and items in them, up to which they are sent to every executor
RESULT = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items")
_SALT = tv.mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n consecutive word hashes."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    total = np.zeros(len(words) - n + 1, np.uint64)
    for j in range(n):
        total += words[j : len(words) - n + 1 + j] * _SALT[j % 64] + np.uint64(j)
    return tv.mix(total)


def hashed_words(text: pa.LargeStringArray, limit: int = 1 << 20):
    """(first row, word hashes, first word of each text, word texts) of each run of texts."""
    for row, data, offsets in tv.blocks(text, limit):
        low = tv.LOWER[data]
        starts, ends, first = tv.word_spans(low, offsets, tv.WORD_BYTES)
        yield row, tv.span_hashes(tv.prefix_sums(low), starts, ends), first, (low, starts, ends)


def benchmark_windows(benchmark: DataFrame, window: int, text_col: str, id_col: str) -> DataFrame:
    """(item, run, n): every window of every item, its words joined by blanks."""

    def run(batches):
        for batch in batches:
            text = batch.column(1).cast(pa.large_string()).fill_null("")
            at, runs, size = [], [], []
            for row, _, first, (low, starts, ends) in hashed_words(text):
                raw = low.tobytes()
                for i in range(len(first) - 1):
                    words = [raw[s:e].decode() for s, e in zip(starts[first[i] : first[i + 1]].tolist(), ends[first[i] : first[i + 1]].tolist())]
                    n = min(window, len(words))
                    made = [" ".join(words[k : k + n]) for k in range(len(words) - n + 1 if n else 0)]
                    at += [row + i] * len(made)
                    runs += made
                    size += [n] * len(made)
            for lo in range(0, len(at), 20_000):
                part = slice(lo, lo + 20_000)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at[part])), pa.array(runs[part], pa.string()), pa.array(size[part], pa.int32())], ["item", "run", "n"])

    rows = benchmark.select(quoted(id_col).alias("item"), quoted(text_col).cast("string").alias("t")).where("item IS NOT NULL")
    return rows.mapInArrow(run, T.StructType([rows.schema["item"], T.StructField("run", T.StringType()), T.StructField("n", T.IntegerType())])).distinct()


def window_tokens(runs: DataFrame, shingle: int) -> DataFrame:
    """(run, n, offset, size, token): the shingles of each different window."""

    def run(batches):
        for batch in batches:
            runs, at, offset, size, token = batch.column(0), [], [], [], []
            for row, words, first, _ in hashed_words(runs.cast(pa.large_string())):
                for i in range(len(first) - 1):
                    s = min(shingle, int(first[i + 1] - first[i]))
                    found = run_hashes(words[first[i] : first[i + 1]], s)
                    at.append(np.full(len(found), row + i))
                    offset.append(np.arange(len(found), dtype=np.int32))
                    size.append(np.full(len(found), s, np.int32))
                    token.append(found.view(np.int64))
            if at:
                owner = pa.array(np.concatenate(at))
                yield pa.RecordBatch.from_arrays([runs.take(owner), batch.column(1).take(owner), *(pa.array(np.concatenate(x)) for x in (offset, size, token))], ["run", "n", "offset", "size", "token"])

    return runs.select("run", "n").distinct().mapInArrow(run, "run string, n int, offset int, size int, token long")


def bit_table(hashes: DataFrame, column: str) -> np.ndarray:
    """Bits, packed, of the low bits of all these hashes: no false negatives, at most MOST_BITS of them."""
    total = hashes.count()
    size = min(MOST_BITS, max(LEAST_BITS, 1 << int(64 * total).bit_length()))
    slot = F.col(column).bitwiseAND(size - 1)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), slot.bitwiseAND(63).cast("int"))
    words = hashes.select(F.shiftright(slot, 6).alias("w"), bit.alias("b")).groupBy("w").agg(F.bit_or("b").alias("bits"))
    out = np.zeros(size >> 6, np.int64)
    for w, bits in words.toLocalIterator():
        out[w] = bits
    return out


def may_be(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where in ``hashes`` stand those that the table may hold."""
    slot = hashes & np.uint64((len(table) << 6) - 1)
    return np.flatnonzero(table.view(np.uint64)[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1))


def shingles_of(words, first, sizes, table):
    """(size, place, document) of the shingles within one text that the table may hold."""
    for s in sizes:
        hashes = run_hashes(words, s)
        at = may_be(table, hashes)
        doc = np.searchsorted(first, at, side="right") - 1
        good = at + s <= first[doc + 1]
        yield s, at[good], doc[good], hashes[at[good]]


def token_counts(docs: DataFrame, table, sizes: list[int], text_col: str) -> DataFrame:
    """(token, n): how often each shingle that may matter occurs in all documents; counts are summed within each batch first."""

    def run(batches):
        for batch in batches:
            text = batch.column(0).cast(pa.large_string()).fill_null("")
            found = [h for _, words, first, _ in hashed_words(text) for _, _, _, h in shingles_of(words, first, sizes, table.value)]
            token, n = np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.uint64),) * 2
            if len(token):
                yield pa.RecordBatch.from_arrays([pa.array(token.view(np.int64)), pa.array(n.astype(np.int64))], ["token", "n"])
        release_memory()

    return docs.select(quoted(text_col).cast("string").alias("t")).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))


def text_key(raw: bytes) -> bytes:
    """What stands for a text: 128 bits of BLAKE2b."""
    return hashlib.blake2b(raw, digest_size=16).digest()


def occurrences(docs: DataFrame, table, sizes: list[int], most: int, text_col: str) -> DataFrame:
    """(key, copies, token, place, before, around): shingles that may be prefix tokens, with up to ``most`` words to either side."""

    def run(batches):
        for batch in batches:
            text = batch.column(0).cast(pa.large_string()).fill_null("")
            out = [[], [], [], [], []]
            for row, words, first, (low, starts, ends) in hashed_words(text):
                raw, keys = low.tobytes(), {}
                for s, at, doc, token in shingles_of(words, first, sizes, table.value):
                    lo, hi = np.maximum(first[doc], at + s - most), np.minimum(first[doc + 1], at + most)
                    for p, d, h, a, b in zip(at.tolist(), doc.tolist(), token.view(np.int64).tolist(), lo.tolist(), hi.tolist()):
                        if d not in keys:
                            keys[d] = text_key(text[row + d].as_py().encode())
                        made = (keys[d], h, p - int(first[d]), p - a, " ".join(raw[x:y].decode() for x, y in zip(starts[a:b].tolist(), ends[a:b].tolist())))
                        for column, value in zip(out, made):
                            column.append(value)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.string()))], ["key", "token", "place", "before", "around"])

    rows = docs.select(quoted(text_col).cast("string").alias("t")).mapInArrow(run, "key binary, token long, place int, before int, around string")
    return rows.groupBy("key", "token", "place", "before", "around").agg(F.count(F.lit(1)).alias("copies"))


def prefixes(tokens: DataFrame, counts: DataFrame) -> DataFrame:
    """(run, n_words, token, offset, n): of each window the token that is rarest in the documents, which hold it ``n`` times.

    A window with a token that is nowhere can't occur and has no row.
    """
    told = counts.withColumnRenamed("n", "df").join(tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")), "token")
    known = join_dealt(tokens, told, "token", "run", HOT_TOKENS)
    least = F.min(F.struct("df", "token", "offset")).alias("p")
    rows = known.groupBy("run", "words", "size").agg(least, F.count(F.lit(1)).alias("found")).where("found = words - size + 1")
    return rows.select("run", F.col("words").alias("n_words"), "size", "p.token", "p.offset", F.col("p.df").alias("n"))


def verified(found: DataFrame, chosen: DataFrame) -> DataFrame:
    """(key, copies, at, n_words, run): windows that stand around a prefix token word for word."""
    begin = F.col("before") - F.col("offset")  # positional bound; the length bound is that the words go on long enough
    words = F.slice(F.split("around", " "), begin + 1, F.col("n_words"))
    joined = join_dealt(found, chosen.drop("size"), "token", "key", HOT_TOKENS).where(F.col("before") >= F.col("offset"))
    return joined.where((F.size(words) == F.col("n_words")) & (F.array_join(words, " ") == F.col("run"))).select("key", "copies", (F.col("place") - F.col("offset")).alias("at"), "n_words", "run")


def hits_of(found: DataFrame, windows: DataFrame) -> DataFrame:
    """(key, n, n_hit, items) of texts with hits; ``n``: how many documents have the text. What is gathered is one text's own."""
    spans = F.array_sort(F.collect_set(F.struct("at", (F.col("at") + F.col("n_words")).alias("end"))))
    nothing = F.struct(F.lit(0).alias("hit"), F.lit(0).alias("reach"))

    def add(a, x):
        more = F.greatest(F.lit(0), x["end"] - F.greatest(a["reach"], x["at"]))
        return F.struct((a["hit"] + more).alias("hit"), F.greatest(a["reach"], x["end"]).alias("reach"))

    covered = found.groupBy("key").agg(F.max("copies").alias("n"), spans.alias("spans")).select("key", "n", F.aggregate("spans", nothing, add)["hit"].cast("long").alias("n_hit"))
    met = found.select("key", "run").distinct()
    told = windows.select("run", "item").join(met.groupBy("run").agg(F.count(F.lit(1)).alias("n")), "run")
    items = join_dealt(met, told, "run", "key", HOT_TOKENS).groupBy("key").agg(F.collect_set("item").alias("items"))
    return covered.join(items, "key")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, shingle: int = 3, text_col: str = "text", item_text_col: str = "text", item_id_col: str = "item_id", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns of each document with n_words, n_hit, n_items, items_sha256, contaminated and items."""
    spark: SparkSession = docs.sparkSession
    ship_package(spark)
    windows = cut(benchmark_windows(benchmark, window, item_text_col, item_id_col))
    tokens = cut(window_tokens(windows, shingle)).withColumnRenamed("n", "words")
    sizes = sorted(r[0] for r in tokens.select("size").distinct().collect())  # at most ``shingle`` of them
    table = spark.sparkContext.broadcast(bit_table(tokens.select("token").distinct(), "token"))
    chosen = cut(prefixes(tokens, cut(token_counts(docs, table, sizes, text_col).join(tokens.select("token").distinct(), "token", "left_semi"))))
    table.destroy()
    sizes = sorted(r[0] for r in chosen.select("size").distinct().collect())
    table = spark.sparkContext.broadcast(bit_table(chosen.select("token").distinct(), "token"))
    hits = cut(hits_of(cut(verified(occurrences(docs, table, sizes, window, text_col), chosen)), windows))
    table.destroy()
    near = spark.sparkContext.broadcast(bit_table(hits.select(F.xxhash64("key").alias("h")), "h"))

    def worker():
        def handle(text, _):
            n_words, keys = np.zeros(len(text), np.int64), [text_key(t.encode()) for t in text.to_pylist()]
            for row, _, first, _ in hashed_words(text):
                n_words[row : row + len(first) - 1] = np.diff(first)
            maybe = np.zeros(len(keys), bool)
            maybe[may_be(near.value, np.array([xxhash.xxh64_intdigest(k, 42) for k in keys], np.uint64))] = True
            return {"n_words": pa.array(n_words), "__key": pa.array(keys, pa.binary(), mask=~maybe)}

        return handle

    fields = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("__key", T.BinaryType())])
    rows = map_text(docs, worker, fields, text_col, tuple(c for c in carry if c not in RESULT))
    told = hits.withColumnRenamed("key", "__key")
    none_type = hits.schema["items"].dataType
    none = F.array().cast(none_type)
    size = hits.agg(F.count(F.lit(1)), F.sum(F.size("items"))).first()
    if size[0] <= MOST_SENT and (size[1] or 0) <= MOST_SENT:
        found = rows.join(F.broadcast(told.drop("n")), "__key", "left")
    else:  # only rows that may have hits are moved
        moved = rows.where("__key IS NOT NULL").withColumn("__by", F.monotonically_increasing_id())
        seeming = moved.join(told.select("__key"), "__key", "left_anti").drop("__by").unionByName(rows.where("__key IS NULL"))
        found = join_dealt(moved, told, "__key", "__by", HOT_TEXTS).drop("__by").unionByName(seeming.withColumn("n_hit", F.lit(None).cast("long")).withColumn("items", F.lit(None).cast(none_type)))
    items = F.coalesce(F.col("items"), none)
    names = F.array_sort(F.transform(items, lambda x: x.cast("string")))
    return found.select(
        *[quoted(c) for c in carry if c not in RESULT],
        "n_words",
        F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        F.array_sort(items).alias("items"),
    )
