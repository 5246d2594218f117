"""Exact substring deduplication: suffixes sorted block by block with difference-cover ranks.

A byte goes if some run of ``length`` bytes over it also starts earlier (smaller id, or same id and smaller start). The
suffixes that can matter are found first, then sorted one bucket at a time:

1. Each run of ``length`` bytes names the least hashed 32-gram within it; neighbouring runs with the same one form a
   span. Equal runs name equal grams, so only spans with the same gram can share a run. Equal spans collapse to their
   first place, in the task that reads them and again in the bucket of their gram: the others go as a whole.
2. A gram that has one span left is done. Where different spans share a gram, their bytes (``length`` and at most 68
   more) are gathered into buckets, and all suffixes of a bucket that begin a run are sorted: by their first 32 bytes,
   and where those agree by the precomputed ranks of the cover sample. Runs with equal bytes are then neighbours; all
   but the first place go.
3. The removed stretches of each document are united and cut out.

A gram that is in very many spans of one batch is hot: its spans are dealt by gram and content together, and a mark tells
its own bucket. Equal runs of one batch are settled there. A gram that is left with very many open spans in all has its
runs dealt one by one by their content in step 2, so no bucket holds it alone; that moves a span's bytes once for each
run, so it is kept to grams that a bucket can't take. Texts are moved only where a stretch may go from them (a bounded bit table of ids
decides; it has no false negatives). Large texts are read in overlapping pieces.

Defined cases: null and empty texts have no bytes; texts shorter than ``length`` stay whole; rows with the same id are
one place in order, so neither of two equal places is earlier; null ids come first; other columns are carried only on
request; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textvec as tv
from millrace.llm.difference_cover import PERIOD, equal_runs, words_at
from millrace.llm.shared import quoted, ship_package, write_table

GRAM = 32
PIECE = 1 << 21  # bytes of a text that are worked on at once; below 2**24
TASK_BYTES = 64 << 20  # of texts, whose spans one task takes
HOT_SPANS = 32  # different spans of one gram in one batch, from which it is hot
MANY_SPANS = 1 << 15  # open spans of one gram in all, above which its runs are dealt one by one; up to that they have 5.5 MB at most
PLACE_BITS = np.uint64((1 << 24) - 1)
LEAST_SLOTS, MOST_SLOTS = 1 << 20, 1 << 26  # bits of a table of ids: sixteen for each id, within these bounds
SPAN = np.dtype([("gram", "<u8"), ("content", "<u8"), ("more", "<u8"), ("doc", "<i8"), ("start", "<i4"), ("tag", "<u4"), ("runs", "u1"), ("kind", "u1")])
PLAIN, HOT, MARK, GONE = range(4)  # kinds of rows; GONE: a stretch of ``runs`` zero, its end in ``content``


def pieces(text: pa.LargeStringArray, length: int, limit: int | None = None):
    """(rows, where in the row's text each begins, bytes, offsets); pieces of a long text share ``length`` - 1 bytes."""
    limit = limit or PIECE
    for row, data, offsets in tv.blocks(text, limit):
        if len(offsets) > 2 or len(data) <= limit:
            yield np.arange(row, row + len(offsets) - 1), np.zeros(len(offsets) - 1, np.int64), data, offsets
            continue
        for at in range(0, len(data) - length + 1, limit - length + 1):
            part = data[at : at + limit]
            yield np.array([row]), np.array([at]), part, np.array([0, len(part)])


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    n = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.uint64(2**64 - 1))
    padded[: len(values)] = values
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def spans_of(data: np.ndarray, offsets: np.ndarray, length: int):
    """(text, start in the bytes, runs, gram, content, more) of the spans of several texts."""
    n = len(data)
    if n < length:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),) * 3
    sums = tv.prefix_sums(data)
    _, inverse = tv.powers(n + 1)
    grams = tv.mix((sums[GRAM:] - sums[:-GRAM]) * inverse[: n - GRAM + 1])
    # of equal grams the one furthest right, so that only what is within the run decides
    keyed = (grams & ~PLACE_BITS) | (PLACE_BITS - np.arange(len(grams), dtype=np.uint64))
    place = (PLACE_BITS - (sliding_least(keyed, length - GRAM + 1) & PLACE_BITS)).astype(np.int64)
    runs = n - length + 1
    crossing = np.zeros(runs + 1, np.int32)  # runs that would leave their text
    ends = offsets[1:-1]
    np.add.at(crossing, np.clip(ends - length + 1, 0, runs), 1)
    np.add.at(crossing, np.clip(ends, 0, runs), -1)
    whole = np.cumsum(crossing[:-1]) == 0
    first = whole.copy()
    first[1:] &= ~whole[:-1] | (place[1:] != place[:-1])
    edge = offsets[offsets < runs]
    first[edge] |= whole[edge]
    start = np.flatnonzero(first)
    last = whole.copy()
    last[:-1] &= ~whole[1:] | first[1:]
    stop = np.flatnonzero(last)
    text = np.searchsorted(offsets, start, side="right") - 1
    content, more = digests(data, start, stop + length)
    return text, start, stop - start + 1, grams[place[start]], content, more


def digests(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of BLAKE2b of each stretch, in halves. Grams only bring spans together; this alone makes them equal."""
    raw, made = memoryview(np.ascontiguousarray(data)), hashlib.blake2b
    both = np.frombuffer(b"".join([made(raw[a:b], digest_size=16).digest() for a, b in zip(starts.tolist(), ends.tolist())]), "<u8")
    return both[::2], both[1::2]


def united(doc, tag, start, end):
    """Overlapping or touching stretches of a document united; all arrays, sorted on return."""
    if not len(doc):
        return doc, tag, start, end
    order = np.lexsort([start, tag, doc])
    doc, tag, start, end = doc[order], tag[order], start[order], end[order]
    other = np.ones(len(doc), bool)
    other[1:] = (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])
    # offset each document so that a running maximum doesn't reach from one to the next
    lift = np.cumsum(other) * np.int64(1 << 40)
    reach = np.maximum.accumulate(end + lift)
    new = other.copy()
    new[1:] |= (start + lift)[1:] > reach[:-1]
    at = np.flatnonzero(new)
    return doc[at], tag[at], start[at], (reach - lift)[np.concatenate([at[1:] - 1, [len(doc) - 1]])]


def settle(rows: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows left, for each whether its gram has another span or a mark, stretches of equal spans that go)."""
    rows = rows[np.lexsort([rows["start"], rows["doc"], rows["runs"], rows["more"], rows["content"], rows["gram"]])]
    marks = np.unique(rows["gram"][rows["kind"] == MARK])
    rows = rows[rows["kind"] != MARK]
    n = len(rows)
    new_gram = np.ones(n, bool)
    new_gram[1:] = rows["gram"][1:] != rows["gram"][:-1]
    new = new_gram.copy()
    for part in ("content", "more", "runs"):
        new[1:] |= rows[part][1:] != rows[part][:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if n else np.zeros(0, np.int64)
    later = (rows["doc"] != rows["doc"][head]) | (rows["start"] != rows["start"][head])
    gone, kept = rows[later], rows[~later]
    # rows of the very same place stay, and don't make a gram look shared
    gram_no = (np.cumsum(new_gram) - 1)[~later]
    spans = np.bincount(gram_no, weights=new[~later], minlength=int(new_gram.sum()))
    shared = (spans[gram_no] > 1) | np.isin(kept["gram"], marks) | (kept["kind"] == HOT)
    return kept, shared, gone


def gone_rows(gone: np.ndarray, length: int) -> np.ndarray:
    doc, tag, start, end = united(gone["doc"], gone["tag"], gone["start"].astype(np.int64), gone["start"].astype(np.int64) + gone["runs"] + length - 1)
    out = np.zeros(len(doc), SPAN)
    out["doc"], out["tag"], out["start"], out["content"], out["kind"] = doc, tag, start, end.astype(np.uint64), GONE
    return out


def packed(rows: np.ndarray) -> bytes:
    """Rows column by column, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(np.ascontiguousarray(rows[n]).tobytes() for n in SPAN.names))


def unpacked(blob: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = len(raw) // SPAN.itemsize
    out, at = np.zeros(n, SPAN), 0
    for name in SPAN.names:
        kind = SPAN[name]
        out[name] = np.frombuffer(raw, kind, n, at)
        at += n * kind.itemsize
    return out


def _bucket(key: np.ndarray, buckets: int) -> np.ndarray:
    return (tv.mix(key) % np.uint64(buckets)).astype(np.int64)


def read_spans(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """(bucket, rows): what a batch leaves open, dealt by gram, and what it settles, dealt by document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs_, tags = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            text, found = batch.column(2).cast(pa.large_string()).fill_null(""), []
            for row, base, data, offsets in pieces(text, length):
                of, start, runs, gram, content, more = spans_of(data, offsets, length)
                part = np.zeros(len(of), SPAN)
                part["doc"], part["tag"] = docs_[row[of]], tags[row[of]]
                part["start"], part["runs"] = start - offsets[of] + base[of], runs
                part["gram"], part["content"], part["more"] = gram, content, more
                found.append(part)
            rows = np.concatenate(found) if found else np.zeros(0, SPAN)
            if not len(rows):
                continue
            rows, _, gone = settle(rows, length)
            which, count = np.unique(rows["gram"], return_counts=True)
            hot = which[count > HOT_SPANS]
            rows["kind"][np.isin(rows["gram"], hot)] = HOT
            marks = np.zeros(len(hot), SPAN)
            marks["gram"], marks["kind"] = hot, MARK
            rows = np.concatenate([rows, marks, gone_rows(gone, length)])
            key = np.where(rows["kind"] == HOT, rows["gram"] + tv.mix(rows["content"]), rows["gram"])
            key = np.where(rows["kind"] == GONE, rows["doc"].astype(np.uint64), key)
            bucket = _bucket(key, buckets)
            order = np.argsort(bucket, kind="stable")
            rows, bucket = rows[order], bucket[order]
            at = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(rows)]])
            blobs = [packed(rows[a:b]) for a, b in zip(at, at[1:])]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[at[:-1]]), pa.array(blobs, pa.binary())], ["bucket", "rows"])

    return docs.mapInArrow(run, "bucket long, rows binary")


SETTLED = "gone boolean, doc long, tag long, start long, end long, runs int, gram long, hot boolean"


def _tasks(rows: DataFrame, size: int) -> int:
    """So many that each gets the work of TASK_BYTES at most, and not fewer than the session would use."""
    return int(max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES)))


def settle_buckets(spans: DataFrame, length: int, tasks: int) -> DataFrame:
    """Stretches that go, and spans whose gram has other spans (those still have to be compared)."""

    def run(group: pa.Table) -> pa.Table:
        rows = np.concatenate([unpacked(b) for b in group.column("rows").to_pylist()])
        done, rows = rows[rows["kind"] == GONE], rows[rows["kind"] != GONE]
        kept, shared, gone = settle(rows, length)
        gone, open_ = np.concatenate([done, gone_rows(gone, length)]), kept[shared]
        hot = (open_["kind"] == HOT) | np.isin(open_["gram"], rows["gram"][rows["kind"] == MARK])
        n, m = len(gone), len(open_)
        start = np.concatenate([gone["start"], open_["start"]]).astype(np.int64)
        end = np.concatenate([gone["content"].astype(np.int64), open_["start"].astype(np.int64) + open_["runs"] + length - 1])
        return pa.table(
            {
                "gone": pa.array(np.arange(n + m) < n),
                "doc": pa.array(np.concatenate([gone["doc"], open_["doc"]])),
                "tag": pa.array(np.concatenate([gone["tag"], open_["tag"]]).astype(np.int64)),
                "start": pa.array(start),
                "end": pa.array(end),
                "runs": pa.array(np.concatenate([gone["runs"], open_["runs"]]).astype(np.int32)),
                "gram": pa.array(np.concatenate([gone["gram"], open_["gram"]]).view(np.int64)),
                "hot": pa.array(np.concatenate([np.zeros(n, bool), hot])),
            }
        )

    return spans.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(run, SETTLED)


def gather_bytes(marked: DataFrame, length: int, buckets: int) -> DataFrame:
    """(bucket, doc, tag, start, runs, bytes): the bytes of open spans, dealt by gram; of hot grams run by run."""
    names = ["bucket", "doc", "tag", "start", "runs", "bytes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket, doc, tag, start, runs, raw = ([] for _ in names)
            for r in batch.to_pylist():
                text = r["text"].encode()
                for s in r["spans"]:
                    many = range(s["runs"]) if s["hot"] else (0,)
                    for k in many:
                        at = s["start"] + k
                        part = text[at : at + (length if s["hot"] else s["runs"] + length - 1)]
                        key = int.from_bytes(hashlib.blake2b(part, digest_size=8).digest(), "little") if s["hot"] else s["gram"] & (2**64 - 1)
                        bucket.append(key)
                        doc.append(r["doc"])
                        tag.append(r["tag"])
                        start.append(at)
                        runs.append(1 if s["hot"] else s["runs"])
                        raw.append(part)
            if bucket:
                dealt = _bucket(np.array(bucket, np.uint64), buckets)
                yield pa.RecordBatch.from_arrays([pa.array(dealt), pa.array(doc, pa.int64()), pa.array(tag, pa.int64()), pa.array(start, pa.int64()), pa.array(runs, pa.int32()), pa.array(raw, pa.binary())], names)

    return marked.mapInArrow(run, "bucket long, doc long, tag long, start long, runs int, bytes binary")


def aligned(raw: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, where each span begins): spans laid so that the gram of each stands at a multiple of the cover's period.

    Equal runs then have equal residues, so their cover ranks compare directly.
    """
    size = np.fromiter(map(len, raw), np.int64, len(raw))
    tight = np.concatenate([[0], np.cumsum(size)[:-1]])
    data = np.frombuffer(b"".join(raw), np.uint8)
    sums = tv.prefix_sums(data)
    _, inverse = tv.powers(len(data) + 1)
    grams = tv.mix((sums[GRAM:] - sums[:-GRAM]) * inverse[: len(data) - GRAM + 1])
    keyed = (grams & ~PLACE_BITS) | (PLACE_BITS - (np.arange(len(grams), dtype=np.uint64) & PLACE_BITS))
    low = PLACE_BITS - (sliding_least(keyed, length - GRAM + 1)[tight] & PLACE_BITS)
    gram_at = (low.astype(np.int64) - tight) % (1 << 24)
    slot = (size + 2 * PERIOD - 2) // PERIOD * PERIOD
    begin = np.concatenate([[0], np.cumsum(slot)[:-1]]) + -gram_at % PERIOD
    text = np.zeros(int(slot.sum()), np.uint8)
    owner, k = tv.ragged(size)
    text[begin[owner] + k] = data
    return text, begin


def later_runs(raw: list[bytes], doc, tag, start, runs, length: int):
    """(doc, tag, start, end), united: runs of these spans that also begin at an earlier place among them."""
    text, begin = aligned(raw, length)
    words = words_at(text)
    owner, k = tv.ragged(runs.astype(np.int64))
    order, group = equal_runs(words, begin[owner] + k, length)
    owner, place = owner[order], (start[owner] + k)[order]
    by = np.lexsort([place, doc[owner], group])
    owner, place, group = owner[by], place[by], group[by]
    new = np.ones(len(group), bool)
    new[1:] = group[1:] != group[:-1]
    head = np.flatnonzero(new)[np.cumsum(new) - 1] if len(group) else np.zeros(0, np.int64)
    later = (doc[owner] != doc[owner][head]) | (place != place[head])
    return united(doc[owner][later], tag[owner][later], place[later], place[later] + length)


def compare_buckets(rows: DataFrame, length: int, tasks: int) -> DataFrame:
    """(doc, tag, start, end): stretches that go, one bucket of suffixes sorted at a time."""

    def run(group: pa.Table) -> pa.Table:
        columns = [group.column(n).to_numpy() for n in ("doc", "tag", "start", "runs")]
        found = later_runs(group.column("bytes").to_pylist(), *columns, length)
        return pa.table({n: pa.array(c) for n, c in zip(("doc", "tag", "start", "end"), found)})

    return rows.repartition(tasks, "bucket").groupBy("bucket").applyInArrow(run, "doc long, tag long, start long, end long")


def may_hold(keys: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``doc`` may be among the keys' and rows whose surely isn't, by a bit table of MOST_SLOTS bits at most.

    The table is joined as rows of 32,768 bits, so no plan holds its bytes: plans are kept as text by the driver, many times over.
    """
    n = keys.agg(F.approx_count_distinct("doc")).first()[0]
    slots = min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (16 * n).bit_length()))
    at = F.pmod(F.xxhash64("doc"), F.lit(slots)) + 1
    # at most MOST_SLOTS / 32768 bitmaps of 4 KB, which bounds what is broadcast
    table = keys.select(at.alias("s")).groupBy(F.bitmap_bucket_number("s").alias("__part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("__bits"))
    told = rows.withColumn("__at", F.bitmap_bit_position(at)).join(F.broadcast(table), F.bitmap_bucket_number(at) == F.col("__part"), "left")
    byte = F.conv(F.hex(F.substring("__bits", F.expr("cast(__at div 8 + 1 as int)"), F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (F.col("__at") % 8).cast("int")) == 1, F.lit(False))
    return tuple(told.where(h).drop("__at", "__part", "__bits") for h in (hit, ~hit))


def repeated_stretches(rows: DataFrame, length: int) -> DataFrame:
    """(doc, tag, stretches) of rows (doc, tag, text): what also starts earlier, for documents that have any."""
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(min(1 << 20, max(256, total // (32 << 20))))
    settled = write_table(settle_buckets(read_spans(rows, length, buckets), length, _tasks(rows, total)), "spans", ["gone"])
    open_ = settled.where("NOT gone").drop("hot")
    size = open_.agg(F.sum("end") - F.sum("start")).first()[0] or 0
    near, _ = may_hold(open_, rows)
    # fewer than open spans / MANY_SPANS grams, which bounds what is broadcast
    many = open_.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > MANY_SPANS).select("gram", F.lit(True).alias("hot"))
    open_ = open_.join(F.broadcast(many), "gram", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    wanted = open_.groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "runs", "gram", "hot")).alias("spans"))
    marked = near.join(wanted, ["doc", "tag"]).select("doc", "tag", "text", "spans")  # repeated rows are one place each
    found = compare_buckets(gather_bytes(marked, length, int(max(256, size // (4 << 20)))), length, _tasks(rows, size))
    gone = settled.where("gone").select("doc", "tag", "start", "end").unionByName(found)
    return write_table(gone.groupBy("doc", "tag").agg(F.sort_array(F.collect_set(F.struct("start", "end"))).alias("stretches")), "stretches")


def dedup_substrings(docs: DataFrame, length: int = 100, text_col: str = "text", id_col: str = "doc_id", with_text: bool = False) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256); with ``with_text`` also the bytes kept (``kept``)."""
    if not GRAM + 8 <= length <= GRAM + 200:
        raise ValueError(f"length: {GRAM + 8} to {GRAM + 200}")
    ship_package(docs.sparkSession)
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(quoted(id_col).cast("long"), F.lit(-(1 << 63)).cast("long")).alias("doc"), F.xxhash64(text).bitwiseAND(0xFFFFFFFF).alias("tag"), text.alias("text"), quoted(id_col).alias("id"))
    stretches = repeated_stretches(rows.select("doc", "tag", "text"), length)
    near, far = may_hold(stretches, rows)
    out = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept binary" * with_text

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for r in batch.to_pylist():
                raw, parts, at, spans, removed = r["text"].encode(), [], 0, 0, 0
                for s in r["stretches"] or ():
                    lo, hi = max(at, s["start"]), s["end"]
                    if hi <= at:
                        continue
                    spans += s["start"] > at or not spans or at == 0
                    parts.append(raw[at:lo])
                    removed += hi - lo
                    at = hi
                kept = b"".join([*parts, raw[at:]])
                made.append((r["id"], len(raw), removed, spans, hashlib.sha256(kept).hexdigest(), kept))
            types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip([*zip(*made)][: 5 + with_text], types)], ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 + with_text])

    cut_out = near.join(stretches, ["doc", "tag"], "left").select("id", "text", "stretches").mapInArrow(run, out)
    whole = far.select(F.col("id").cast("long").alias("id"), F.octet_length("text").cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"), *[F.col("text").cast("binary").alias("kept")] * with_text)
    return cut_out.unionByName(whole).withColumnRenamed("id", id_col)
