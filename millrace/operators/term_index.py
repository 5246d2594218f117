"""A stored inverted index for BM25 with block maxima: written once, appended to, and asked without reading most of it.

An index is a folder of segments. A segment holds

* ``forward``: chunks in their order, cut into ranges of at most ``RANGE`` chunks: (range, place, chunk_id, len, runs);
* ``postings``: for each term of each range one block: its places, counts and lengths, and in ``peaks`` those pairs of
  count and length that no other posting of the block beats (a higher count in a shorter chunk). A weight grows with the
  count and falls with the length, so a block's largest weight is that of one of its peaks, whatever size the collection
  has by then. Blocks lie in folders by a hash of the term and are sorted by term;
* ``terms`` and ``stats``: document frequencies, and one row of totals, which is written last and makes the segment valid.

``append`` adds a segment and touches no other; totals and document frequencies are summed up when the index is asked.

``top_k`` reads the peaks of the asked terms first. Their sum over a query's terms bounds what any chunk of a range can reach.
The most promising ranges are scored; their k-th best score rules out all ranges with lower bounds, and only the blocks of the
others are read. The result is that of ranking everything.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from millrace.functions.text import term_runs, tokens
from millrace.operators import bm25
from millrace.sources.session import kept, path_exists

RANGE = 256  # chunks whose postings of a term are one block
FOLDERS = 16  # folders by term in a segment
PROBES = 2  # ranges of a query that are scored first
SLACK = 1e-6  # scores are rounded to nine digits
FORWARD = "range long, place int, chunk_id string, len long, runs array<struct<term:string,tf:bigint>>"
PEAK = "array<struct<tf:bigint,len:bigint>>"
POSTINGS = f"term string, range long, n int, peaks {PEAK}, postings array<struct<place:int,tf:bigint,len:bigint>>, folder int"
STATS = "n_chunks long, total_len long"


@dataclass(frozen=True)
class TermIndex:
    spark: SparkSession
    path: str

    def segments(self) -> list[str]:
        """Valid segments: those whose totals stand."""
        if not path_exists(self.spark, f"{self.path}/stats"):
            return []
        return sorted(r[0] for r in self.spark.read.schema(f"{STATS}, segment string").parquet(f"{self.path}/stats").select("segment").distinct().collect())

    def _read(self, table: str, schema: str) -> DataFrame:
        rows = self.spark.read.schema(f"{schema}, segment string").parquet(f"{self.path}/{table}")
        return rows.where(F.col("segment").isin(self.segments()))

    def stats(self) -> DataFrame:
        """One row: n_chunks, avg_len."""
        rows = self._read("stats", STATS).agg(F.sum("n_chunks").alias("n_chunks"), F.sum("total_len").alias("total_len"))
        return rows.select("n_chunks", (F.col("total_len") / F.greatest(F.lit(1), F.col("n_chunks"))).alias("avg_len"))

    def terms(self) -> DataFrame:
        """(term, df) over all segments."""
        return self._read("terms", "term string, df long, folder int").groupBy("term").agg(F.sum("df").alias("df"))

    def forward(self) -> DataFrame:
        return self._read("forward", FORWARD)

    def postings(self) -> DataFrame:
        return self._read("postings", POSTINGS)


def _folder(term):
    return F.pmod(F.xxhash64(term), F.lit(FOLDERS)).cast("int")


def peaks_of(postings):
    """Of postings (place, tf, len) the pairs that no other beats, by falling count and so by falling length."""
    ordered = F.array_sort(F.transform(postings, lambda p: F.struct((-p["tf"]).alias("less"), p["len"].alias("len"))))
    none = F.array().cast(PEAK)

    def keep(held, p):
        shorter = (F.size(held) == 0) | (p["len"] < F.element_at(held, -1)["len"])
        return F.when(shorter, F.concat(held, F.array(F.struct((-p["less"]).alias("tf"), p["len"].alias("len"))))).otherwise(held)

    return F.aggregate(ordered, none, keep)


def blocks_of(forward: DataFrame) -> DataFrame:
    """(term, range, n, peaks, postings) of rows of ``forward`` in which each range is together, by place."""
    schema = ST.StructType([f for f in ST._parse_datatype_string(POSTINGS).fields if f.name != "folder"])

    def made(table: pa.Table, number: int) -> pa.RecordBatch:
        runs = pa.concat_arrays(table["runs"].chunks)
        many = pc.fill_null(pc.list_value_length(runs), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = runs.flatten()
        coded = flat.field("term").dictionary_encode()
        term, tf = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), flat.field("tf").to_numpy(zero_copy_only=False)
        place, length = (np.repeat(table[c].to_numpy(), many) for c in ("place", "len"))
        by = np.lexsort([place, term])
        term, tf, place, length = term[by], tf[by], place[by], length[by]
        start = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(term) else np.zeros(0, np.int64)
        at = pa.array(np.append(start, len(term)).astype(np.int32))
        names = ["place", "tf", "len"]
        postings = pa.ListArray.from_arrays(at, pa.StructArray.from_arrays([pa.array(place.astype(np.int32)), pa.array(tf), pa.array(length)], names))
        # by falling count, and of those equal by rising length: a peak is shorter than all before it in its block
        top = np.lexsort([length, -tf, term])
        block = np.searchsorted(start, np.arange(len(term)), side="right") - 1
        lift = (len(start) - block) * np.int64(1 << 40)  # a running least doesn't reach from one block to the next
        low = np.minimum.accumulate(length[top] + lift) if len(term) else lift
        peak = np.append(True, low[1:] < low[:-1])[: len(term)]
        held = np.bincount(block[peak], minlength=len(start))
        ends = pa.array(np.append(0, np.cumsum(held)).astype(np.int32))
        peaks = pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays([pa.array(tf[top][peak]), pa.array(length[top][peak])], names[1:]))
        return pa.RecordBatch.from_arrays([coded.dictionary.take(pa.array(term[start])), pa.array(np.full(len(start), number)), pa.array(np.diff(np.append(start, len(term))).astype(np.int32)), peaks, postings], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number = [], None  # of the range that may go on in the next batch
        for batch in batches:
            ranges = batch.column("range").to_numpy()
            cuts = np.append(np.flatnonzero(np.append(True, ranges[1:] != ranges[:-1])), len(ranges)) if len(ranges) else []
            for a, b in zip(cuts[:-1], cuts[1:]):
                if held and ranges[a] != number:
                    yield made(pa.Table.from_batches(held), number)
                    held = []
                number = int(ranges[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield made(pa.Table.from_batches(held), number)

    return forward.select("range", "place", "len", "runs").mapInArrow(run, schema)


def append(index: TermIndex, chunks: DataFrame, id_col: str = "chunk_id", text_col: str = "embed_text", order_by: tuple[str, ...] = ("chunk_id",)) -> str:
    """Add the chunks that the index doesn't hold yet as a new segment, whose name is returned.

    Chunks that stand together in the order ``order_by`` share ranges; the more alike they are, the more ranges a query skips.
    A chunk without terms is counted like the others; of rows that share an id one is taken; rows without an id or text are left out.
    """
    name = uuid.uuid4().hex
    rows = chunks.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).dropDuplicates([id_col])
    if index.segments():
        rows = rows.join(index.forward().select(F.col("chunk_id").alias("__held")), F.col(id_col) == F.col("__held"), "left_anti")
    found = rows.select(*order_by, F.col(id_col).cast("string").alias("__id"), F.col(text_col).alias("__text"))
    # neighbours of the order, dealt in ranges within each partition; texts are cut into terms after that, since its sample reads all rows
    placed = found.repartitionByRange(*order_by, "__id").sortWithinPartitions(*order_by, "__id").withColumn("__n", F.monotonically_increasing_id())
    placed = placed.withColumn("__terms", tokens("__text"))
    forward = placed.select(F.expr(f"__n div {RANGE}").alias("range"), F.expr(f"cast(__n % {RANGE} AS int)").alias("place"), F.col("__id").alias("chunk_id"), F.size("__terms").cast("long").alias("len"), term_runs("__terms").alias("runs"))
    forward.write.parquet(f"{index.path}/forward/segment={name}")
    held = index.spark.read.schema(FORWARD).parquet(f"{index.path}/forward/segment={name}")

    # a range's chunks meet in one task, so its blocks are made there and no posting is a row
    blocks = blocks_of(held.repartition("range").sortWithinPartitions("range", "place"))
    blocks = blocks.select("term", "range", "n", "peaks", "postings", _folder("term").alias("folder"))
    # a folder that is large, as a term in every range makes it, is split over tasks
    blocks.hint("rebalance", F.col("folder")).sortWithinPartitions("folder", "term", "range").write.partitionBy("folder").parquet(f"{index.path}/postings/segment={name}")
    written = index.spark.read.schema(POSTINGS).parquet(f"{index.path}/postings/segment={name}")
    counted = written.groupBy("term").agg(F.sum("n").cast("long").alias("df")).withColumn("folder", _folder("term"))
    counted.write.partitionBy("folder").parquet(f"{index.path}/terms/segment={name}")
    held.agg(F.count(F.lit(1)).alias("n_chunks"), F.coalesce(F.sum("len"), F.lit(0)).alias("total_len")).write.parquet(f"{index.path}/stats/segment={name}")
    return name


def bounds(index: TermIndex, queries: DataFrame, query_col: str = "query_id", query_text: str = "query") -> tuple[DataFrame, DataFrame]:
    """(asked: (query, term, n_chunks, avg_len, df); limits: (query, segment, range, bound, blocks) of ranges with asked terms)."""
    terms = bm25.query_terms(queries, query_col, query_text)
    asked = terms.join(index.terms(), "term").crossJoin(F.broadcast(index.stats()))  # one row
    peaks = index.postings().select("term", "segment", "range", F.explode("peaks").alias("peak"))
    w = bm25.weight(F.col("n_chunks"), F.col("df"), F.col("peak.tf"), F.col("peak.len"), F.col("avg_len"))
    best = peaks.join(asked, "term").groupBy(query_col, "segment", "range", "term").agg(F.max(w).alias("most"))
    return asked, best.groupBy(query_col, "segment", "range").agg(F.sum("most").alias("bound"), F.count(F.lit(1)).alias("blocks"))


def scored(index: TermIndex, asked: DataFrame, ranges: DataFrame, k: int, query_col: str = "query_id") -> DataFrame:
    """(query, segment, range, place, score) of the given (query, segment, range): of each the k best chunks and those equal to the k-th.

    The blocks of a range and the queries that it is open to meet in one task, which multiplies the weights of its chunks with the terms
    of the queries, so no pair of posting and query is a row. Terms too many to be sent are joined.
    """
    known = asked.limit(bm25.MOST_TERMS_SENT + 1).toArrow()
    if known.num_rows > bm25.MOST_TERMS_SENT:
        return scored_by_joins(index, asked, ranges, query_col)
    words, named = pc.unique(known["term"].combine_chunks()), known[query_col].combine_chunks().dictionary_encode("encode")
    word = pc.index_in(known["term"].combine_chunks(), value_set=words).to_numpy(zero_copy_only=False).astype(np.int64)
    who, names = named.indices.to_numpy(zero_copy_only=False).astype(np.int64), named.dictionary
    n, df = (known[c].to_numpy().astype(float) for c in ("n_chunks", "df"))
    idf, average = np.zeros(len(words)), max(1.0, known["avg_len"][0].as_py()) if known.num_rows else 1.0
    idf[word] = np.log(1.0 + (n - df + 0.5) / (df + 0.5))
    schema = ST.StructType([asked.schema[query_col], *ST._parse_datatype_string("segment string, range long, place int, score double").fields])
    none = pa.table({f.name: pa.array([], t) for f, t in zip(schema.fields, (names.type, pa.string(), pa.int64(), pa.int32(), pa.float64()))})

    def run(key: tuple, blocks: pa.Table, open_: pa.Table) -> pa.Table:
        if not blocks.num_rows or not open_.num_rows:
            return none
        mine = pc.index_in(blocks["term"].combine_chunks(), value_set=words).to_numpy(zero_copy_only=False).astype(np.int64)
        lists = pa.concat_arrays(blocks["postings"].chunks)
        used, at = np.unique(mine, return_inverse=True)
        column = np.repeat(at, pc.list_value_length(lists).to_numpy(zero_copy_only=False))
        place, tf, length = (lists.flatten().field(c).to_numpy(zero_copy_only=False) for c in ("place", "tf", "len"))
        weights = np.zeros((int(place.max()) + 1, len(used)))
        weights[place, column] = idf[used[column]] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / average))
        queries = np.unique(pc.index_in(open_[query_col].combine_chunks(), value_set=names).to_numpy(zero_copy_only=False).astype(np.int64))
        here = np.isin(word, used)
        size, found = max(1, bm25.CELLS // max(weights.shape)), []
        for lo in range(0, len(queries), size):
            part = queries[lo : lo + size]
            own = here & np.isin(who, part)
            matrix = np.zeros((len(used), len(part)))
            np.add.at(matrix, (np.searchsorted(used, word[own]), np.searchsorted(part, who[own])), 1.0)
            score = np.floor(weights @ matrix * 1e9 + 0.5) / 1e9
            bar = np.partition(score, len(score) - k, axis=0)[len(score) - k] if len(score) > k else np.zeros(len(part))
            row, query = np.nonzero((score > 0) & (score >= bar))
            found.append((part[query], row, score[row, query]))
        query, row, score = (np.concatenate(x) for x in zip(*found))
        made = [names.take(pa.array(query)), pa.array([key[0].as_py()] * len(row), pa.string()), pa.array(np.full(len(row), key[1].as_py())), pa.array(row.astype(np.int32)), pa.array(score)]
        return pa.Table.from_arrays(made, schema.names)

    met = ranges.select("segment", "range").distinct()
    blocks = index.postings().select("segment", "range", "term", "postings").join(asked.select("term").distinct(), "term", "left_semi").join(met, ["segment", "range"], "left_semi")
    blocks, open_ = blocks.select("segment", "range", "term", "postings"), ranges.select("segment", "range", query_col)
    return blocks.groupBy("segment", "range").cogroup(open_.groupBy("segment", "range")).applyInArrow(run, schema)


def scored_by_joins(index: TermIndex, asked: DataFrame, ranges: DataFrame, query_col: str = "query_id") -> DataFrame:
    """(query, segment, range, place, score) of all chunks of the given (query, segment, range)."""
    near = index.postings().select("term", "segment", "range", "postings").join(asked, "term").join(ranges.select(query_col, "segment", "range"), [query_col, "segment", "range"])
    each = near.select(query_col, "segment", "range", "n_chunks", "avg_len", "df", F.inline("postings"))
    w = bm25.weight(F.col("n_chunks"), F.col("df"), F.col("tf"), F.col("len"), F.col("avg_len"))
    return each.groupBy(query_col, "segment", "range", "place").agg(F.round(F.sum(w), 9).alias("score"))


def top_k(index: TermIndex, queries: DataFrame, k: int, query_col: str = "query_id", query_text: str = "query", probes: int = PROBES, told: dict | None = None) -> DataFrame:
    """(query, rank, chunk_id, score) of each query's k best chunks; ties go to the smaller id. ``told`` gets counts of blocks."""
    if not index.segments():
        return index.spark.createDataFrame([], f"{query_col} {queries.schema[query_col].dataType.simpleString()}, rank long, chunk_id string, score double")
    asked, limits = bounds(index, queries, query_col, query_text)
    asked, limits = kept(asked, "asked"), kept(limits, "limits")
    first = F.row_number().over(W.partitionBy(query_col).orderBy(F.desc("bound"), "segment", "range"))
    probed = limits.withColumn("nth", first).where(F.col("nth") <= probes)
    early = kept(scored(index, asked, probed, k, query_col), "early")
    nth = F.row_number().over(W.partitionBy(query_col).orderBy(F.desc("score")))
    bar = early.withColumn("nth", nth).where(F.col("nth") == k).select(query_col, F.col("score").alias("bar"))
    others = limits.join(probed.select(query_col, "segment", "range"), [query_col, "segment", "range"], "left_anti")
    open_ = others.join(bar, query_col, "left").where(F.col("bar").isNull() | (F.col("bound") + SLACK >= F.col("bar")))
    if told is not None:
        told["blocks"], told["read"] = limits.agg(F.sum("blocks")).first()[0], (probed.agg(F.sum("blocks")).first()[0] or 0) + (open_.agg(F.sum("blocks")).first()[0] or 0)
    found = early.unionByName(scored(index, asked, kept(open_, "open-ranges"), k, query_col))
    best = found.withColumn("nth", F.rank().over(W.partitionBy(query_col).orderBy(F.desc("score")))).where(F.col("nth") <= k).drop("nth")
    named = best.join(index.forward().select("segment", "range", "place", "chunk_id"), ["segment", "range", "place"])
    return bm25.top_k(named.select(query_col, "chunk_id", "score"), k, by=(query_col,)).select(query_col, "rank", "chunk_id", "score")
