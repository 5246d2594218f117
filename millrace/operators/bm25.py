"""BM25 ranking. Only postings of query terms, or each task's best chunks, are ever shuffled; document frequencies come from postings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from millrace.functions.text import term_runs, tokens
from millrace.sources.session import kept


MOST_TERMS_SENT = 2_000_000  # rows (query, term) up to which they are sent to every executor
TASK_ROWS = 4_000_000  # pairs of a posting and a query that one task adds up
BLOCK = 1024  # chunks in one matrix product, at most
CELLS = 4_000_000  # cells of a matrix, at most


def term_frequencies(chunks: DataFrame, id_col: str = "chunk_id", text_col: str = "embed_text") -> DataFrame:
    """(id, term, tf, len): how often each term occurs, and how many terms the text has; counted within each row."""
    rows = chunks.select(id_col, tokens(text_col).alias("terms"))
    rows = rows.select(id_col, F.size("terms").cast("long").alias("len"), F.explode(term_runs("terms")).alias("run"))
    return rows.select(id_col, "run.term", "run.tf", "len")


def collection_stats(chunks: DataFrame, text_col: str = "embed_text") -> DataFrame:
    """One row: n_chunks, total_len and avg_len."""
    n = F.count(F.lit(1))
    total = F.coalesce(F.sum(F.size(tokens(text_col)).cast("long")), F.lit(0)).cast("long")
    return chunks.agg(n.alias("n_chunks"), total.alias("total_len"), (total / F.greatest(F.lit(1), n)).alias("avg_len"))


def weight(n, df, tf, length, average):
    """The weight of a term in a text, in double precision throughout."""
    d = [x.cast("double") for x in (n, df, tf, length, average)]
    idf = F.ln(F.lit(1.0) + (d[0] - d[1] + 0.5) / (d[1] + 0.5))
    return idf * d[2] * 2.2 / (d[2] + F.lit(1.2) * (F.lit(0.25) + F.lit(0.75) * d[3] / F.greatest(F.lit(1.0), d[4])))


def query_terms(queries: DataFrame, id_col: str = "query_id", text_col: str = "query") -> DataFrame:
    return queries.select(id_col, F.explode(F.array_distinct(tokens(text_col))).alias("term"))


def scores(chunks: DataFrame, queries: DataFrame, id_col: str = "chunk_id", text_col: str = "embed_text", query_col: str = "query_id", query_text: str = "query", keep: tuple[str, ...] = ()) -> DataFrame:
    """(query, keep..., chunk, score) of all chunks that share a term with the query; ``keep``: columns that split the collection.

    One pass over the collection counts documents for each asked term together with the collection's size (under a null
    term). A second one picks the postings of asked terms and deals them by chunk, so that the weighted terms of all
    queries meet them evenly and the sums need no exchange of their own. A posting becomes a row for each query that asks for
    its term only then, so the counts of the first pass tell how many tasks keep each of them small.
    """
    asked = query_terms(queries, query_col, query_text)
    by = list(keep)
    rows = chunks.select(*by, id_col, tokens(text_col).alias("terms"))
    small = asked.limit(MOST_TERMS_SENT + 1).count() <= MOST_TERMS_SENT

    def sent(terms: DataFrame) -> DataFrame:
        """Marked for broadcast if counted to be small; else the join is Spark's to choose."""
        return F.broadcast(terms) if small else terms

    nothing = F.array(F.lit(None).cast("string"))
    seen = rows.select(*by, F.size("terms").cast("long").alias("len"), F.explode(F.concat(nothing, F.array_distinct("terms"))).alias("term"))
    wanted = sent(asked.select("term").distinct().withColumn("asked", F.lit(True)))
    counts = seen.join(wanted, "term", "left").where("asked OR term IS NULL").groupBy(*by, "term").agg(F.count(F.lit(1)).alias("df"), F.sum("len").alias("total"))
    counts = kept(counts, "term-counts")  # a row for each asked term
    often = asked.groupBy("term").agg(F.count(F.lit(1)).alias("times"))
    pairs = counts.join(often, "term").agg(F.sum(F.col("df") * F.col("times"))).first()[0] or 0
    tasks = max(int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-pairs // TASK_ROWS))
    stats = counts.where("term IS NULL").select(*by, F.col("df").alias("n_chunks"), (F.col("total") / F.greatest(F.lit(1), F.col("df"))).alias("avg_len"))
    df = counts.where("term IS NOT NULL").select(*by, "term", "df")
    known = asked.join(df, "term").join(stats, by) if by else sent(asked.join(df, "term").crossJoin(F.broadcast(stats)))  # one row
    tf = rows.select(*by, id_col, F.size("terms").cast("long").alias("len"), F.explode(term_runs("terms")).alias("run")).select(*by, id_col, "len", "run.term", "run.tf")
    postings = tf.join(wanted, "term", "left_semi").repartition(tasks, id_col)
    w = weight(F.col("n_chunks"), F.col("df"), F.col("tf"), F.col("len"), F.col("avg_len"))
    # rounded, so that the order of summation can't decide a tie
    return postings.join(known, [*by, "term"]).groupBy(query_col, *by, id_col).agg(F.round(F.sum(w), 9).alias("score"))


def top_k(scored: DataFrame, k: int, id_col: str = "chunk_id", by: tuple[str, ...] = ("query_id",)) -> DataFrame:
    """The k best of each group with their rank; ties go to the smaller id."""
    if k < 1:
        raise ValueError("top_k must be positive")
    w = W.partitionBy(*by).orderBy(F.desc("score"), id_col)
    return scored.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= k)


def merged(held: tuple, more: tuple, k: int) -> tuple:
    """Of rows (query, score, id) the k best of each query; ties go to the smaller id."""
    query, score = np.concatenate([held[0], more[0]]), np.concatenate([held[1], more[1]])
    ids = pa.concat_arrays([held[2], more[2]])
    nth = pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy(zero_copy_only=False)
    order = np.lexsort([nth, -score, query])
    first = np.searchsorted(query[order], query[order])
    keep = order[np.arange(len(order)) - first < k]
    return query[keep], score[keep], ids.take(pa.array(keep))


def counted(terms: pa.ListArray, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(terms of each chunk; chunk, word and how often of the words found); chunk by chunk, each word once."""
    length = pc.fill_null(pc.list_value_length(terms), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    found = pc.index_in(terms.flatten(), value_set=words)
    met = found.is_valid().to_numpy(zero_copy_only=False)
    key, tf = np.unique(np.repeat(np.arange(len(length)), length)[met] * len(words) + found.drop_null().to_numpy(), return_counts=True)
    chunk, at = np.divmod(key, max(1, len(words)))
    return length, chunk, at, tf.astype(float)


def document_counts(rows: DataFrame, words: pa.Array) -> tuple[int, int, np.ndarray]:
    """(chunks, their terms, how many chunks hold each word) of rows (id, terms); each task counts its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n, total = np.zeros(len(words), np.int64), 0, 0
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                length, _, at, _ = counted(batch.column(0).slice(lo, BLOCK), words)
                df += np.bincount(at, minlength=len(words))
                total += int(length.sum())
            n += len(batch.column(0)) - batch.column(0).null_count
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([None, *at.tolist()], pa.int64()), pa.array([n, *df[at].tolist()], pa.int64()), pa.array([total] + [0] * len(at), pa.int64())], ["word", "n", "total"])

    sums = rows.select("terms").mapInArrow(run, "word long, n long, total long").groupBy("word").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).toArrow()
    df = np.zeros(len(words))
    own = sums.filter(pc.is_valid(sums["word"]))
    df[own["word"].to_numpy()] = own["n"].to_numpy()
    whole = sums.filter(pc.is_null(sums["word"])).to_pylist()
    return (whole[0]["n"], whole[0]["total"], df) if whole else (0, 0, df)


def best(chunks: DataFrame, queries: DataFrame, k: int, id_col: str = "chunk_id", text_col: str = "embed_text", query_col: str = "query_id", query_text: str = "query") -> DataFrame:
    """The same rows as ``top_k(scores(chunks, queries), k)``, without a row for each pair of chunk and query.

    One pass counts the documents of asked terms. In a second one every task multiplies blocks of its chunks (weights of asked terms) with the
    terms of the queries and keeps the k best of each query, so at most k rows a query and task are shuffled. Queries that
    are too many to be sent to the tasks are joined by ``scores``. Rows that share an id are brought together and add up.
    """
    if k < 1:
        raise ValueError("top_k must be positive")
    asked = query_terms(queries, query_col, query_text)
    if asked.limit(MOST_TERMS_SENT + 1).count() > MOST_TERMS_SENT:
        return top_k(scores(chunks, queries, id_col, text_col, query_col, query_text), k, id_col, (query_col,))
    rows = chunks.select(id_col, tokens(text_col).alias("terms"))
    known = asked.toArrow()  # at most MOST_TERMS_SENT rows
    words = pc.unique(known["term"].combine_chunks())
    n, total, df = document_counts(rows, words)
    average = total / max(1, n)
    again = chunks.groupBy(id_col).count().where("count > 1").first() is not None
    if again:
        tasks = max(int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.rdd.getNumPartitions())
        rows = rows.repartition(tasks, id_col).sortWithinPartitions(id_col)

    word = pc.index_in(known["term"].combine_chunks(), value_set=words).to_numpy(zero_copy_only=False).astype(np.int64)
    # equal rows of a query count once, as its terms do; queries that share an id add up
    named = known[query_col].combine_chunks().dictionary_encode("encode")
    who, names = named.indices.to_numpy(zero_copy_only=False).astype(np.int64), named.dictionary
    idf = np.log(1.0 + (n - df + 0.5) / (df + 0.5))
    size = max(1, CELLS // max(1, len(words)))  # queries in one matrix product
    out = ST.StructType([queries.schema[query_col], chunks.schema[id_col], ST.StructField("score", ST.DoubleType())])

    def weights(terms: pa.ListArray):
        """(chunk, word, weight) of the asked terms of a block."""
        length, chunk, at, tf = counted(terms, words)
        return chunk, at, idf[at] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length[chunk] / max(1.0, average)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        groups = []
        for lo in range(0, len(names), size):
            own = (who >= lo) & (who < lo + size)
            used = np.unique(word[own])
            matrix = np.zeros((len(used), min(size, len(names) - lo)))
            np.add.at(matrix, (np.searchsorted(used, word[own]), who[own] - lo), 1.0)
            groups.append((lo, used, matrix))
        held, bar = None, np.full(len(names), -np.inf)
        left = None  # the last id's sums, which may go on in the next block

        def take(ids: pa.Array, lo: int, sums: np.ndarray) -> None:
            """Keep what may be among the k best."""
            nonlocal held
            score = np.where(sums > 0, np.floor(sums * 1e9 + 0.5) / 1e9, -np.inf)
            if len(score) > k:
                near = np.maximum(np.partition(score, len(score) - k, axis=0)[len(score) - k], bar[lo : lo + score.shape[1]])
            else:
                near = bar[lo : lo + score.shape[1]]
            at, query = np.nonzero((score >= near) & (score > -np.inf))
            if not len(at):
                return
            more = (query + lo, score[at, query], ids.take(pa.array(at)))
            held = merged(held or tuple(x[:0] for x in more), more, k)
            count = np.bincount(held[0], minlength=len(names))
            last = np.cumsum(count) - 1
            bar[count == k] = held[1][last[count == k]]

        for batch in batches:
            step = max(1, min(BLOCK, CELLS // max([1] + [len(u) for _, u, _ in groups])))
            for lo in range(0, batch.num_rows, step):
                ids, terms = batch.column(0).slice(lo, step), batch.column(1).slice(lo, step)
                if left is not None:
                    ids = pa.concat_arrays([left[0], ids])
                chunk, at, w = weights(terms)
                sums = []
                for _, used, matrix in groups:
                    place = np.searchsorted(used, at)
                    met = place < len(used)
                    met[met] = used[place[met]] == at[met]
                    block = np.zeros((len(terms), len(used)))
                    block[chunk[met], place[met]] = w[met]
                    sums.append(block @ matrix)
                if again:
                    if left is not None:
                        sums = [np.concatenate([a, b]) for a, b in zip(left[1], sums)]
                    nth = pc.rank(ids, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy(zero_copy_only=False)
                    start = np.flatnonzero(np.append(True, nth[1:] != nth[:-1]))
                    sums, ids = [np.add.reduceat(s, start, axis=0) for s in sums], ids.take(pa.array(start))
                    left = ids[-1:], [s[-1:] for s in sums]
                    sums, ids = [s[:-1] for s in sums], ids[:-1]
                for (first, _, _), s in zip(groups, sums):
                    take(ids, first, s)
        if left is not None:
            for (first, _, _), s in zip(groups, left[1]):
                take(left[0], first, s)
        if held is not None:
            yield pa.RecordBatch.from_arrays([names.take(pa.array(held[0])), held[2], pa.array(held[1])], out.names)

    return top_k(rows.mapInArrow(run, out), k, id_col, (query_col,))
