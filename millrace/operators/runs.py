"""Which texts hold which runs of words: candidates by a sum over each run, looked up in blocks of texts.

Words that no run holds are zero; a run of n words is the wrapping sum of their random numbers times powers of an odd number, so equal
runs have equal sums. Different runs may share one: what is found are candidates that the caller checks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_SENT = 2_000_000  # runs that are sent to every task
ODD = 0x9E3779B97F4A7C15


def sums(values: np.ndarray, n: int) -> np.ndarray:
    """The sum of every ``n`` neighbours."""
    out = np.zeros(max(0, len(values) - n + 1), np.uint64)
    for i in range(n):
        out += values[i : i + len(out)] * np.uint64(pow(ODD, i, 1 << 64))
    return out


def meeting(texts: DataFrame, keyed: DataFrame, words_col: str = "words", key_col: str = "key") -> DataFrame:
    """(the other columns of both): pairs of a text (words) and a run (key, at least one word) that it may hold; all that it does hold.

    The runs are a stated set of at most MOST_SENT; more of them are an error.
    """
    held = keyed.where(F.size(key_col) > 0).limit(MOST_SENT + 1).toArrow().combine_chunks()
    if held.num_rows > MOST_SENT:
        raise ValueError(f"more than {MOST_SENT} runs")
    carried, told = [c for c in texts.columns if c != words_col], [c for c in keyed.columns if c != key_col]
    schema = T.StructType([*(texts.schema[c] for c in carried), *(keyed.schema[c] for c in told)])
    given = pa.concat_arrays(held[key_col].chunks) if held.num_rows else pa.array([], pa.list_(pa.string()))
    words = pc.unique(given.flatten())
    number = np.random.default_rng(7).integers(1, 1 << 63, len(words) + 1, dtype=np.uint64)
    number[-1] = 0  # a word of no run
    lengths = pc.list_value_length(given).to_numpy(zero_copy_only=False).astype(np.int64)
    of = number[pc.index_in(given.flatten(), value_set=words).to_numpy(zero_copy_only=False).astype(np.int64)]
    begin = np.concatenate([[0], np.cumsum(lengths)])
    codes = {}
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        code = np.array([sums(of[begin[r] : begin[r] + n], n)[0] for r in rows], np.uint64)
        order = np.argsort(code, kind="stable")
        codes[n] = code[order], rows[order]
    names = held.select(told)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(len(carried))
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            at = pc.fill_null(pc.index_in(lists.flatten(), value_set=words), len(words)).to_numpy(zero_copy_only=False)
            values, owner = number[at], np.repeat(np.arange(len(size)), size)
            for n, (code, rows) in codes.items():
                found = sums(values, n)
                lo, hi = np.searchsorted(code, found), np.searchsorted(code, found, side="right")
                place = np.flatnonzero((hi > lo) & (owner[: len(found)] == owner[n - 1 :][: len(found)]))
                many = (hi - lo)[place]
                nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                pair = np.unique(np.stack([np.repeat(owner[place], many), rows[np.repeat(lo[place], many) + nth]]), axis=1)
                if pair.shape[1]:
                    mine, theirs = pa.array(pair[0]), names.take(pa.array(pair[1])).combine_chunks()
                    yield pa.RecordBatch.from_arrays([*(batch.column(i).take(mine) for i in range(len(carried))), *(c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in theirs.columns)], schema.names)

    return texts.select(*carried, words_col).mapInArrow(run, schema)
