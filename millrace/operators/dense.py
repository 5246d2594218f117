"""Dense ranking by cosine and fusion of rankings."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = 1024  # vectors of either side in one matrix product


def unit_blocks(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(ids, units): vectors of length one in double precision, up to ``BLOCK`` equally long ones to a row, by id.

    Rows without an id and vectors that are null, empty, zero or not finite throughout are left out.
    """
    picked = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy(zero_copy_only=False)
            for n in np.unique(size[size > 0]).tolist():
                rows = np.flatnonzero(size == n)
                v = batch.column(1).take(pa.array(rows)).flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
                top = np.abs(v).max(axis=1)
                good = np.isfinite(top) & (top > 0)
                v, rows = v[good] / top[good, None], rows[good]
                v /= np.sqrt((v * v).sum(axis=1))[:, None]
                ids = batch.column(0).take(pa.array(rows))
                order = pc.sort_indices(ids).to_numpy()
                for lo in range(0, len(order), BLOCK):
                    part = order[lo : lo + BLOCK]
                    own = ids.take(pa.array(part))
                    yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(own)], pa.int32()), own), pa.array([v[part].tobytes()], pa.binary())], ["ids", "units"])

    return picked.mapInArrow(run, T.StructType([T.StructField("ids", T.ArrayType(picked.schema["id"].dataType)), T.StructField("units", T.BinaryType())]))


def cosine_top_k(vectors: DataFrame, queries: DataFrame, k: int, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, id, rank, score): the k nearest vectors of each query other than itself, ties by id.

    A stated set of queries meets all vectors: each pair of blocks is a matrix product that keeps the k best of each query, so
    at most k rows a query and block are moved. Vectors without a direction, and those of another length than a query, have no rank.
    """
    v = unit_blocks(vectors, id_col, vector_col)
    q = unit_blocks(queries, id_col, vector_col).select(F.col("ids").alias("query_ids"), F.col("units").alias("query_units"))
    kind = v.schema["ids"].dataType.elementType
    out = T.StructType([T.StructField("query_id", kind), T.StructField(id_col, kind), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, query_ids = batch.column(0)[i].values, batch.column(2)[i].values
                a = np.frombuffer(batch.column(1)[i].as_buffer(), np.float64).reshape(len(ids), -1)
                b = np.frombuffer(batch.column(3)[i].as_buffer(), np.float64).reshape(len(query_ids), -1)
                if a.shape[1] != b.shape[1]:
                    continue
                scores = np.round(b @ a.T, 6)
                scores[query_ids.to_numpy(zero_copy_only=False)[:, None] == ids.to_numpy(zero_copy_only=False)] = -np.inf
                best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                found = np.take_along_axis(scores, best, axis=1)
                of, at = np.nonzero(found > -np.inf)
                yield pa.RecordBatch.from_arrays([query_ids.take(pa.array(of)), ids.take(pa.array(best[of, at])), pa.array(found[of, at])], out.names)

    rows = v.crossJoin(q).mapInArrow(run, out).withColumn("score", F.round("score", 6))
    outer = W.partitionBy("query_id").orderBy(F.desc("score"), id_col)
    return rows.withColumn("rank", F.row_number().over(outer).cast("long")).where(F.col("rank") <= k).select("query_id", id_col, "rank", "score")


def reciprocal_rank_fusion(rankings: list[DataFrame], id_col: str, constant: int = 60) -> DataFrame:
    """(query_id, id, score, rank) from rankings (query_id, id, rank): the sum of 1 / (constant + rank)."""
    rows = rankings[0]
    for r in rankings[1:]:
        rows = rows.unionByName(r)
    fused = rows.groupBy("query_id", id_col).agg(F.round(F.sum(F.lit(1.0) / (F.col("rank") + constant)), 9).alias("score"))
    return fused.withColumn("rank", F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), id_col)).cast("long"))
