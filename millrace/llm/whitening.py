"""Whitening of embeddings by their principal components, with covariances merged pair by pair (Chan's formula).

Entries become integers x = floor(256 * c), so that counts, sums and deviations are exact. Every distinct x vector enters the
fit once. Each partition of the fit list gives its count, its exact sums, its mean and its scatter about that mean; two of
these become one by the pairwise formula in ``treeReduce``, so that no task or driver sees more than one d x d matrix per
branch. The driver takes the eigenvectors of the merged covariance; a second pass whitens the fit list and merges the
covariance of the result in the same way, to be held against the identity.

Defined cases: rows whose vector is null, empty, or holds null or non-finite entries are dropped; so are rows whose vector has
another length than most rows have (of equally frequent lengths the larger one counts). Rows with repeated or null ids stay,
each on its own. Entries beyond the range of a long end at its bounds; a deviation that doesn't fit in a long is null. A
direction without variance (no more than rounding leaves) has null ``whitened`` and does not count in ``identity_error``,
which is null if no direction has any; ``explained`` is null where the total variance is zero. With fewer than ``top``
dimensions there are fewer components. An empty table gives no row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import quoted, ship_package, write_table

SCALE = 256.0
TOP = 4
ROWS = 4096  # vectors that are worked on at once
LONG = 2**63


@dataclass
class Moments:
    """Count, exact sums, mean and scatter about the mean of some vectors."""

    n: int
    sums: np.ndarray  # Python integers
    mean: np.ndarray
    scatter: np.ndarray

    @staticmethod
    def of(rows: np.ndarray) -> Moments:
        wide = np.abs(rows.astype(np.float64)).max(initial=0) * len(rows) >= LONG / 2 if rows.dtype.kind == "i" else False
        sums = rows.astype(object).sum(axis=0) if wide else rows.sum(axis=0).astype(object)
        real = rows.astype(np.float64)
        mean = real.mean(axis=0)
        real = real - mean
        # what rounding has left in the mean is taken out of the centred rows once more
        rest = real.mean(axis=0)
        real -= rest
        return Moments(len(rows), sums, mean + rest, real.T @ real)

    def merged(self, other: Moments) -> Moments:
        """Chan's formula: the scatters add up, with the gap of the means weighed by the counts."""
        n = self.n + other.n
        gap = other.mean - self.mean
        return Moments(n, self.sums + other.sums, self.mean + gap * (other.n / n), self.scatter + other.scatter + np.outer(gap, gap) * (self.n * other.n / n))


def moments_of(parts: Iterator[np.ndarray]) -> Iterator[Moments]:
    """The moments of a partition, none if it is empty."""
    held = None
    for rows in parts:
        if len(rows):
            own = Moments.of(rows)
            held = own if held is None else held.merged(own)
    if held is not None:
        yield held


def matrix(column: pa.Array | pa.ChunkedArray, d: int) -> np.ndarray:
    """The lists of a column, all of length d, as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def merged_moments(fit: DataFrame, d: int, shape) -> Moments:
    """The moments of ``shape(x)`` over all vectors of a fit list that isn't empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pickle

        parts = (shape(matrix(b.column(0).slice(at, ROWS), d)) for b in batches for at in range(0, b.num_rows, ROWS))
        for made in moments_of(parts):
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(made)], pa.binary())], ["moments"])

    def loaded(row) -> Moments:
        import pickle

        return pickle.loads(row["moments"])

    return fit.mapInArrow(run, "moments binary").rdd.map(loaded).treeReduce(Moments.merged, depth=3)


@dataclass
class Whitener:
    """What a vector needs to be whitened; ``axes`` has a row for each component."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    explained: list[float | None]
    identity_error: float | None = None

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Components of some vectors, NaN for directions without variance; the mean is split so that it rounds late."""
        whole = np.array([s // self.n for s in self.sums], np.float64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        with np.errstate(divide="ignore", invalid="ignore"):
            return ((x.astype(np.float64) - whole - rest) @ self.axes.T) / np.where(self.values > 0, np.sqrt(self.values), np.nan)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of (n * x - S)**2, exact."""
        reach = max([1, *map(abs, self.sums)]) + self.n * float(np.abs(x.astype(np.float64)).max(initial=0))
        if reach**2 * x.shape[1] < LONG / 2:
            gap = x * np.int64(self.n) - np.array(self.sums, np.int64)
            return (gap * gap).sum(axis=1).tolist()
        gap = x.astype(object) * self.n - np.array(self.sums, object)
        return [s if s < LONG else None for s in (gap * gap).sum(axis=1)]


def fit_whitener(fit: DataFrame, d: int, top: int = TOP) -> Whitener:
    """The whitener of a fit list (x) that isn't empty, checked in a second pass."""
    found = merged_moments(fit, d, lambda x: x)
    covariance = found.scatter / found.n
    values, vectors = np.linalg.eigh((covariance + covariance.T) / 2)
    total = float(np.trace(covariance))
    order = np.argsort(-values, kind="stable")[:top]
    values, axes = values[order], vectors[:, order].T.copy()
    axes *= np.where(axes[np.arange(len(axes)), np.abs(axes).argmax(axis=1)] < 0, -1.0, 1.0)[:, None]
    values = np.where(values > d * 2.0**-50 * max(values.max(initial=0), 0), values, 0.0)
    made = Whitener(found.n, [int(s) for s in found.sums], axes, values, [float(v / total) if total > 0 else None for v in values])
    live = values > 0
    if live.any():
        again = merged_moments(fit, d, lambda x: made.whitened(x)[:, live])
        made.identity_error = float(np.abs(again.scatter / again.n - np.eye(int(live.sum()))).max())
    return made


def whiten(rows: DataFrame, vector_col: str = "embedding", id_col: str = "vec_id", top: int = TOP) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error) for every usable row and component up to ``top``."""
    spark = rows.sparkSession
    ship_package(spark)
    given = rows.select(quoted(id_col).alias("id"), F.transform(quoted(vector_col), lambda c: c.cast("double")).alias("c"))
    bad = F.exists("c", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    usable = given.where("size(c) > 0").where(~bad).select("id", F.transform("c", lambda c: F.floor(c * SCALE)).alias("x"))
    # the commonest length, from a count with one row for each length
    size = usable.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    kind = rows.schema[id_col].dataType
    out = f"id {kind.simpleString()}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if size is None:
        return spark.createDataFrame([], out).withColumnRenamed("id", id_col)
    d = size["d"]
    usable = usable.where(F.size("x") == d)
    model = fit_whitener(write_table(usable.select("x").distinct(), "whitening-fit"), d, top)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                x = matrix(part.column(1), d)
                z, k = model.whitened(x), len(model.axes)
                m = len(x)
                owner = pa.array(np.repeat(np.arange(m), k))
                flat = z.ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(owner),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, model.n, np.int64)),
                        pa.array(model.deviations(x), pa.int64()).take(owner),
                        pa.array(flat, mask=np.isnan(flat)),
                        pa.array(model.explained * m, pa.float64()),
                        pa.array([model.identity_error] * (m * k), pa.float64()),
                    ],
                    ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return usable.mapInArrow(run, out).withColumnRenamed("id", id_col)
