"""Embedding near-duplicates: cross-polytope hashing after fast Hadamard rotations, multiprobe buckets, verified pairs.

A rotation is three rounds of random signs and a fast Hadamard transform; its hash is the signed axis that is nearest to
the rotated vector. A table's bucket joins ``functions`` such hashes. A vector stands in its own bucket of each table
and also looks into the ``probes`` buckets that come next by the projections it would have to give up. Vectors that are
equal are hashed once, and their keys travel beside them. Buckets where nothing can meet are dropped before any vector
is sent; the others are cut into blocks of bounded size, and every two blocks of a bucket are compared by matrix products
in double precision, so no pair is ever a row. A pair that meets in several buckets counts in the first table where it
does, there in the least bucket. Each pair of blocks returns its members' link counts and a spanning star of each group
of links; components follow by star contraction.

A group of n near copies costs n squared products, as each vector's links have to be counted, and sends its vectors n /
``BLOCK`` times; equal vectors cost one.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing and are their
own component; vectors of different lengths link with nothing of another length; rows without an id keep their
row, link with nothing and are not kept; repeated rows are vectors of their own that link with each other; other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textvec as tv
from millrace.llm.shared import connected_components, cut, join_dealt, quoted, ship_package

BLOCK = 4096  # members of a bucket that are compared with one another, or with as many others, in one step
TILE = 512  # of them at once
FEW = 64  # members up to which the pairs of many buckets are compared together
HOT_COPIES = 50_000  # rows of one vector that a task takes, at least


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, d = x.shape
    step = 1
    while step < d:
        y = x.reshape(n, d // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        step *= 2
    return x / np.sqrt(d)


class CrossPolytope:
    """Bucket keys of unit vectors: own buckets (rows by table), and those to probe (rows by table by probe).

    A key has 32 bits. Different buckets of a table may share one; all that follows goes by keys, so they are one bucket.
    """

    def __init__(self, width: int, tables: int, functions: int, probes: int, seed: int):
        self.width, self.tables, self.functions, self.probes = width, tables, functions, probes
        self.padded = 1 << max(1, (width - 1).bit_length())
        rng = np.random.default_rng([seed, width])
        self.signs = rng.choice([-1.0, 1.0], size=(tables, functions, 3, self.padded))
        choices = np.stack(np.meshgrid(*[np.arange(probes + 1)] * functions, indexing="ij"), axis=-1).reshape(-1, functions)
        self.choices = choices[np.lexsort((*choices.T, choices.sum(axis=1)))][: (probes + 1) ** functions]

    def keys(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(unit)
        own = np.zeros((n, self.tables), np.uint32)
        near = np.zeros((n, self.tables, self.probes), np.uint32)
        padded = np.zeros((n, self.padded))
        padded[:, : self.width] = unit
        most = min(self.probes + 1, self.padded)
        for t in range(self.tables):
            axes, loss = [], []
            for k in range(self.functions):
                y = padded
                for s in self.signs[t, k]:
                    y = hadamard(y * s)
                size = np.abs(y)
                top = np.argpartition(-size, most - 1, axis=1)[:, :most] if most < self.padded else np.tile(np.arange(self.padded), (n, 1))
                part = np.take_along_axis(size, top, axis=1)
                order = np.argsort(-part, axis=1, kind="stable")
                top, part = np.take_along_axis(top, order, axis=1), np.take_along_axis(part, order, axis=1)
                axes.append(2 * top + (np.take_along_axis(y, top, axis=1) > 0))
                loss.append(part[:, :1] ** 2 - part**2)
            choices = self.choices[(self.choices < most).all(axis=1)]
            total = sum(loss[k][:, choices[:, k]] for k in range(self.functions))
            best = np.argsort(total, axis=1, kind="stable")[:, : self.probes + 1]
            code = np.full((n, best.shape[1]), t * 1_000_003 + self.width * 7919, np.uint64)
            for k in range(self.functions):
                code = tv.mix(code * np.uint64(1 << 20) + np.take_along_axis(axes[k], choices[best][:, :, k], axis=1).astype(np.uint64))
            code = (code >> np.uint64(32)).astype(np.uint32)
            own[:, t] = code[:, 0]
            near[:, t] = code[:, 1:] if best.shape[1] == self.probes + 1 else np.pad(code[:, 1:], ((0, 0), (0, self.probes + 1 - best.shape[1])), mode="edge")
        return own, near


def _matrix(vectors: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """(rows, unit vectors in double precision) for each width among lists of floats."""
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    size = np.array(vectors.value_lengths(), np.int64)
    begin = np.concatenate([[0], np.cumsum(size)])
    out = []
    for width in np.unique(size).tolist():
        rows = np.flatnonzero(size == width)
        x = flat[begin[rows][:, None] + np.arange(width)]
        peak = np.abs(x).max(axis=1, keepdims=True)
        x = x / peak  # so that no square overflows or vanishes
        out.append((rows, x / np.linalg.norm(x, axis=1, keepdims=True)))
    return out


def valid_vector(vector):
    """Not null, not empty, no null or non-finite component, not zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def hashed(classes: DataFrame, hasher: dict) -> DataFrame:
    """The classes (id, copies, vector) with ``keys``: own keys and those to probe, as little-endian bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, CrossPolytope] = {}
        for batch in batches:
            keys: list[bytes] = [b""] * batch.num_rows
            for rows, unit in _matrix(batch.column(2)):
                width = unit.shape[1]
                made.setdefault(width, CrossPolytope(width, **hasher))
                for at in range(0, len(rows), 2048):
                    own, near = made[width].keys(unit[at : at + 2048])
                    flat = np.concatenate([own, near.reshape(len(near), -1)], axis=1)
                    for r, raw in zip(rows[at : at + 2048].tolist(), flat):
                        keys[r] = raw.tobytes()
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())], ["id", "copies", "vector", "keys"])

    kind = classes.schema["vector"].dataType.simpleString()
    return classes.select("id", "copies", "vector").mapInArrow(run, f"id long, copies long, vector {kind}, keys binary")


def _keys(column: pa.Array, tables: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """(own, near) of a column of keys."""
    raw = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    width = tables * (1 + probes)
    flat = np.frombuffer(b"".join(raw.to_pylist()), np.uint32).reshape(-1, width)
    return flat[:, :tables], flat[:, tables:].reshape(-1, tables, probes)


def bucket_rows(classes: DataFrame, tables: int, probes: int) -> DataFrame:
    """(bucket, id, own): a row for each own and each probed bucket of each class; a bucket is table and key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.arange(tables, dtype=np.int64) << 32
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at in range(0, len(ids), 4096):
                own, near = _keys(batch.column(1).slice(at, 4096), tables, probes)
                every = np.concatenate([(own + table).ravel(), (near + table[:, None]).ravel()])
                who = np.concatenate([np.repeat(ids[at : at + 4096], tables), np.repeat(ids[at : at + 4096], tables * probes)])
                yield pa.RecordBatch.from_arrays([pa.array(every), pa.array(who), pa.array(np.arange(len(every)) < own.size)], ["bucket", "id", "own"])

    return classes.select("id", "keys").mapInArrow(run, "bucket long, id long, own boolean").groupBy("bucket", "id").agg(F.max("own").alias("own"))


def first_met(bucket, a: np.ndarray, b: np.ndarray, own: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Which of the pairs (a, b) meet in no table before that of ``bucket``, where they meet, and in no lesser bucket of it.

    ``bucket`` is one for all pairs or one for each.
    """
    bucket = np.broadcast_to(np.asarray(bucket, np.int64), a.shape)

    def probes(x, y, t):
        return (near[x, t] == own[y, t][:, None]).any(axis=1)

    table, key = bucket >> 32, (bucket & 0xFFFFFFFF).astype(np.uint32)
    left = np.arange(len(a))
    for t in range(int(table.max(initial=0))):
        x, y = a[left], b[left]
        left = left[(own[x, t] != own[y, t]) | (table[left] <= t)]
        x, y = a[left], b[left]
        left = left[~(probes(x, y, t) | probes(y, x, t)) | (table[left] <= t)]
    x, y, t, k = a[left], b[left], table[left], key[left]
    first = own[x, t] == k
    other = np.where(first, own[y, t], own[x, t])  # the only other bucket where they may meet
    there = np.where(first, probes(x, y, t), probes(y, x, t))
    return left[~(there & (other < k))]


def stars(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n members the least member that the links reach."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        after = root.copy()
        np.minimum.at(after, a, low)
        np.minimum.at(after, b, low)
        after = after[after]
        if (after == root).all():
            return root
        root = after


def links_between(bucket: int, pair: tuple[int, int], block: np.ndarray, own: np.ndarray, unit: np.ndarray, keys: tuple[np.ndarray, np.ndarray], copies: np.ndarray, threshold: float):
    """(links, root) of the members: linked copies that are counted here, and the least member that these links reach."""
    n = len(block)
    left, right = np.flatnonzero(block == pair[0]), np.flatnonzero(block == pair[1])
    links, root, every = np.zeros(n, np.int64), np.arange(n), np.arange(n)
    for i in range(0, len(left), TILE):
        rows = left[i : i + TILE]
        for j in range(i if pair[0] == pair[1] else 0, len(right), TILE):
            cols = right[j : j + TILE]
            good = unit[rows] @ unit[cols].T >= threshold
            good &= own[rows][:, None] | own[cols][None, :]
            x, y = np.nonzero(good)
            a, b = rows[x], cols[y]
            if pair[0] == pair[1]:
                a, b = a[a < b], b[a < b]
            if not len(a):
                continue
            here = first_met(bucket, a, b, *keys)
            a, b = a[here], b[here]
            links += np.bincount(a, weights=copies[b], minlength=n).astype(np.int64) + np.bincount(b, weights=copies[a], minlength=n).astype(np.int64)
            root = stars(n, np.concatenate([a, every]), np.concatenate([b, root]))
    return links, root


def links_of_few(bucket: np.ndarray, first: np.ndarray, size: np.ndarray, apart: np.ndarray, block: np.ndarray, own: np.ndarray, unit: np.ndarray, keys: tuple[np.ndarray, np.ndarray], copies: np.ndarray, threshold: float):
    """(links, root) of all rows, from the pairs of many small groups at once: rows first[g] .. first[g] + size[g] - 1 each."""
    n = len(unit)
    owner, k = tv.ragged(size)
    ahead = size[owner] - 1 - k
    a, step = tv.ragged(ahead)
    group, a = owner[a], (first[owner] + k)[a]
    b = a + 1 + step
    good = (own[a] | own[b]) & (~apart[group] | (block[a] != block[b]))
    group, a, b = group[good], a[good], b[good]
    for at in range(0, len(a), 16_384):
        part = slice(at, at + 16_384)
        good[at : at + 16_384][: len(a[part])] = np.einsum("ij,ij->i", unit[a[part]], unit[b[part]]) >= threshold
    good = good[: len(a)]
    group, a, b = group[good], a[good], b[good]
    here = first_met(bucket[group], a, b, *keys)
    a, b = a[here], b[here]
    links = np.bincount(a, weights=copies[b], minlength=n).astype(np.int64) + np.bincount(b, weights=copies[a], minlength=n).astype(np.int64)
    return links, stars(n, a, b)


def compare_blocks(rows: DataFrame, tables: int, probes: int, threshold: float) -> DataFrame:
    """(id, links, root) from rows (bucket, i, j, block, id, own, copies, vector, keys) that stand sorted by (bucket, i, j)."""

    def solved(table: pa.Table):
        bucket, i, j, ids, copies, block, own = (table.column(n).to_numpy() for n in ("bucket", "i", "j", "id", "copies", "block", "own"))
        every = _keys(table.column("keys"), tables, probes)
        bounds = np.array([lo for lo, _ in _groups(table)])
        group = np.repeat(np.arange(len(bounds)), np.diff(np.append(bounds, table.num_rows)))
        for sel, unit in _matrix(table.column("vector")):
            of, size = np.unique(group[sel], return_counts=True)
            first, keys = np.cumsum(size) - size, (every[0][sel], every[1][sel])
            at = bounds[of]
            few = np.flatnonzero((size > 1) & (size <= FEW))
            parts = [(slice(None), *links_of_few(bucket[at[few]], first[few], size[few], i[at[few]] != j[at[few]], block[sel], own[sel], unit, keys, copies[sel], threshold))]
            for g in np.flatnonzero(size > FEW).tolist():
                own_rows = slice(first[g], first[g] + size[g])
                some = sel[own_rows]
                parts.append((own_rows, *links_between(int(bucket[at[g]]), (i[at[g]], j[at[g]]), block[some], own[some], unit[own_rows], (keys[0][own_rows], keys[1][own_rows]), copies[some], threshold)))
            for own_rows, links, root in parts:
                some, linked = ids[sel[own_rows]], np.flatnonzero(links)
                if len(linked):
                    yield pa.RecordBatch.from_arrays([pa.array(some[linked]), pa.array(links[linked]), pa.array(some[root[linked]])], ["id", "links", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if _place(held[0], 0) == _place(batch, batch.num_rows - 1):
                continue  # still the first group
            table = pa.Table.from_batches(held)
            last = _groups(table)[-1][0]  # it may go on in the next batch
            yield from solved(table.slice(0, last))
            held = table.slice(last).to_batches()
        if held:
            yield from solved(pa.Table.from_batches(held))

    return rows.mapInArrow(run, "id long, links long, root long")


def _place(batch: pa.RecordBatch, row: int) -> tuple:
    return tuple(batch.column(n)[row].as_py() for n in ("bucket", "i", "j"))


def _groups(table: pa.Table) -> list[tuple[int, int]]:
    n = table.num_rows
    if not n:
        return []
    change = np.zeros(n, bool)
    change[0] = True
    for name in ("bucket", "i", "j"):
        x = table.column(name).to_numpy()
        change[1:] |= x[1:] != x[:-1]
    at = np.flatnonzero(change)
    return list(zip(at.tolist(), [*at[1:].tolist(), n]))


def embedding_components(vectors: DataFrame, threshold: float = 0.95, tables: int = 16, functions: int = 3, probes: int = 4, seed: int = 7, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id, n_links, component_id, kept) for every row."""
    ship_package(vectors.sparkSession)
    hasher = {"tables": tables, "functions": functions, "probes": probes, "seed": seed}
    narrow = vectors.select(quoted(vector_col)).schema[0].dataType.simpleString() == "array<float>"
    kind = "array<float>" if narrow else "array<double>"
    every = vectors.select(quoted(id_col).cast("long").alias(id_col), quoted(vector_col).cast(kind).alias("vector"))
    usable = valid_vector(F.col("vector")) & quoted(id_col).isNotNull()
    classes = every.where(usable).groupBy("vector").agg(F.min(id_col).alias("id"), F.count(F.lit(1)).alias("copies"))
    classes = cut(hashed(classes, hasher))
    placed = cut(bucket_rows(classes, tables, probes))
    crowded = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("own").alias("any_own")).where("n > 1 AND any_own").select("bucket", "n", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    met = join_dealt(placed, crowded, "bucket", "id", BLOCK).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    paired = met.withColumn("o", other).select("bucket", F.least("block", "o").alias("i"), F.greatest("block", "o").alias("j"), "block", "id", "own")
    rows = paired.join(classes, "id").select("bucket", "i", "j", "block", "id", "own", "copies", "vector", "keys")
    wide = max(vectors.sparkSession.sparkContext.defaultParallelism, int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = cut(compare_blocks(rows.repartition(wide, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j"), tables, probes, threshold))
    links = found.groupBy("id").agg(F.sum("links").alias("others"))
    parts = connected_components(found.select(F.col("id").alias("u"), F.col("root").alias("v")))
    named = (
        classes.join(links, "id", "left")
        .join(parts, F.col("id") == F.col("node"), "left")
        .select("vector", F.col("copies").alias("n"), (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    )
    good = join_dealt(every.where(usable), named, "vector", id_col, HOT_COPIES).select(id_col, "n_links", "component_id")
    bad = every.where(~F.coalesce(usable, F.lit(False))).select(id_col, F.lit(0).cast("long").alias("n_links"), F.col(id_col).alias("component_id"))
    return good.unionByName(bad).withColumn("kept", F.coalesce(quoted(id_col) == F.col("component_id"), F.lit(False)))
