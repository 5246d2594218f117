"""Sorting of chosen suffixes of a block of text with a difference cover.

The cover D of period v has, for any two positions i and j, a shift d < v with both i + d and j + d in the sample of
positions whose residue is in D. Once the sample is ranked, any two suffixes are told apart by their first v bytes or
else by the ranks of two sampled positions, however long they agree. The sample is the only thing kept beside the
block, so memory is a small multiple of the block's bytes.
"""

from __future__ import annotations

import numpy as np

PERIOD = 32
COVER = (0, 1, 2, 3, 7, 11, 19)  # fixed values: every difference modulo 32 occurs


def shifts(period: int = PERIOD, cover: tuple[int, ...] = COVER) -> np.ndarray:
    """For two residues the least shift that brings both into the cover."""
    inside = np.zeros(period, bool)
    inside[list(cover)] = True
    at = np.arange(period)
    both = inside[(at[:, None, None] + at) % period] & inside[(at[None, :, None] + at) % period]
    if not both.any(axis=2).all():
        raise ValueError("not a difference cover")
    return both.argmax(axis=2)


_SHIFTS = shifts()
_NEXT = np.array([min((c - r) % PERIOD for c in COVER) for r in range(PERIOD)])


def words_at(text: np.ndarray) -> np.ndarray:
    """At each position its eight bytes as a big-endian number; zeros follow the end."""
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    out = np.zeros(len(text), np.uint64)
    for k in range(8):
        out |= padded[k : k + len(text)] << np.uint64(56 - 8 * k)
    return out


def _take(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.where(at < len(values), values[np.minimum(at, len(values) - 1)], 0)


def _named(keys: list[np.ndarray]) -> np.ndarray:
    """Ranks from 1 on of rows of keys; equal rows share one."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        s = k[order]
        new[1:] |= s[1:] != s[:-1]
    out = np.zeros(len(order), np.int64)
    out[order] = np.cumsum(new) + 1
    return out


def cover_ranks(words: np.ndarray, depth: int) -> np.ndarray:
    """At each sampled position the rank of its suffix by its first ``depth`` bytes or more; 0 elsewhere."""
    n = len(words)
    sample = np.flatnonzero(np.isin(np.arange(PERIOD), COVER)[np.arange(n) % PERIOD])
    rank = np.zeros(n + 1, np.int64)
    rank[sample] = _named([_take(words, sample + 8 * k) for k in range(PERIOD // 8)])
    known = PERIOD
    while known < depth:  # a shift by a multiple of the period stays in the sample
        rank[sample] = _named([rank[sample], rank[np.minimum(sample + known, n)]])
        known *= 2
    return rank


def sort_suffixes(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """An order of the suffixes that begin at ``at``, by ``depth`` bytes at least."""
    rank = cover_ranks(words, depth)
    last = len(rank) - 1
    residue = at % PERIOD
    keys = [_take(words, at + 8 * k) for k in range(PERIOD // 8)]
    order = np.lexsort([rank[np.minimum(at + _NEXT[residue], last)], residue, *keys[::-1]])
    tied = np.zeros(len(order), bool)
    tied[1:] = np.logical_and.reduce([k[order][1:] == k[order][:-1] for k in keys]) if len(order) > 1 else False
    mixed = tied.copy()
    mixed[1:] &= residue[order][1:] != residue[order][:-1]
    if not mixed.any():
        return order
    # Ties whose residues differ are merged by the ranks at their common shift.
    group = np.cumsum(~tied)
    for g in np.unique(group[mixed]).tolist():
        lo, hi = np.searchsorted(group, g), np.searchsorted(group, g, side="right")
        order[lo:hi] = _merged([list(part) for part in _by_residue(order[lo:hi], residue)], at, residue, rank, last)
    return order


def _by_residue(order: np.ndarray, residue: np.ndarray) -> list[np.ndarray]:
    r = residue[order]
    return np.split(order, np.flatnonzero(r[1:] != r[:-1]) + 1)


def _merged(parts: list[list[int]], at, residue, rank, last) -> list[int]:
    """Sorted runs, each of one residue, merged pairwise."""
    while len(parts) > 1:
        after = []
        for x, y in zip(parts[::2], parts[1::2]):
            out, i, j = [], 0, 0
            while i < len(x) and j < len(y):
                d = _SHIFTS[residue[x[i]], residue[y[j]]]
                if rank[min(at[x[i]] + d, last)] <= rank[min(at[y[j]] + d, last)]:
                    out.append(x[i])
                    i += 1
                else:
                    out.append(y[j])
                    j += 1
            after.append(out + x[i:] + y[j:])
        if len(parts) % 2:
            after.append(parts[-1])
        parts = after
    return parts[0]


def equal_runs(words: np.ndarray, at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, group): suffixes in order, and a number that those with the same first ``length`` (8 or more) bytes share."""
    order = sort_suffixes(words, at, length)
    same = np.ones(max(0, len(order) - 1), bool)
    for k in [*range(0, length - 7, 8), length - 8]:
        w = _take(words, at[order] + k)
        same &= w[1:] == w[:-1]
    return order, np.concatenate([[0], np.cumsum(~same)]) if len(order) else np.zeros(0, np.int64)
