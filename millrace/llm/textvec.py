"""Vectorised words and hashes over whole batches of UTF-8 texts (numpy on the Arrow buffers)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it can be inverted modulo 2**64
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the finaliser of splitmix64)."""
    x = np.asarray(x, dtype=np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
_tables = {"n": 0, "power": np.zeros(0, np.uint64), "inverse": np.zeros(0, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base, and of its inverse."""
    if _tables["n"] < n:
        size = max(n, 1 << 16)
        for name, base in (("power", _BASE), ("inverse", _BASE_INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _tables[name] = np.multiply.accumulate(steps)
        _tables["n"] = size
    return _tables["power"][:n], _tables["inverse"][:n]


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """S with S[e] - S[s] standing for the bytes s..e-1, still shifted by s."""
    power, _ = powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * power[: len(data)], out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans; equal spans have equal hashes wherever they stand."""
    _, inverse = powers(len(sums))
    return mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def blocks(text: pa.LargeStringArray, limit: int = 1 << 21) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of about ``limit`` bytes; a longer text is a run of its own."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    n = len(text)
    if n == 0:
        return
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + n + 1]
    raw = text.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
        to = min(n, max(at + 1, to))
        yield at, data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(accept) -> np.ndarray:
    """A table of 256 booleans: which byte values belong to a word."""
    return np.array([bool(accept(b)) for b in range(256)])


#: Words of letters, digits and everything beyond ASCII, after lower-casing.
WORD_BYTES = byte_class(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)
#: Words between the six ASCII white-space characters.
NONSPACE_BYTES = byte_class(lambda b: b != 32 and not 9 <= b <= 13)


def word_spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of the words; the words of text i are first[i]..first[i+1]-1. No word crosses texts."""
    inside = table[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(start)
    ends = np.flatnonzero(end) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def ragged(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, place within the owner) for ragged rows of the given lengths."""
    owner = np.repeat(np.arange(len(counts)), counts)
    first = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(counts) else np.zeros(0, np.int64)
    return owner, np.arange(len(owner)) - np.repeat(first, counts)
