"""Sum-of-squares packing of tokenised documents into training sequences.

Documents are tokenised, whole windows are cut off, and the rest of each document goes to the fill level that makes the
sum over all levels of (number of open windows at that level) squared smallest; ties go to the fullest level. The counts
per level are kept in an array. Every scan partition packs on its own first and writes its full windows. The pieces of
windows that are still open when it ends are packed once more, by as few tasks as ``REST_TOKENS`` allows, so that the
number of partitions doesn't decide the result. Only what is open at the very end is closed: those pieces are laid end to
end and cut every ``length`` tokens, and the last stretch is cut into powers of two, which need no padding. Memory
is bounded by the open windows of one partition and one block of texts.

Tokens come from a ``tokenizers`` file. A run of texts is split into the pre-tokens of the byte-level rule with array
operations; each different pre-token is encoded once by the tokenizer and kept in a bounded table under its own bytes
(those of more than 16 bytes are encoded anew in each block). Texts that hold a special token's string or a code point of
unknown class go through the tokenizer as they are.

Defined cases: null and empty texts are a document of the end token alone; repeated ids and rows are separate
documents; extra columns are not read; an empty table gives no row.
"""

from __future__ import annotations

import os
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textvec as tv
from millrace.llm.shared import quoted, release_memory, ship_package, write_table

REST_TOKENS = 1 << 23  # tokens of open windows that one task packs
SPACE, LETTER, NUMBER, OTHER, UNKNOWN = range(5)
#: White_Space beyond ASCII, and the endings that the pre-token rule splits off after an apostrophe.
WIDE_SPACES = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    out = np.full(0x110000, OTHER, np.uint8)
    for cp in range(0x110000):
        c = unicodedata.category(chr(cp))
        out[cp] = UNKNOWN if c in ("Cn", "Cs") else kinds.get(c[0], OTHER)
    out[list((9, 10, 11, 12, 13, 32, *WIDE_SPACES))] = SPACE
    return out


def split_pretokens(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the pre-tokens in the bytes of several texts, and the class of each byte."""
    n = len(data)
    kind = classes[:256][data]
    wide = np.flatnonzero(data >= 128)
    if len(wide):
        lead = data[wide] >= 0xC0
        at = wide[lead]
        b0 = data[at].astype(np.int64)
        pad = np.concatenate([data, np.zeros(4, np.uint8)]).astype(np.int64)
        b1, b2, b3 = (pad[at + k] & 63 for k in (1, 2, 3))
        cp = np.where(b0 < 0xE0, (b0 & 31) << 6 | b1, np.where(b0 < 0xF0, (b0 & 15) << 12 | b1 << 6 | b2, (b0 & 7) << 18 | b1 << 12 | b2 << 6 | b3))
        kind[wide] = classes[np.minimum(cp, 0x10FFFF)][np.cumsum(lead) - 1]
    first = np.zeros(n + 1, bool)
    first[offsets] = True  # also where an empty text stands
    change = first[:n].copy()
    change[1:] |= kind[1:] != kind[:-1]
    space = kind == SPACE
    blank_before = np.zeros(n, bool)
    blank_before[1:] = data[:-1] == 32
    blank_before &= ~first[:n]
    start = change & (space | ~blank_before)
    # the last character of a run of white space, unless the text ends there
    closes = np.flatnonzero(space[:-1] & ~space[1:] & ~first[1:n]) if n > 1 else np.zeros(0, np.int64)
    while len(closes):
        inner = (data[closes] & 0xC0) == 0x80
        start[closes[~inner]] = True
        closes = closes[inner] - 1
    quote = np.flatnonzero((data == 39) & start)
    if len(quote):
        tail = np.concatenate([data, np.zeros(3, np.uint8)])
        stop = np.searchsorted(offsets, quote, side="right")
        room = offsets[stop] - quote - 1
        for c in CONTRACTIONS:
            fits = room >= len(c)
            for k, b in enumerate(c):
                fits &= tail[quote + 1 + k] == b
            q = quote[fits]
            start[q + 1] = False
            after = q + 1 + len(c)
            inside = after < n
            start[after[inside]] = True
    return np.flatnonzero(start), kind


_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], np.uint64)


def _packed(data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Three rows: the first eight bytes of each span, the next eight, and its length."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    words = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))
    return np.stack([words[starts] & _MASKS[np.minimum(size, 8)], words[starts + 8] & _MASKS[np.clip(size - 8, 0, 8)], size.astype(np.uint64)])


class PretokenCache:
    """Token ids of texts, encoding each different pre-token once; a direct-mapped table of bounded size."""

    def __init__(self, path: str, slots: int = 1 << 20, most_ids: int = 1 << 22):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [str(t) if isinstance(t, str) else t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.classes = _classes()
        self.slots, self.most_ids = slots, most_ids
        self.reset()

    def reset(self) -> None:
        self.key = np.zeros((3, self.slots), np.uint64)  # the bytes of the pre-token and their number
        self.at = np.zeros(self.slots, np.int64)
        self.size = np.zeros(self.slots, np.int32)
        self.flat = np.zeros(1 << 16, np.uint32)
        self.used = 0

    def _append(self, lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        size = np.fromiter(map(len, lists), np.int32, len(lists))
        total = int(size.sum())
        while self.used + total > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat), np.uint32)])
        self.flat[self.used : self.used + total] = np.fromiter((i for x in lists for i in x), np.uint32, total)
        at = self.used + np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.int64)
        self.used += total
        return at, size

    def _encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        made = self.tokenizer.encode_batch_fast([w.decode("utf-8", "replace") for w in words], add_special_tokens=False)
        return self._append([x.ids for x in made])

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in one array, where each text's ids begin)."""
        texts = len(offsets) - 1
        if self.used > self.most_ids:
            self.reset()
        starts, kind = split_pretokens(data, offsets, self.classes)
        ends = np.concatenate([starts[1:], [len(data)]])
        word = _packed(data, starts, ends - starts)
        slot = (tv.mix(word[0] ^ tv.mix(word[1] + word[2])) >> np.uint64(20)).astype(np.int64) & (self.slots - 1)
        at, size = self.at[slot], self.size[slot]
        short = ends - starts <= 16
        raw = data.tobytes()
        miss = np.flatnonzero(short & ((self.key[:, slot] != word).any(axis=0) | (size == 0)))
        if len(miss):
            _, one, which = np.unique(word[:, miss], axis=1, return_index=True, return_inverse=True)
            new = miss[one]
            new_at, new_size = self._encoded([raw[s:e] for s, e in zip(starts[new], ends[new])])
            at[miss], size[miss] = new_at[which.ravel()], new_size[which.ravel()]
            self.key[:, slot[new]], self.at[slot[new]], self.size[slot[new]] = word[:, new], new_at, new_size
        long = np.flatnonzero(~short)
        if len(long):
            spelt = [raw[s:e] for s, e in zip(starts[long], ends[long])]
            number = {w: i for i, w in enumerate(dict.fromkeys(spelt))}
            new_at, new_size = self._encoded(list(number))
            which = np.array([number[w] for w in spelt])
            at[long], size[long] = new_at[which], new_size[which]
        owner, k = tv.ragged(size)
        ids = self.flat[at[owner] + k]
        before = np.concatenate([[0], np.cumsum(size)])
        bounds = before[np.searchsorted(starts, offsets)]
        odd = self._odd(data, offsets, kind)
        if not odd:
            return ids, bounds
        parts = [ids[bounds[i] : bounds[i + 1]] for i in range(texts)]
        for i in odd:
            parts[i] = np.array(self.tokenizer.encode(data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"), add_special_tokens=False).ids, np.uint32)
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])

    def _odd(self, data, offsets, kind) -> list[int]:
        out = {int(i) for i in np.searchsorted(offsets, np.flatnonzero(kind == UNKNOWN), side="right") - 1}
        raw = data.tobytes()
        for s in (x.encode() for x in self.special):
            at = raw.find(s)
            while at >= 0:
                out.add(int(np.searchsorted(offsets, at, side="right")) - 1)
                at = raw.find(s, at + 1)
        return sorted(out)


class SumOfSquaresPacker:
    """Places pieces into windows; ``done`` collects (doc, start, ids, doc tokens, window, offset)."""

    def __init__(self, length: int, first_window: int):
        self.length, self.next_window = length, first_window
        self.count = np.zeros(length + 1, np.int64)  # open windows at each fill level
        self.open: dict[int, list[list]] = {}  # fill level -> windows, each a list of pieces
        self.done: list[tuple] = []

    def _emit(self, pieces: list[tuple]) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            self.done.append((doc, start, ids, total, self.next_window, at))
            at += len(ids)
        self.next_window += 1

    def level_for(self, size: int) -> int:
        """The fill level whose choice leaves the smallest sum of squares; 0 opens a window."""
        room = self.length - size
        gain = 2 * self.count[size:]  # what the level that is reached adds
        if room:
            gain = gain[: room + 1].copy()
            gain[room] = -1  # full windows aren't counted
            cost = np.where(self.count[1 : room + 1] > 0, gain[1:] - 2 * self.count[1 : room + 1] + 1, 1 << 40)
            best = room - 1 - int(np.argmin(cost[::-1]))
            if cost[best] <= gain[0]:
                return best + 1
        return 0

    def add(self, doc, ids: np.ndarray) -> None:
        total, whole = len(ids), len(ids) // self.length * self.length
        for at in range(0, whole, self.length):
            self._emit([(doc, at, ids[at : at + self.length], total)])
        if whole < total:
            self.place((doc, whole, ids[whole:], total))

    def place(self, piece: tuple) -> None:
        size = len(piece[2])
        level = self.level_for(size)
        pieces = []
        if level:
            pieces = self.open[level].pop()
            self.count[level] -= 1
        pieces.append(piece)
        if level + size == self.length:
            self._emit(pieces)
        else:
            self.open.setdefault(level + size, []).append(pieces)
            self.count[level + size] += 1

    def take_open(self) -> list[tuple]:
        """The pieces of all open windows, which are open no longer."""
        rest = [p for level in sorted(self.open, reverse=True) for window in self.open[level] for p in window]
        self.open.clear()
        self.count[:] = 0
        return rest

    def close(self) -> None:
        """Lay the pieces of all open windows end to end and cut them anew, without padding."""
        rest = self.take_open()
        left = sum(len(p[2]) for p in rest)
        while left:
            want = self.length if left >= self.length else 1 << (left.bit_length() - 1)
            left -= want
            taken = []
            while want:
                doc, start, ids, total = rest[0]
                taken.append((doc, start, ids[:want], total))
                if len(ids) > want:
                    rest[0] = (doc, start + want, ids[want:], total)
                else:
                    rest.pop(0)
                want -= len(taken[-1][2])
            self._emit(taken)


PIECES = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def _rows(pieces: list[tuple]) -> pa.RecordBatch:
    doc, start, ids, total, window, at = zip(*pieces)
    columns = [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()), pa.array(total, pa.int64()), pa.array(window, pa.int64()), pa.array(at, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in PIECES.split(", ")])


def pack_partitions(docs: DataFrame, length: int, end_id: int, tokenizer_path: str | None, text_col: str, id_col: str) -> DataFrame:
    """Pieces of the windows that each scan partition fills, and with null sequence_id those it leaves open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = _cache(tokenizer_path)
        packer = SumOfSquaresPacker(length, TaskContext.get().partitionId() << 33)
        end = np.array([end_id], np.uint32)
        for batch in batches:
            names = batch.column(0).to_pylist()
            text = batch.column(1).cast(pa.large_string()).fill_null("")
            for row, data, offsets in tv.blocks(text, 1 << 20):
                ids, bounds = cache.encode(data, offsets)
                for i in range(len(offsets) - 1):
                    packer.add(names[row + i], np.concatenate([ids[bounds[i] : bounds[i + 1]], end]))
                if len(packer.done) >= 512:
                    yield _rows(packer.done)
                    packer.done = []
        left = packer.done + [(*piece, None, None) for piece in packer.take_open()]
        for lo in range(0, len(left), 512):
            yield _rows(left[lo : lo + 512])
        del left, packer
        release_memory()

    rows = docs.select(quoted(id_col).cast("long").alias("doc_id"), quoted(text_col).cast("string").alias("t"))
    return rows.mapInArrow(run, PIECES)


def pack_rest(pieces: DataFrame, length: int, tasks: int) -> DataFrame:
    """The open pieces of all partitions packed by ``tasks`` tasks; what is open then is cut end to end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = SumOfSquaresPacker(length, (1 << 62) | TaskContext.get().partitionId() << 33)
        for batch in batches:
            for doc, start, ids, total in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "start", "ids", "doc_tokens"))):
                packer.place((doc, start, np.frombuffer(ids, "<u4"), total))
            if packer.done:
                yield _rows(packer.done)
                packer.done = []
        packer.close()
        for lo in range(0, len(packer.done), 512):
            yield _rows(packer.done[lo : lo + 512])
        del packer
        release_memory()

    return pieces.repartition(tasks).mapInArrow(run, PIECES)


def pack(docs: DataFrame, length: int = 2048, end_id: int = 1, tokenizer_path: str | None = None, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset); ids are little-endian uint32 bytes.

    ``sequence_id`` holds the partition that packed the sequence in its upper bits, so that partitions number theirs alone.
    """
    ship_package(docs.sparkSession)
    first = pack_partitions(docs, length, end_id, tokenizer_path, text_col, id_col)
    first = write_table(first.withColumn("open", F.col("sequence_id").isNull()), "pieces", ["open"])
    left = first.where("open").drop("open")
    tokens = left.agg(F.sum("length")).first()[0] or 0
    return first.where("NOT open").drop("open").unionByName(pack_rest(left, length, -(-tokens // REST_TOKENS) or 1))


_caches: dict[str, PretokenCache] = {}


def _cache(path: str | None) -> PretokenCache:
    """One cache for each tokenizer file in a worker process, kept between tasks."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    if path not in _caches:
        _caches[path] = PretokenCache(path)
    return _caches[path]


def with_digest(pieces: DataFrame) -> DataFrame:
    """The ids replaced by their CRC-32."""
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
