"""SimHash near-duplicates, found with keys from the binary Golay code.

Fingerprints of 64 bits are cut into four segments. When two of them differ in at most three bits, one segment is equal
(three errors in four segments) and, of the other three, some segment has at most one error. The (23, 12) Golay code is
perfect: every 23-bit word is within three bits of exactly one codeword. A segment, padded to 23 bits, is decoded to
its codeword on one side of the join; on the other side it and its one-bit neighbours are decoded, which gives a few
codewords. If the segments differ in at most one bit, the first codeword is among the second ones, so the join on
(which segments, equal segment, codeword) loses no link; the distance of each candidate is then verified.

Documents are grouped by fingerprint before anything is paired, so copies are one row whatever their number, and
classes are joined to the documents again at the end. Components come from distributed star contraction.

Defined cases: null and empty texts have no words and fingerprint zero, which links like any other; fewer words than a
shingle are one shingle; a bit set in exactly half of the shingles is 0; repeated ids and rows share a component; null
ids keep their row and take the component of their fingerprint's smallest id; an empty table gives no row; extra columns
are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import textvec as tv
from millrace.llm.shared import connected_components, cut, join_dealt, map_text, reserved, ship_package

SEGMENTS, SEGMENT_BITS, MOST_ERRORS = 4, 16, 3
GENERATOR = 0b101011100011  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1, of the (23, 12) Golay code


def _syndromes(words: np.ndarray) -> np.ndarray:
    """Remainders of 23-bit words by the generator polynomial."""
    rest = words.astype(np.int64).copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, GENERATOR << (bit - 11), 0)
    return rest


def _leaders() -> np.ndarray:
    """For each of the 2048 syndromes, its only error pattern of at most three bits."""
    bits = 1 << np.arange(23)
    patterns = {0} | set(bits.tolist())
    patterns |= {int(a | b) for i, a in enumerate(bits) for b in bits[:i]}
    patterns |= {int(a | b | c) for i, a in enumerate(bits) for j, b in enumerate(bits[:i]) for c in bits[:j]}
    every = np.array(sorted(patterns))
    table = np.zeros(2048, np.int64)
    table[_syndromes(every)] = every
    return table


def golay_indices() -> np.ndarray:
    """For each 16-bit segment the 12 information bits of its codeword, as an index."""
    words = np.arange(1 << SEGMENT_BITS)
    return ((words ^ _leaders()[_syndromes(words)]) >> 11).astype(np.int64)


def neighbour_indices(index: np.ndarray) -> list[list[int]]:
    """For each segment the different indices of itself and of its one-bit neighbours."""
    words = np.arange(1 << SEGMENT_BITS)
    around = np.stack([index] + [index[words ^ (1 << b)] for b in range(SEGMENT_BITS)], axis=1)
    return [sorted(set(row)) for row in around.tolist()]


HUB_ROWS = 200_000  # rows of one fingerprint that a task takes, at least; fewer fingerprints than rows / HUB_ROWS have more

#: (equal segment, segment with at most one error)
PAIRS = [(i, j) for i in range(SEGMENTS) for j in range(SEGMENTS) if i != j]


def fingerprint(words: list[bytes], shingle: int = 3) -> int:
    """Majority of the bits of the XXH64 hashes (seed 42) of all runs of ``shingle`` words."""
    if not words:
        return 0
    text = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = [0, *(ends[:-1] + 1).tolist()]
    stops = ends[min(shingle, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(text[s:e], 42) for s, e in zip(starts, stops)], dtype="<u8")
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)]
        total += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(total * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text_col: str = "text", carry: tuple[str, ...] = ("doc_id",), shingle: int = 3) -> DataFrame:
    """The carried columns and ``simhash`` (the 64 bits as a long)."""
    ship_package(docs.sparkSession)

    def worker():
        def handle(text, _):
            out = np.zeros(len(text), np.uint64)
            for row, data, offsets in tv.blocks(text):
                low = tv.LOWER[data]
                starts, ends, first = tv.word_spans(low, offsets, tv.NONSPACE_BYTES)
                raw = low.tobytes()
                words = [raw[s:e] for s, e in zip(starts.tolist(), ends.tolist())]
                for i in range(len(offsets) - 1):
                    out[row + i] = fingerprint(words[first[i] : first[i + 1]], shingle)
            return {"simhash": pa.array(out.view(np.int64))}

        return handle

    return map_text(docs, worker, T.StructType([T.StructField("simhash", T.LongType())]), text_col, carry)


def golay_keys(prints: DataFrame, neighbours: bool) -> DataFrame:
    """(key, simhash): one row for each pair of segments, or with ``neighbours`` one for each nearby codeword too."""
    kind = "key long, simhash long"

    def run(batches):
        index = golay_indices()
        around = neighbour_indices(index) if neighbours else None
        if neighbours:
            size = np.array([len(a) for a in around])
            flat = np.array([x for a in around for x in a])
            begin = np.concatenate([[0], np.cumsum(size)[:-1]])
        for batch in batches:
            f = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            parts = [(f.view(np.uint64) >> np.uint64(SEGMENT_BITS * s)).astype(np.int64) & 0xFFFF for s in range(SEGMENTS)]
            for number, (i, j) in enumerate(PAIRS):
                exact = (np.int64(number) << 28) | (parts[i] << 12)
                if neighbours:
                    owner, k = tv.ragged(size[parts[j]])
                    yield pa.RecordBatch.from_arrays([pa.array(exact[owner] | flat[begin[parts[j]][owner] + k]), pa.array(f[owner])], ["key", "simhash"])
                else:
                    yield pa.RecordBatch.from_arrays([pa.array(exact | index[parts[j]]), pa.array(f)], ["key", "simhash"])

    return prints.select("simhash").mapInArrow(run, kind)


def near_pairs(prints: DataFrame, most_errors: int = MOST_ERRORS) -> DataFrame:
    """Links (a, b, distance) between different fingerprints that differ in at most ``most_errors`` (up to 3) bits."""
    if not 0 <= most_errors <= MOST_ERRORS:
        raise ValueError("the keys hold for at most three differing bits")
    one = golay_keys(prints, False).withColumnRenamed("simhash", "a")
    many = golay_keys(prints, True).withColumnRenamed("simhash", "b")
    gap = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return one.join(many, "key").where((F.col("a") < F.col("b")) & (gap <= most_errors)).select("a", "b", gap.alias("distance")).distinct()


def class_components(each: DataFrame, id_col: str, most_errors: int = MOST_ERRORS) -> DataFrame:
    """(simhash, component, component_id) of rows (id, simhash): ``component`` is the least fingerprint that links reach."""
    classes = cut(each.groupBy("simhash").agg(F.min(id_col).alias("least")))
    links = near_pairs(classes, most_errors)
    parts = connected_components(links.select(F.col("a").alias("u"), F.col("b").alias("v")))
    joined = classes.join(parts, classes["simhash"] == parts["node"], "left").select("simhash", "least", F.coalesce("component", "simhash").alias("component"))
    least = joined.groupBy("component").agg(F.min("least").alias("component_id"))
    return cut(joined.join(least, "component").select("simhash", "component", "component_id"))


def named_rows(each: DataFrame, named: DataFrame, id_col: str) -> DataFrame:
    """Rows (id, simhash) with their component_id; one fingerprint may be that of most rows, so it is dealt in parts."""
    told = named.join(each.groupBy("simhash").agg(F.count(F.lit(1)).alias("n")), "simhash").select("simhash", "component_id", "n")
    return join_dealt(each, told, "simhash", id_col, HUB_ROWS).select(id_col, "simhash", "component_id")


def simhash_components(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 3, most_errors: int = MOST_ERRORS) -> DataFrame:
    """(id, simhash, component_id): component_id is the smallest id that links reach, the document's own included."""
    each = cut(fingerprints(docs, text_col, (id_col,), shingle))
    return named_rows(each, class_components(each, id_col, most_errors), id_col)


def with_hex(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The fingerprint as 16 lower-case hexadecimal digits."""
    return found.select(id_col, F.lpad(F.lower(F.hex("simhash")), 16, "0").alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """Of each component the row with the smallest id, all its columns as they are, whatever their names.

    Of rows that repeat that id, the one with the least text stays (null counts as empty); rows without an id stay only
    where their component has no id, one of them. Texts of rows with an id of their own are read once and not grouped.
    """
    held, names, back = reserved(docs)
    text, key = names[text_col], names[id_col]
    each = cut(fingerprints(held, text, (key,)))
    named = class_components(each, key)
    per_id = cut(named_rows(each.where(F.col(key).isNotNull()), named, key).groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.col("component_id") == F.col(key)).alias("stays")).where("n > 1 OR NOT stays"))
    odd = per_id.where("n > 1").select(key)
    regular = held.where(F.col(key).isNotNull()).join(per_id.select(key), key, "left_anti")
    doubtful = held.where(F.col(key).isNull()).unionByName(held.join(odd, key, "left_semi"))
    row = F.struct(*names.values())
    judged = fingerprints(doubtful, text, tuple(names.values())).join(named, "simhash").where(F.col("component_id").isNull() | (F.col("component_id") == F.col(key)))
    one = judged.groupBy("component").agg(F.min_by(row, F.coalesce(F.col(text), F.lit(""))).alias("row")).select("row.*")
    return back(regular.select(*names.values()).unionByName(one))
