"""WARC archives as seekable Zstandard bundles, written to and read from the shared folder.

A bundle is a run of independent Zstandard frames, each holding a few whole WARC records, and a skippable frame at its
end with the seek table (compressed and full size of every frame). The index maps each record to its bundle, frame and
offset within the frame, so that one record is read by decompressing one frame.

Tasks write under names of their own attempt and report what they have written; the rows that Spark keeps are the
manifest. What a lost or repeated attempt has left is in no row and is never read. Bundles are closed at about
``bundle_bytes``, so neither side ever holds more than a bundle.

Payloads of at least ``least_revisit`` bytes that are equal are written once, as the response of the largest page id;
the others become revisit records that refer to it. Equality is decided on SHA-256 and length, pre-aggregated before
the shuffle, so a payload that a third of all pages share is no hot group.

Defined cases: null html is an empty payload; pages with a null url have an empty target; repeated page ids each get
their record; a page whose id is null is never the response that others refer to unless all ids of its payload are
null; extra columns are not read; an empty table makes no bundle.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import fresh_folder, quoted, ship_package, write_table

#: Fixed values of the seekable format: magic numbers of the skippable frame and of its footer.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
INDEX = "page_id long, bundle string, frame int, offset long, size long, first_frame_row boolean"


def _filesystem(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    return arrow_fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def seek_table(frames: list[tuple[int, int]]) -> bytes:
    """The skippable frame for frames of (compressed, full) bytes."""
    body = b"".join(struct.pack("<II", *f) for f in frames) + struct.pack("<IBI", len(frames), 0, SEEKABLE)
    return struct.pack("<II", SKIPPABLE, len(body)) + body


def read_seek_table(tail: bytes) -> list[tuple[int, int]]:
    """The frames of a bundle from its last bytes; ValueError if those don't end in a whole table."""
    count, _, magic = struct.unpack("<IBI", tail[-9:])
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    need = 8 * count + 9
    if len(tail) < need:
        raise ValueError(f"the seek table takes {need} bytes")
    return [struct.unpack_from("<II", tail, len(tail) - need + 8 * i) for i in range(count)]


def warc_record(kind: str, record_id: str, uri: str, digest: str, payload: bytes, refers_to: str | None, full_bytes: int, seen: str) -> bytes:
    """One WARC 1.1 record. A revisit has no payload; it names the record that has it and how long that is."""
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{record_id}>",
        f"WARC-Date: {seen}",
        "WARC-Target-URI: " + uri.replace("\r", "%0D").replace("\n", "%0A"),
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Full-Payload-Length: {full_bytes}"]
    else:
        head += ["Content-Type: text/html; charset=utf-8"]
    return "\r\n".join([*head, f"Content-Length: {len(payload)}", "", ""]).encode() + payload + b"\r\n\r\n"


def parse_record(data: memoryview, at: int) -> tuple[dict[str, str], bytes, int]:
    """(headers, payload, where the next record begins)."""
    raw = bytes(data[at : at + 65536])
    end = raw.find(b"\r\n\r\n")
    if end < 0:
        raw = bytes(data[at:])
        end = raw.index(b"\r\n\r\n")
    lines = raw[:end].decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no record begins here")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    start = at + end + 4
    stop = start + int(headers["Content-Length"])
    if bytes(data[stop : stop + 4]) != b"\r\n\r\n":
        raise ValueError("the record doesn't end where it should")
    return headers, bytes(data[start:stop]), stop + 4


class BundleWriter:
    """Records into frames, frames into bundles; yields index rows as bundles are closed."""

    def __init__(self, folder: str, frame_bytes: int, bundle_bytes: int, level: int):
        self.files, self.root = _filesystem(folder)
        self.frame_bytes, self.bundle_bytes = frame_bytes, bundle_bytes
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.stem = f"part-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}" if TaskContext.get() else f"part-{uuid.uuid4().hex}"
        self.bundles, self.out, self.name = 0, None, ""
        self.buffer, self.frames, self.rows, self.written = bytearray(), [], [], 0

    def add(self, page_id, record: bytes) -> Iterator[list[tuple]]:
        if self.out is None:
            self.name = f"{self.stem}-{self.bundles:05d}.warc.zst"
            self.out = self.files.open_output_stream(f"{self.root}/{self.name}", compression=None)
        self.rows.append((page_id, self.name, len(self.frames), len(self.buffer), len(record), not self.buffer))
        self.buffer += record
        if len(self.buffer) >= self.frame_bytes:
            self._frame()
        if self.written >= self.bundle_bytes:
            yield self._close()

    def _frame(self) -> None:
        if self.buffer:
            packed = self.compressor.compress(bytes(self.buffer))
            self.out.write(packed)
            self.frames.append((len(packed), len(self.buffer)))
            self.written += len(packed)
            self.buffer = bytearray()

    def _close(self) -> list[tuple]:
        self._frame()
        self.out.write(seek_table(self.frames))
        self.out.close()
        rows, self.rows = self.rows, []
        self.out, self.frames, self.written = None, [], 0
        self.bundles += 1
        return rows

    def finish(self) -> Iterator[list[tuple]]:
        if self.out is not None:
            yield self._close()


def plan_records(pages: DataFrame, least_revisit: int = 1000, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages with their payload, digest and, for those that revisit another page's payload, refers_to."""
    payload = F.coalesce(quoted(html_col).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(quoted(id_col).cast("long").alias("page_id"), F.coalesce(quoted(url_col).cast("string"), F.lit("")).alias("url"), payload.alias("payload"))
    keyed = rows.select("page_id", "url", "payload", F.sha2("payload", 256).alias("k"), F.octet_length("payload").cast("long").alias("payload_bytes"))
    shared = keyed.where(F.col("payload_bytes") >= least_revisit).groupBy("k", "payload_bytes").agg(F.max("page_id").alias("best"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # One row per shared payload on the right, so that a hot payload can be split over tasks.
    joined = keyed.join(shared.select("k", "payload_bytes", "best"), ["k", "payload_bytes"], "left")
    return joined.select("page_id", "url", "payload", F.sha1("payload").alias("digest"), F.when(F.col("page_id") < F.col("best"), F.col("best")).alias("refers_to"))


def write_bundles(records: DataFrame, folder: str, frame_bytes: int = 1 << 18, bundle_bytes: int = 1 << 24, level: int = 3, seen: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write planned records; returns the index: page_id, bundle, frame, offset within the frame, size."""
    ship_package(records.sparkSession)
    _filesystem(folder)[0].create_dir(_filesystem(folder)[1], recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = BundleWriter(folder, frame_bytes, bundle_bytes, level)

        def made(rows):
            types = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["page_id", "bundle", "frame", "offset", "size", "first_frame_row"])

        for batch in batches:
            columns = [batch.column(n) for n in ("page_id", "url", "payload", "digest", "refers_to")]
            for i in range(batch.num_rows):
                page_id, url, payload, digest, refers_to = (c[i].as_py() for c in columns)
                again = refers_to is not None
                record = warc_record("revisit" if again else "response", str(page_id), url, digest, b"" if again else payload, str(refers_to) if again else None, len(payload), seen)
                for rows in writer.add(page_id, record):
                    yield made(rows)
        for rows in writer.finish():
            yield made(rows)

    return write_table(records.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(run, INDEX), "warc-index")


def _frames(files, path: str) -> Iterator[tuple[int, bytes]]:
    """(number, records) of every frame of a bundle, one frame in memory at a time."""
    with files.open_input_file(path) as source:
        size = source.size()
        source.seek(max(0, size - 9))
        count = struct.unpack("<IBI", source.read(9))[0]
        source.seek(size - min(size, 8 * count + 9))
        table = read_seek_table(source.read())
        at, decompressor = 0, zstandard.ZstdDecompressor()
        for number, (packed, full) in enumerate(table):
            source.seek(at)
            data = decompressor.decompress(source.read(packed), max_output_size=full)
            if len(data) != full:
                raise ValueError(f"{path}: frame {number} isn't whole")
            at += packed
            yield number, data


def read_bundles(index: DataFrame, folder: str) -> DataFrame:
    """Every record of the bundles that the index names, read from the files and checked against their digests."""
    spark = index.sparkSession
    ship_package(spark)
    bundles = index.where("first_frame_row AND frame = 0").select("bundle")
    wide = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = _filesystem(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                for _, data in _frames(files, f"{root}/{name}"):
                    view, at, rows = memoryview(data), 0, []
                    while at < len(data):
                        head, payload, at = parse_record(view, at)
                        page_id = head["WARC-Record-ID"][len("<urn:page:") : -1]
                        refers = head.get("WARC-Refers-To")
                        digest = head["WARC-Payload-Digest"].removeprefix("sha1:")
                        if refers is None and hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"page {page_id}: the payload doesn't have its digest")
                        rows.append((None if page_id == "None" else int(page_id), int(head["X-Full-Payload-Length"]) if refers else len(payload), digest, head["WARC-Type"], int(refers[len("<urn:page:") : -1]) if refers else None, head["WARC-Target-URI"], None if refers else payload))
                    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"])

    return bundles.repartition(wide).mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary")


def fetch(index: DataFrame, folder: str, page_id: int) -> tuple[dict[str, str], bytes]:
    """One record by its page id, from one frame; the payload of a revisit is that of the page it refers to."""
    row = index.where(F.col("page_id") == page_id).first()
    if row is None:
        raise KeyError(page_id)
    files, root = _filesystem(folder)
    with files.open_input_file(f"{root}/{row['bundle']}") as source:
        size = source.size()
        source.seek(size - 9)
        count = struct.unpack("<IBI", source.read(9))[0]
        source.seek(size - 8 * count - 9)
        table = read_seek_table(source.read())
        source.seek(sum(packed for packed, _ in table[: row["frame"]]))
        packed, full = table[row["frame"]]
        data = zstandard.ZstdDecompressor().decompress(source.read(packed), max_output_size=full)
    head, payload, _ = parse_record(memoryview(data), row["offset"])
    if head["WARC-Type"] == "revisit":
        return head, fetch(index, folder, int(head["WARC-Refers-To"][len("<urn:page:") : -1]))[1]
    return head, payload


def round_trip(pages: DataFrame, folder: str | None = None, **columns: str) -> DataFrame:
    """Write all pages to bundles and read them back: one row per record."""
    folder = folder or fresh_folder(pages.sparkSession, "warc")
    return read_bundles(write_bundles(plan_records(pages, **columns), folder), folder)
