"""Line deduplication over levelled sorted runs of line hashes.

A line's key is the line without white space at its ends and with A-Z lower-cased. Keys of at least ``shortest`` code points
that at least ``copies`` documents hold go from all documents but the one with the largest id among their holders.

1. The keys of all documents are written once, by their digests, dealt into batches of document ids, largest ids first.
2. A *run* is a table of digests with the number of documents that hold each and the largest of their ids, bucketed and
   sorted by digest. Each batch is merge-anti-joined with the runs: digests that a run tells to be common already, with
   a holder beyond all of the batch's, need no further entry. The rest is the batch's own run, on level 0.
   ``FANOUT`` runs of one level are compacted into one run of the next. Runs share their buckets, so the join doesn't move them.
3. The merged runs tell which keys are common; their lines (document, line number) are joined back to the texts.

Runs may take batches in any order and at any time; ``LineRuns.add`` is the way for later ones. Only built-in functions are
used. A key that very many documents hold is counted in parts before its parts meet; where lines meet the common keys, Spark
splits a skewed key. Digests are the first 128 bits of SHA-256.

Defined cases: a null or empty text is one empty line; rows with the same id are one document when holders are counted, and
each row loses the lines that its document loses; a null id is smaller than all others (rows without one are one document);
lines that differ only in what keys leave out are equal; a carriage return belongs to the white space of a line's end and is
kept with a line that stays; a document that loses all lines keeps none, which is the empty text; an empty table gives no
row; other columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.shared import ROW_GROUP, fresh_folder, quoted, write_table

SHORTEST = 40
COPIES = 5
FANOUT = 4  # runs of one level that are compacted
BATCH_BYTES = 4 << 30  # of texts in a batch
LEAST_BATCHES, MOST_BATCHES = 6, 64
BUCKET_BYTES = 256 << 20  # of texts behind one bucket of the runs
PARTS = 64  # in which the holders of a key are counted before they meet
NO_ID = -(1 << 63)
RUN = "digest binary, n long, top long"
_SPACE = " \t\n\x0b\x0c\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def line_key(line):
    """A line's key; lower() maps A-Z alone where a line is ASCII, and is the faster one."""
    bare = F.btrim(line, F.lit(_SPACE))
    return F.when(F.octet_length(bare) == F.char_length(bare), F.lower(bare)).otherwise(F.translate(bare, _UPPER, _LOWER))


def digest(key):
    return F.unhex(F.left(F.sha2(key.cast("binary"), 256), F.lit(32)))


def lines_of(text):
    return F.split(text, "\n", -1)


class LineRuns:
    """Levels of runs (digest, n, top); a run is a table with a bucket for each hash of a digest, sorted within."""

    def __init__(self, spark: SparkSession, buckets: int, copies: int = COPIES, fanout: int = FANOUT):
        self.spark, self.buckets, self.copies, self.fanout = spark, buckets, copies, fanout
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def _write(self, rows: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        path = self.paths[name] = fresh_folder(self.spark, "line-run")
        rows.write.format("parquet").option("path", path).option("parquet.block.size", ROW_GROUP).bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(name)
        return name

    def _union(self, names: list[str]) -> DataFrame:
        """The rows of some runs, read as plain files.

        Spark takes a union of bucketed tables for bucketed, but pairs up the wrong buckets, so that a digest would stay in
        several rows (seen with 4.1.2).
        """
        return self.spark.read.schema(RUN).parquet(*[self.paths[name] for name in names])

    def _compacted(self, rows: DataFrame) -> DataFrame:
        """One row for each digest, dealt like the runs."""
        return rows.repartition(self.buckets, "digest").groupBy("digest").agg(F.sum("n").alias("n"), F.max("top").alias("top"))

    @property
    def names(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def own_run(self, lines: DataFrame) -> DataFrame:
        """(digest, n, top) of lines (digest, doc): documents that hold each, dealt like the runs."""
        part = F.pmod(F.xxhash64("doc"), F.lit(PARTS)).alias("part")
        held = lines.select("digest", "doc", part).repartition("digest", "part").distinct()
        counted = held.groupBy("digest", "part").agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("top"))
        return self._compacted(counted.select("digest", "n", "top"))

    def add(self, lines: DataFrame) -> None:
        """Merge-anti-join the lines (digest, doc) of a batch of documents with the runs, and add what is left as a run.

        A document belongs to one batch with all its lines.
        """
        self._put(0, self._write(self.without_settled(self.own_run(lines))))

    def without_settled(self, own: DataFrame) -> DataFrame:
        """Rows of a run whose digests no other run tells to be common, with a holder beyond theirs."""
        for name in self.names:
            told = self.spark.table(name).where(F.col("n") >= self.copies).select(F.col("digest").alias("d"), F.col("top").alias("t"))
            own = own.join(told.hint("merge"), (F.col("digest") == F.col("d")) & (F.col("top") <= F.col("t")), "left_anti")
        return own

    def _put(self, level: int, name: str) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) == self.fanout:
            merged = self._write(self._compacted(self._union(self.levels[level])))
            self.levels[level] = []
            self._put(level + 1, merged)

    def common(self) -> DataFrame:
        """(digest, top) of the keys that enough documents hold."""
        return self._compacted(self._union(self.names)).where(F.col("n") >= self.copies).select("digest", "top")

    def forget(self) -> None:
        """Take the runs' names out of the catalog; their files stay until ``clean_up``."""
        for name in self.names:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def batch_bounds(docs: DataFrame, batches: int) -> list[int]:
    """Ids that deal the rows evenly, fewer where many rows share one."""
    shares = [k / batches for k in range(1, batches)]
    return sorted(set(docs.agg(F.percentile_approx("doc", shares, 1000)).first()[0] or []))


def drop_common_lines(
    docs: DataFrame,
    text_col: str = "text",
    id_col: str = "doc_id",
    shortest: int = SHORTEST,
    copies: int = COPIES,
    batch_bytes: int = BATCH_BYTES,
    with_text: bool = False,
) -> DataFrame:
    """(id, n_lines, n_dropped, kept_sha256), a row for each row; with ``with_text`` also the text that stays (``kept``)."""
    spark = docs.sparkSession
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    rows = docs.select(quoted(id_col).alias("id"), F.coalesce(quoted(id_col).cast("long"), F.lit(NO_ID).cast("long")).alias("doc"), text.alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    batches = int(min(MOST_BATCHES, max(LEAST_BATCHES, -(-total // batch_bytes))))

    numbered = rows.select("doc", F.posexplode(lines_of(F.col("text"))).alias("line", "content"))
    long_ = numbered.where(F.char_length("content") >= shortest).withColumn("key", line_key(F.col("content"))).where(F.char_length("key") >= shortest)
    bounds = batch_bounds(rows.select("doc"), batches)
    number = sum(((F.col("doc") <= F.lit(b)).cast("int") for b in bounds), F.lit(0))
    keyed = long_.select("doc", "line", digest(F.col("key")).alias("digest"), number.alias("batch"))
    keyed = write_table(keyed.hint("rebalance", F.col("batch")), "line-keys", ["batch"])

    runs = LineRuns(spark, int(max(8, -(-total // BUCKET_BYTES))), copies)
    for batch in range(len(bounds) + 1):
        runs.add(keyed.where(F.col("batch") == batch).select("digest", "doc"))
    common = write_table(runs.common(), "line-common")
    runs.forget()

    # rows that share an id may differ, so a line is told by its digest and its number together
    gone = keyed.join(common, "digest").where(F.col("doc") < F.col("top"))
    gone = gone.groupBy("doc").agg(F.collect_set(F.struct("line", "digest")).alias("gone"))
    split = rows.join(gone, "doc", "left").select("id", "text", "gone", lines_of(F.col("text")).alias("lines"))
    # a row loses a line only if the digest there agrees; this matters for repeated ids alone
    at = F.filter("gone", lambda g: digest(line_key(F.get("lines", g["line"]))) == g["digest"])
    at = F.array_distinct(F.transform(at, lambda g: g["line"]))
    cut = split.withColumn("n_lines", F.size("lines")).withColumn("at", F.coalesce(at, F.array().cast("array<int>")))
    stay = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), F.col("at"))
    kept = F.when(F.size("at") == 0, F.col("text")).otherwise(F.array_join(F.transform(stay, lambda i: F.get("lines", i)), "\n"))
    out = cut.select(F.col("id").alias(id_col), F.col("n_lines").cast("long").alias("n_lines"), F.size("at").cast("long").alias("n_dropped"), kept.alias("kept"))
    told = out.withColumn("kept_sha256", F.sha2(F.col("kept").cast("binary"), 256))
    return told.select(id_col, "n_lines", "n_dropped", "kept_sha256", *["kept"] * with_text)
