"""Chunks of parsed units: continuation lines merged, heading context, stable ids, coverage checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.functions.text import first_line, joined, piece_starts, sha256_hex, slice_text
from millrace.operators.hierarchy import LEVELS

UPPER = ("part", "chapter", "section")
NAMED = ("article", "clause", "point")


def merge_continuations(units: DataFrame) -> DataFrame:
    """Text lines joined to the unit before them while verification and all levels stay the same (gaps and islands)."""
    w = W.partitionBy("document_id").orderBy("pos")
    same = F.lag("kind").over(w).isNotNull() & ~F.lag("kind").over(w).isin(*UPPER) & (F.col("kind") == "text") & F.col("citation_verified").eqNullSafe(F.lag("citation_verified").over(w))
    for level in LEVELS:
        same = same & F.col(level).eqNullSafe(F.lag(level).over(w))
    rows = units.withColumn("fresh", ~F.coalesce(same, F.lit(False)))
    rows = rows.withColumn("island", F.count_if("fresh").over(w.rowsBetween(W.unboundedPreceding, 0)))
    # an island's columns are those of its first row, so its rows meet in a window and none is grouped
    whole = W.partitionBy("document_id", "island").orderBy("pos").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    rows = rows.withColumn("end", F.max("end").over(whole)).withColumn("text", F.array_join(F.collect_list("text").over(whole), "\n")).where("fresh")
    return rows.select("document_id", "pos", "start", "end", "text", "kind", "label", *LEVELS, "citation_verified")


def _context(kind: str, clears: tuple[str, ...]) -> Column:
    """The first line of the last verified ``kind`` above, unless the row or one between clears it."""
    before = W.partitionBy("document_id").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    nothing = F.struct(F.lit(None).cast("string").alias("v"))
    here = (F.col("kind") == kind) & F.col("citation_verified")
    event = F.when(here, F.struct(first_line("text").alias("v"))).when(F.col("kind").isin(kind, *clears, *UPPER), nothing)
    return F.when(~F.col("kind").isin(kind, *clears), F.last(event, ignorenulls=True).over(before)["v"])


def with_context(units: DataFrame) -> DataFrame:
    """context: the headings that a unit stands under, each cut to 300 characters."""
    return (
        units.withColumn("c1", _context("article", ()))
        .withColumn("c2", _context("clause", ("article",)))
        .withColumn("c3", _context("point", ("article", "clause")))
        .withColumn("context", F.concat_ws(" | ", "c1", "c2", "c3"))
        .drop("c1", "c2", "c3")
    )


def hierarchy_chunks(units: DataFrame, documents: DataFrame, max_chars: int = 1800) -> DataFrame:
    """Chunks of at most ``max_chars`` characters; ``documents`` brings document_id, source_hash, document_number, title and more."""
    merged = with_context(merge_continuations(units)).where(~F.col("kind").isin(*UPPER))
    rows = merged.join(documents, "document_id")
    good = F.col("citation_verified") & F.col("article").isNotNull()
    for level in NAMED:
        rows = rows.withColumn(level, F.when(good, F.col(level)))
    rows = rows.withColumn("citation_verified", F.coalesce(good, F.lit(False)))
    path = F.concat_ws(" / ", *[F.when(F.col(k) != "", F.concat(F.lit(f"{k}:"), F.col(k))) for k in LEVELS])
    rows = rows.withColumn("hierarchy", path).select("*", F.posexplode(piece_starts("text", max_chars)).alias("piece", "from"))
    rows = rows.withColumn("content", F.substring(F.col("text"), F.col("from") + 1, F.lit(max_chars)))
    rows = rows.withColumn("source_start", (F.col("start") + F.col("from")).cast("int")).withColumn("source_end", (F.col("source_start") + F.char_length("content")).cast("int"))
    extra = [c for c in documents.columns if c not in ("document_id", "source_text")]
    return rows.select(
        sha256_hex("document_id", "source_hash", "source_start", "source_end", "hierarchy").alias("chunk_id"),
        "document_id",
        *extra,
        "source_start",
        "source_end",
        "content",
        joined(" | ", joined(" | ", "document_number", "title"), "hierarchy", "context", "content").alias("embed_text"),
        F.when(F.col("kind").isin(*NAMED), F.col("text")).alias("heading"),
        *LEVELS,
        (F.col("piece") + 1).cast("int").alias("chunk_part"),
        "citation_verified",
        F.when(F.col("citation_verified"), F.array().cast("array<string>")).otherwise(F.array(F.lit("unverified_citation_path"))).alias("warnings"),
    )


def _baseline(rows: DataFrame, variant: str, max_chars: int) -> DataFrame:
    """Rows (document columns, first, last, article) cut into windows."""
    starts = F.when(F.col("last") > F.col("first"), F.sequence("first", F.col("last") - 1, F.lit(max_chars))).otherwise(F.array().cast("array<int>"))
    rows = rows.withColumn("source_start", F.explode(starts)).withColumn("source_end", F.least(F.col("source_start") + max_chars, "last"))
    rows = rows.withColumn("content", slice_text("source_text", "source_start", "source_end"))
    tag = F.when(F.col("article") != "", F.concat(F.lit("article "), F.col("article")))
    return rows.select(
        F.lit(variant).alias("variant"),
        sha256_hex(F.lit(variant), "document_id", "source_hash", "source_start", "source_end").alias("chunk_id"),
        "document_id",
        "source_hash",
        "source_start",
        "source_end",
        "content",
        joined(" | ", "document_number", "title", tag, "content").alias("embed_text"),
        "article",
        F.lit(None).cast("string").alias("clause"),
        F.lit(None).cast("string").alias("point"),
        F.col("article").isNotNull().alias("citation_verified"),
    )


def fixed_chunks(documents: DataFrame, max_chars: int = 1800) -> DataFrame:
    """Windows of ``max_chars`` characters over whole texts."""
    if max_chars < 1:
        raise ValueError("max_chars must be positive")
    return _baseline(documents.withColumn("first", F.lit(0)).withColumn("last", F.char_length("source_text")).withColumn("article", F.lit(None).cast("string")), "fixed", max_chars)


def article_chunks(units: DataFrame, documents: DataFrame, max_chars: int = 1800) -> DataFrame:
    """Windows over the span of each article number of a document, from its first unit to its furthest end."""
    if max_chars < 1:
        raise ValueError("max_chars must be positive")
    spans = units.where("article IS NOT NULL AND article <> ''").groupBy("document_id", "article").agg(F.min("start").alias("first"), F.max("end").alias("last"))
    return _baseline(spans.join(documents, "document_id"), "article", max_chars)


def variant_union(fixed: DataFrame, article: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """The three sets of chunks; of the hierarchy only verified chunks."""
    verified = hierarchy.where("citation_verified").withColumn("variant", F.lit("hierarchy")).select(*fixed.columns)
    return fixed.unionByName(article).unionByName(verified)


def split_verified(chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    return chunks.where("citation_verified"), chunks.where("NOT citation_verified")


def coverage_errors(units: DataFrame, documents: DataFrame, chunks: DataFrame) -> DataFrame:
    """(document_id, at, error) for every broken promise of a set of chunks; no row if it is sound."""
    known = documents.select("document_id", F.col("source_hash").alias("own_hash"), "source_text")
    w = W.partitionBy("document_id").orderBy("source_start", "source_end")
    again = F.row_number().over(W.partitionBy("document_id", "chunk_id").orderBy("source_start", "source_end"))
    flagged = chunks.withColumn("before", F.lag("source_end").over(w)).withColumn("again", again).join(known, "document_id", "left")
    off = (F.col("source_end") > F.char_length("source_text")) | (slice_text("source_text", "source_start", "source_end") != F.col("content"))
    rules = [
        ("repeated chunk id", F.col("again") > 1),
        ("chunk of another source", F.col("own_hash").isNull() | (F.col("own_hash") != F.col("source_hash"))),
        ("chunk overlaps the one before", F.col("source_start") < F.col("before")),
        ("content differs from its span", off),
    ]
    broken = F.explode(F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules])))
    told = flagged.select("document_id", F.col("source_start").alias("at"), broken.alias("error"))
    return told.unionByName(uncovered(units, chunks))


def uncovered(units: DataFrame, chunks: DataFrame) -> DataFrame:
    """(document_id, at, error) for units that chunks cover less than whole.

    The length that chunks cover up to a position is linear between their edges, so running sums over the edges of one
    document, in order, give it at both ends of every unit: one window, no pairing of units with chunks.
    """
    nothing = F.lit(None).cast("int")
    edges = F.array(F.struct(F.col("source_start").alias("at"), F.lit(1).alias("sign")), F.struct(F.col("source_end").alias("at"), F.lit(-1).alias("sign")))
    held = chunks.select("document_id", F.explode(edges).alias("e")).select("document_id", "e.at", "e.sign", nothing.alias("side"), nothing.alias("start"), nothing.alias("end"))
    ends = F.array(F.struct(F.col("start").alias("at"), F.lit(-1).alias("side")), F.struct(F.col("end").alias("at"), F.lit(1).alias("side")))
    asked = units.where(~F.col("kind").isin(*UPPER)).select("document_id", F.explode(ends).alias("e"), "start", "end").select("document_id", "e.at", F.lit(0).alias("sign"), "e.side", "start", "end")
    w = W.partitionBy("document_id").orderBy("at").rangeBetween(W.unboundedPreceding, W.currentRow)
    upto = F.col("at") * F.sum("sign").over(w) - F.sum(F.col("sign") * F.col("at")).over(w)
    sums = held.unionByName(asked).withColumn("upto", upto).where("side IS NOT NULL").groupBy("document_id", "start", "end")
    short = sums.agg(F.sum(F.col("side") * F.col("upto")).alias("covered"), (F.count(F.lit(1)) / 2).alias("units")).where("covered < (end - start) * units")
    return short.select("document_id", F.col("start").alias("at"), F.lit("unit not covered").alias("error"))
