"""Lines with offsets, and the hierarchy of numbered headings over them.

Both are windows over (document, position): one exchange and one sort serve all of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

LEVELS = ("part", "chapter", "section", "article", "clause", "point")
#: The headings, in the order in which they are tried.
HEADINGS = (
    ("part", r"(?U)^(?:PHẦN|Phần)\s+([IVXLCDM]+|\d+)\b"),
    ("chapter", r"(?U)^(?:CHƯƠNG|Chương)\s+([IVXLCDM]+|\d+)\b"),
    ("section", r"(?U)^(?:MỤC|Mục)\s+([IVXLCDM]+|\d+)\b"),
    ("article", r"(?U)^(?:ĐIỀU|Điều)\s+(\d+[a-zA-Z]?)\s*[.:]?(?:\s|$)"),
    ("clause", r"(?U)^(\d+)\.\s+"),
    ("point", r"(?iuU)^([a-zđ])\)\s+"),
)
UNVERIFIED = r"(?U)^(?:Điều|ĐIỀU)\b"
#: White space of Unicode, what ``(?U)\s`` matches.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
#: Warnings of lines, which the place of the line follows.
ORPHAN_POINT, STRAY_ARTICLE = "orphan point at offset ", "unverified article heading at offset "


def split_lines(docs: DataFrame, doc_col: str = "document_id", text_col: str = "text") -> DataFrame:
    """(document_id, pos, text): the lines of each text that aren't blank, stripped."""
    lines = F.split(F.col(text_col), "\n")
    rows = docs.select(F.col(doc_col).alias("document_id"), F.posexplode(lines).alias("pos", "text"))
    rows = rows.withColumn("text", F.btrim("text", F.lit(WHITE)))
    return rows.where("text <> ''")


def drop_repeats(lines: DataFrame) -> DataFrame:
    """Without lines that equal the line before them."""
    before = F.lag("text").over(W.partitionBy("document_id").orderBy("pos"))
    return lines.withColumn("before", before).where("before IS NULL OR before <> text").drop("before")


def with_offsets(lines: DataFrame) -> DataFrame:
    """start and end of each line in the lines joined by line breaks (code points)."""
    before = W.partitionBy("document_id").orderBy("pos").rowsBetween(W.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.char_length("text") + 1).over(before), F.lit(0)).cast("int")
    return lines.withColumn("start", start).withColumn("end", F.col("start") + F.char_length("text"))


def _kind_and_label() -> tuple[Column, Column]:
    """The first heading that a line is, and what follows from ``kind`` alone: its label."""
    kind, label = F.lit("text"), F.lit(None).cast("string")
    for name, pattern in reversed(HEADINGS):
        kind = F.when(F.col("text").rlike(pattern), name).otherwise(kind)
        label = F.when(F.col("kind") == name, F.regexp_extract("text", pattern, 1)).otherwise(label)
    return kind, label


def _carried(window, put: Column, clear: Column) -> Column:
    """The label of the last row that puts one, unless a later row clears it."""
    nothing = F.struct(F.lit(None).cast("string").alias("v"))
    return F.last(F.when(put, F.struct(F.col("found").alias("v"))).when(clear, nothing), ignorenulls=True).over(window)["v"]


def with_hierarchy(lines: DataFrame) -> DataFrame:
    """kind, label, the six levels, citation_verified and warning of each line.

    A heading sets its level and clears the lower ones. A point without a clause clears article and point, a line that
    begins like an article but isn't one clears article, clause and point; neither is verified.
    """
    w = W.partitionBy("document_id").orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    kind, found = _kind_and_label()
    rows = lines.withColumn("kind", kind).withColumn("found", found)
    rows = rows.withColumn("stray", (F.col("kind") == "text") & F.col("text").rlike(UNVERIFIED))
    at = {k: F.col("kind") == k for k in LEVELS}
    upper = F.col("kind").isin("part", "chapter", "section")
    rows = (
        rows.withColumn("part", _carried(w, at["part"], F.lit(False)))
        .withColumn("chapter", _carried(w, at["chapter"], at["part"]))
        .withColumn("section", _carried(w, at["section"], at["part"] | at["chapter"]))
        .withColumn("clause", _carried(w, at["clause"], upper | at["article"] | F.col("stray")))
        .withColumn("orphan", at["point"] & F.col("clause").isNull())
    )
    lost = F.col("stray") | F.col("orphan")
    rows = rows.withColumn("article", _carried(w, at["article"], upper | lost)).withColumn("point", _carried(w, at["point"] & ~F.col("orphan"), upper | at["article"] | at["clause"] | lost))
    verified = F.col("kind").isin("article", "clause", "point", "text") & F.col("article").isNotNull() & ~lost
    label = F.coalesce(*[F.when(at[k], F.col(k)) for k in LEVELS])
    warning = F.when(F.col("orphan"), F.concat(F.lit(ORPHAN_POINT), F.col("start"))).when(F.col("stray"), F.concat(F.lit(STRAY_ARTICLE), F.col("start")))
    return rows.select(*lines.columns, "kind", label.alias("label"), *LEVELS, verified.alias("citation_verified"), warning.alias("warning"))


def parse_units(lines: DataFrame) -> DataFrame:
    """Offsets and hierarchy of lines (document_id, pos, text)."""
    return with_hierarchy(with_offsets(lines))
