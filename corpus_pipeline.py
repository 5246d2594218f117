"""The corpus pipeline: toxicity, SimHash near-duplicates, decontamination, secret scans, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it has kept; its result is written as
Parquet and read again for the next one. All stages but the last return the columns of ``documents`` with whatever names
they have; the operators work on reserved names. An empty table, or a stage that keeps nothing, passes through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import packing, secret_scan, simhash_golay, toxicity
from millrace.llm.decontamination import decontaminate
from millrace.llm.shared import fresh_folder, reserved

REDACTED = "[secret]"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity scores reject go; the model is fitted on labelled documents of this very input.

    Null and empty texts score like texts without terms and stay; repeated rows are judged one by one.
    """
    model = toxicity.fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    held, names, back = reserved(docs)
    scored = toxicity.score_toxicity(held, model, text_col=names["text"], carry=tuple(names.values()))
    return back(scored.where("predicted = 0"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near-duplicates one row stays, that with the smallest id, whatever its text's place.

    The rule is op3's: fingerprints of 3-word shingles that differ in at most three bits. It is far narrower than a 5-word
    Jaccard similarity of 0.8 or more; README.md gives the share of such copies that it links. Texts without words are one
    group; of rows that repeat an id within a group one stays; rows without an id stay only where no row of their group has one.
    """
    return simhash_golay.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with any word inside a benchmark window go; null and empty texts stay, repeated rows are judged one by one."""
    held, names, back = reserved(docs)
    found = decontaminate(held, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), text_col=names["text"], carry=tuple(names.values()))
    return back(found.where("NOT contaminated"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every stretch that secret spans cover is replaced; n_chars follows the new text. No row goes; null texts stay null."""
    held, names, back = reserved(docs)
    found = secret_scan.scan_secrets(held, text_col=names["text"], carry=tuple(names.values()), redact=REDACTED)
    if "n_chars" in names:
        size = F.char_length(names["text"]).cast(docs.schema["n_chars"].dataType)
        found = found.withColumn(names["n_chars"], F.when(F.size("secrets") > 0, size).otherwise(F.col(names["n_chars"])))
    return back(found)


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most 2048 tokens; null and empty texts are the end token alone."""
    return packing.with_digest(packing.pack(docs))


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_documents),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with a written table between any two."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_folder(spark, f"pipeline-{name}")
        made = stage(spark, docs, sf_dir)
        made.write.parquet(path)
        docs = spark.read.schema(made.schema).parquet(path)
    return docs
