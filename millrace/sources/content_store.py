"""Content-addressed store: payloads under their SHA-256, each written once, by the tasks that hold them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _filesystem(uri: str):
    return arrow_fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def store_payloads(rows: DataFrame, root: str, payload_col: str = "payload", suffix_col: str = "suffix") -> DataFrame:
    """(relative_path, sha256, deduplicated) of each different payload and suffix; what exists already isn't written.

    A payload is written beside its place and moved there, so readers never meet half a file, and a repeated task
    does no harm.
    """
    digest = F.sha2(F.col(payload_col), 256)
    unique = rows.where(F.col(payload_col).isNotNull()).select(digest.alias("sha256"), F.col(payload_col).alias("payload"), F.coalesce(suffix_col, F.lit("")).alias("suffix")).dropDuplicates(["sha256", "suffix"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _filesystem(root)
        files.create_dir(f"{base}/artifacts", recursive=True)
        for batch in batches:
            names, hashes, known = [], [], []
            for sha, payload, suffix in zip(*(batch.column(i).to_pylist() for i in range(3))):
                name = f"artifacts/{sha}{suffix}"
                there = files.get_file_info(f"{base}/{name}").type != arrow_fs.FileType.NotFound
                if not there:
                    part = f"{base}/artifacts/.{sha}{suffix}.{uuid.uuid4().hex}.part"
                    with files.open_output_stream(part, compression=None) as out:
                        out.write(payload)
                    files.move(part, f"{base}/{name}")
                names.append(name)
                hashes.append(sha)
                known.append(there)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(hashes, pa.string()), pa.array(known, pa.bool_())], ["relative_path", "sha256", "deduplicated"])

    return unique.mapInArrow(run, "relative_path string, sha256 string, deduplicated boolean")
