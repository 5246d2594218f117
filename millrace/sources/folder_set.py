"""Several folders of JSON lines that appear at once or not at all: ``df.write.format("folder_set")``.

Rows (folder, line) are written by tasks as ``<folder>/part-<partition>-<attempt>.json`` into a staging folder beside the target, on
the target's own filesystem. When all tasks are done, ``commit`` takes out the files of attempts that don't count, adds the small
files given as options, and publishes everything by one rename; ``abort`` removes the staging folder. So a task may be repeated or
run twice, and nobody sees half of a result. A target that exists is an error, before and after the tasks.

The rename is atomic where a folder's rename is (local disks, HDFS); object stores without one aren't supported.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from millrace.streaming.paged_stream import filesystem

FORMAT = "folder_set"
PART_ROWS = 200_000  # lines of one task
OWN = "."  # a folder name for the target itself


@dataclass
class Written(WriterCommitMessage):
    """The files of one attempt and how many lines each folder got."""

    files: list[str]
    lines: dict[str, int]


class FolderSetWriter(DataSourceArrowWriter):
    def __init__(self, target: str, folders: list[str], extras: dict[str, str]):
        self.target, self.folders, self.extras = target.rstrip("/"), folders, extras
        head, _, name = self.target.rpartition("/")
        self.staging = f"{head}/.{name}.{uuid.uuid4().hex}.part"
        self._refuse_existing()

    def _refuse_existing(self) -> None:
        from pyarrow import fs

        store, path = filesystem(self.target)
        if store.get_file_info(path).type != fs.FileType.NotFound:
            raise FileExistsError(self.target)

    def write(self, batches: Iterator) -> Written:
        context = TaskContext.get()
        part, attempt = (context.partitionId(), context.attemptNumber()) if context else (0, uuid.uuid4().hex)
        store, root = filesystem(self.staging)
        out, made, lines = {}, [], {}
        try:
            for batch in batches:
                for folder, line in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                    if folder not in self.folders:
                        raise ValueError(f"not a declared folder: {folder}")
                    if folder not in out:
                        name = f"{folder}/part-{part:05d}-{attempt}.json"
                        store.create_dir(f"{root}/{folder}", recursive=True)
                        out[folder] = store.open_output_stream(f"{root}/{name}")
                        made.append(name)
                    out[folder].write(line.encode() + b"\n")
                    lines[folder] = lines.get(folder, 0) + 1
        finally:
            for file in out.values():
                file.close()
        return Written(made, lines)

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        store, root = filesystem(self.staging)
        _, target = filesystem(self.target)
        kept = {f for m in messages if m is not None for f in m.files}
        for folder in self.folders:
            store.create_dir(f"{root}/{folder}", recursive=True)
            for entry in store.get_file_info(fs.FileSelector(f"{root}/{folder}")):
                if entry.type == fs.FileType.File and f"{folder}/{entry.base_name}" not in kept:
                    store.delete_file(entry.path)
        for name, text in self.extras.items():
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(text.encode())
        self._refuse_existing()
        store.move(root, target)

    def abort(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        store, root = filesystem(self.staging)
        if store.get_file_info(root).type != fs.FileType.NotFound:
            store.delete_dir(root)


class FolderSet(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "folder string, line string"

    def writer(self, schema, overwrite: bool) -> FolderSetWriter:
        return FolderSetWriter(self.options["path"], json.loads(self.options["folders"]), json.loads(self.options.get("extras", "{}")))


def publish(spark: SparkSession, tables: dict[str, tuple[DataFrame, list[str]]], target: str, extras: dict[str, str] | None = None) -> None:
    """Write tables, each as JSON lines of its folder in the order of its key columns, the first of which deals the rows.

    Rows that agree in the first key column stand in one file. Nulls are written; a run over the same rows gives the same files.
    """
    spark.dataSource.register(FolderSet)
    if not target.startswith("/") and "://" not in target:
        raise ValueError("target has to be an absolute path or a URI")
    rows = None
    for folder, (table, order) in tables.items():
        line = F.to_json(F.struct(*[F.col(f"`{c}`") for c in table.columns]), {"ignoreNullFields": "false"})
        own = table.select(F.lit(folder).alias("folder"), line.alias("line"), F.struct(*order).alias("key"))
        parts = max(1, -(-table.count() // PART_ROWS))
        own = own.repartition(parts, F.col(f"key.{order[0]}")).sortWithinPartitions("key").select("folder", "line")
        rows = own if rows is None else rows.unionByName(own)
    rows.write.format(FORMAT).mode("append").option("folders", json.dumps(list(tables))).option("extras", json.dumps(extras or {})).save(target)
