"""A stream of numbered pages: ``spark.readStream.format("numbered_pages")``.

A folder holds pages as ``page=<number>/*.parquet``, numbered from 0. Every micro-batch plans the next ``pagesPerBatch`` pages and
deals them over ``lanes`` partitions, which read their pages in Arrow batches. Offsets are (pass, page); with ``passes`` above
one, the pages are read again after the last one, as a listing is that changes while it is read. New pages are found by their
folders. What a planned batch will have reached is noted in ``progress``, so that a stream which starts again from its
checkpoint goes on there; a batch that has to be repeated is planned first, and reads the very same pages.

Rows have the columns of the schema given, with ``page`` and ``pass``.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType, _parse_datatype_string

FORMAT = "numbered_pages"


class PageRange(InputPartition):
    def __init__(self, number: int, first: int, end: int):
        super().__init__(None)
        self.number, self.first, self.end = number, first, end


def filesystem(uri: str):
    """(filesystem, path) of a URI or local path, for readers that run in Python."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


class PagedReader(DataSourceStreamReader):
    def __init__(self, schema: StructType, options):
        self.schema = schema
        self.path, self.progress = options["path"].rstrip("/"), options["progress"]
        self.size, self.lanes, self.passes = (int(options.get(k, d)) for k, d in (("pagesPerBatch", 4), ("lanes", 2), ("passes", 1)))
        if min(self.size, self.lanes, self.passes) < 1:
            raise ValueError("pagesPerBatch, lanes and passes must be positive")
        self.at: tuple[int, int] | None = None

    def _available(self) -> int:
        """Pages without a gap from 0."""
        from pyarrow import fs

        store, root = filesystem(self.path)
        found = {int(x.base_name[5:]) for x in store.get_file_info(fs.FileSelector(root, allow_not_found=True)) if x.base_name.startswith("page=")}
        return next(n for n in range(len(found) + 1) if n not in found)

    def initialOffset(self) -> dict:
        return {"pass": 0, "page": 0}

    def latestOffset(self) -> dict:
        """The end of the next micro-batch; the one before it if there is no further page."""
        if self.at is None:
            self.at = self._noted()
        number, page = self.at
        pages = self._available()
        if page >= pages and pages and number + 1 < self.passes:
            number, page = number + 1, 0
        self.at = (number, max(page, min(pages, page + self.size)))
        return {"pass": self.at[0], "page": self.at[1]}

    def partitions(self, start: dict, end: dict) -> list[PageRange]:
        self._note(end)
        number, first = (end["pass"], 0) if end["pass"] > start["pass"] else (start["pass"], start["page"])
        count = end["page"] - first
        if count <= 0:
            return []
        lanes = min(self.lanes, count)
        cuts = [first + count * k // lanes for k in range(lanes + 1)]
        return [PageRange(number, a, b) for a, b in zip(cuts, cuts[1:])]

    def read(self, partition: PageRange) -> Iterator:
        import pyarrow as pa
        import pyarrow.parquet as pq
        from pyarrow import fs
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(self.schema)
        own = [n for n in target.names if n not in ("page", "pass")]
        store, root = filesystem(self.path)
        for page in range(partition.first, partition.end):
            for entry in sorted(store.get_file_info(fs.FileSelector(f"{root}/page={page}")), key=lambda x: x.path):
                if not entry.base_name.endswith(".parquet"):
                    continue
                with store.open_input_file(entry.path) as file:
                    for batch in pq.ParquetFile(file).iter_batches(columns=own):
                        given = {"page": pa.array([page] * batch.num_rows, pa.int64()), "pass": pa.array([partition.number] * batch.num_rows, pa.int64())}
                        given |= {n: batch.column(n) for n in own}
                        yield pa.RecordBatch.from_arrays([given[n].cast(target.field(n).type) for n in target.names], schema=target)

    def _note(self, end: dict) -> None:
        self.at = max(self.at or (0, 0), (end["pass"], end["page"]))
        store, path = filesystem(self.progress)
        store.create_dir(path.rsplit("/", 1)[0], recursive=True)
        with store.open_output_stream(f"{path}.part") as out:
            out.write(json.dumps(end).encode())
        store.move(f"{path}.part", path)

    def _noted(self) -> tuple[int, int]:
        store, path = filesystem(self.progress)
        try:
            with store.open_input_stream(path) as told:
                noted = json.loads(told.read())
            return noted["pass"], noted["page"]
        except FileNotFoundError:
            return 0, 0


class NumberedPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return f"{self.options['columns']}, page long, pass long"

    def streamReader(self, schema: StructType) -> PagedReader:
        return PagedReader(schema, self.options)  # names without regard to case


def read_pages(spark: SparkSession, path: str, columns: str, progress: str, pages_per_batch: int = 4, lanes: int = 2, passes: int = 1):
    """The stream of a folder of pages whose files have ``columns`` (DDL)."""
    _parse_datatype_string(columns)
    spark.dataSource.register(NumberedPages)
    options = {"path": path, "columns": columns, "progress": progress, "pagesPerBatch": str(pages_per_batch), "lanes": str(lanes), "passes": str(passes)}
    return spark.readStream.format(FORMAT).options(**options).load()


def run_once(stream, folder: str, checkpoint: str) -> None:
    """Write a stream's rows below ``folder``, a folder for each batch, until all pages that are there are read."""
    stream.sparkSession.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")  # they would move watermarks
    query = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, number: batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")).start()
    try:
        query.processAllAvailable()
    finally:
        query.stop()
