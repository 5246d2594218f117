"""Plumbing shared by the operators: shared storage, Arrow row mapping and connected components."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def release_memory() -> None:
    """Give what a worker has freed back to the system, since workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def ship_package(spark: SparkSession) -> None:
    """Let Python workers find the package when the driver runs outside its folder."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if root not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, path) if x)


def shared_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset, a session that runs in one process (master ``local``) takes a local folder; a cluster has to name one.
    """
    conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = os.environ.get("MILLRACE_LOCAL_CHECKPOINTS") or tempfile.mkdtemp(prefix="millrace-")
        os.environ["MILLRACE_LOCAL_CHECKPOINTS"] = conf
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(conf)
    return conf


_made: list[str] = []


ROW_GROUP = 16 << 20  # bytes that a writer of a temporary table holds
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared root."""
    _made.append(f"{shared_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}")
    return _made[-1]


def clean_up(spark: SparkSession) -> None:
    """Delete the folders of tables that this session wrote; results that still read them must have been saved before."""
    jvm = spark.sparkContext._jvm
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and carry on from there (reliable checkpoint)."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def write_table(df: DataFrame, label: str, partition_by: list[str] | None = None, codec: str | None = None) -> DataFrame:
    """Write as Parquet under the shared root and read it back: keeps columnar pruning, survives lost executors.

    What was shuffled for the table is deleted with the end of the write; else it stays until the driver collects its garbage.
    """
    path = fresh_folder(df.sparkSession, label)
    writer = df.write.option("parquet.block.size", ROW_GROUP)
    if codec:
        writer = writer.option("compression", codec)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    conf, before = df.sparkSession.conf, df.sparkSession.conf.get(DROP_SHUFFLES, "false")
    conf.set(DROP_SHUFFLES, "true")
    try:
        writer.parquet(path)
    finally:
        conf.set(DROP_SHUFFLES, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def quoted(name: str):
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def map_text(
    docs: DataFrame,
    worker: Callable[[], Callable[[pa.LargeStringArray, pa.BooleanArray], dict[str, pa.Array]]],
    out: T.StructType,
    text_col: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """One output row per input row: the carried columns and what ``worker()`` makes of the text column.

    Only the carried columns and the text leave the scan, the text once if it is carried too. Null texts arrive as empty, with a
    mask that tells them.
    A carried column whose name is also a result column is replaced by the result; ``reserved`` keeps all of them.
    """
    own = text_col in carry and docs.schema[text_col].dataType == T.StringType()
    sent = tuple(c for c in carry if c not in out.names or (own and c == text_col))
    kept = [k for k, c in enumerate(sent) if c not in out.names]
    picked = docs.select(*[quoted(c) for c in sent], *([] if own else [quoted(text_col).cast("string").alias("__text")]))
    at = sent.index(text_col) if own else len(sent)
    schema = T.StructType([*(picked.schema.fields[k] for k in kept), *out.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        handle = worker()
        for batch in batches:
            if batch.num_rows == 0:
                continue
            text = batch.column(at).cast(pa.large_string())
            made = handle(text.fill_null(""), text.is_null())
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), *(made[n] for n in out.names)], [*(sent[k] for k in kept), *out.names])
            del made, text, batch
        del handle
        release_memory()

    return picked.mapInArrow(run, schema)


def reserved(docs: DataFrame) -> tuple[DataFrame, dict[str, str], Callable[[DataFrame], DataFrame]]:
    """(the rows under names that no operator uses, the name of each column there, what gives the columns their names back)."""
    names = {c: f"__in{k}" for k, c in enumerate(docs.columns)}
    held = docs.select(*[quoted(c).alias(n) for c, n in names.items()])
    return held, names, lambda df: df.select(*[F.col(n).alias(c) for c, n in names.items()])


def distinct_edges(edges: DataFrame) -> DataFrame:
    """Undirected links as (u < v), once each."""
    return edges.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).where("u < v").distinct()


def join_dealt(rows: DataFrame, told: DataFrame, key: str, by: str, most: int) -> DataFrame:
    """``rows`` joined with ``told``, which tells in ``n`` how many rows have its key.

    Keys of more than ``most`` rows are dealt in parts by the column ``by``, however hot they are. There are fewer such
    keys than rows / ``most``, which bounds what is broadcast.
    """
    told = told.withColumn("__of", F.ceil(F.col("n") / most).cast("int"))
    hubs = told.where("__of > 1").select(F.col(key).alias("__hub"), "__of").distinct()
    part = F.coalesce(F.pmod(F.xxhash64(by), F.col("__of")).cast("int"), F.lit(0))
    dealt = rows.join(F.broadcast(hubs), F.col(key) == F.col("__hub"), "left").withColumn("__part", part).drop("__hub", "__of")
    copies = told.withColumn("__part", F.explode(F.sequence(F.lit(0), F.col("__of") - 1))).drop("__of", "n")
    return dealt.join(copies, [key, "__part"]).drop("__part")


HUB_LINKS = 512  # links of one node that a task takes, at least
MOST_HUBS = 1_000_000  # rows (node, parts) that are ever broadcast


def _with_least(links: DataFrame, hub: int) -> DataFrame:
    """(u, v, low): links with the least ``v`` of their ``u``."""
    return join_dealt(links, links.groupBy("u").agg(F.min("v").alias("low"), F.count(F.lit(1)).alias("n")), "u", "v", hub)


def connected_components(edges: DataFrame, max_rounds: int = 60, hub_links: int = HUB_LINKS) -> DataFrame:
    """(node, component) for every node of the undirected links (u, v); component is its smallest reachable node.

    Large-star and small-star steps alternate until the links no longer change; they end as stars around
    the smallest node. Each round is cut by a reliable checkpoint; the centre of a large star is dealt over several tasks.
    Null links are ignored; no link gives no row.
    """
    now = cut(distinct_edges(edges.where("u IS NOT NULL AND v IS NOT NULL")))
    stamp = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    state = now.agg(F.count(F.lit(1)), stamp).first()
    if state[0] == 0:
        return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    for _ in range(max_rounds):
        hub = max(hub_links, 2 * state[0] // MOST_HUBS)
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: every node hands its larger neighbours to the least of them and itself
        large = _with_least(both, hub).where("v > u").select(F.least("low", "u").alias("u"), "v").where("u < v").distinct()
        # small star: every node hands its smaller neighbours to the smallest of them
        down = _with_least(large.select(F.col("v").alias("u"), F.col("u").alias("v")), hub)
        ends = F.array(F.struct(F.col("low").alias("u"), F.col("v").alias("v")), F.struct(F.col("low").alias("u"), F.col("u").alias("v")))
        now = cut(down.select(F.explode(ends).alias("e")).select("e.u", "e.v").where("u < v").distinct())
        after = now.agg(F.count(F.lit(1)), stamp).first()
        if tuple(after) == tuple(state):
            break
        state = after
    else:
        raise RuntimeError("connected components did not settle")
    return now.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("component")).union(now.groupBy(F.col("u").alias("node")).agg(F.min("u").alias("component")))
