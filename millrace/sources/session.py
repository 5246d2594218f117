"""What a session needs so that Python workers find the package."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ship_package(spark: SparkSession) -> None:
    """Put the package's folder on the workers' path, for drivers that run elsewhere."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    path = spark.sparkContext.environment.get("PYTHONPATH", os.environ.get("PYTHONPATH", ""))
    if root not in path.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (root, path) if x)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table; one with fewer file splits than the session has cores is dealt out over them first.

    Such a table is small (at most one split of ``spark.sql.files.maxPartitionBytes`` a core), and often one row group.
    """
    rows = spark.read.parquet(path)
    cores = spark.sparkContext.defaultParallelism
    return rows if rows.rdd.getNumPartitions() >= cores else rows.repartition(cores)


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, which the driver and all executors share.

    Where that is unset, a session in one process (master ``local``) takes a folder of its own; a cluster has to name one.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = os.environ.setdefault("MILLRACE_LOCAL_FOLDER", tempfile.mkdtemp(prefix="millrace-own-"))
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def kept(rows: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared folder and read back, so that no later step makes them again."""
    path = shared_folder(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on its own filesystem."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def delete_path(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
