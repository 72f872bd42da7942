"""Intermediate tables in the shared folder of the cluster."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN = "starmart-scratch"


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; in local mode one of its own if that is unset."""
    name = "spark.checkpoint.dir"
    folder = spark.conf.get(name, None) or spark.sparkContext.getConf().get(name)
    if folder is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {name} to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="starmart-")
        spark.conf.set(name, folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession) -> str:
    """The path of a folder that nobody has used yet."""
    return f"{shared_folder(spark)}/{_OWN}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The rows written as Parquet to the shared folder and read back.

    It cuts the lineage: a lost executor costs no more than the tasks it ran, and
    what was written once is the same for every later reader.
    """
    spark = df.sparkSession
    path = new_folder(spark)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def gathered(df: DataFrame, rows: int, each: int) -> DataFrame:
    """The rows in about a task for every ``each`` of ``rows``, two per core at least, none more than there were.

    A step over few rows is not spread over all shuffle partitions, each with a file
    to write; with many rows it stays as it is. Nothing is shuffled for it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(2 * cores, -(-rows // each)))


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that no later step reads."""
    for df in tables:
        files = df.inputFiles()
        if not files:
            continue
        context = df.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        if folder.getParent().getName() == _OWN:
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
