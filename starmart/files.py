"""Small files and folders in any store that Spark's file systems reach."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _path(spark: SparkSession, name: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what stands in a folder; none if there is no such folder."""
    system, path = _path(spark, folder)
    if not system.exists(path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(path))


def age_in_seconds(spark: SparkSession, name: str) -> float:
    """Seconds since a file or folder was last changed, by the driver's clock."""
    system, path = _path(spark, name)
    now = spark.sparkContext._jvm.System.currentTimeMillis()
    return (now - system.getFileStatus(path).getModificationTime()) / 1000


def read_text(spark: SparkSession, name: str) -> str:
    system, path = _path(spark, name)
    stream = system.open(path)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def put_if_absent(spark: SparkSession, name: str, text: str, draft: str) -> bool:
    """Write a text under another name, then give it its own in one step; False if that is taken.

    In a store without an atomic rename (most object stores) two writers at once can
    both believe that the name is theirs.
    """
    system, path = _path(spark, name)
    _, drafted = _path(spark, draft)
    system.mkdirs(path.getParent())
    stream = system.create(drafted, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        system.getUri(), spark.sparkContext._jsc.hadoopConfiguration()
    )
    how = gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(drafted, path, how)
    except Exception:
        system.delete(drafted, False)
        if system.exists(path):
            return False
        raise
    return True


def delete(spark: SparkSession, name: str) -> None:
    system, path = _path(spark, name)
    system.delete(path, True)
