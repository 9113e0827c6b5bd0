"""Working tables in the folder that every executor can reach."""

from __future__ import annotations

import functools
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


@functools.cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="lumenframe-")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only for local sessions."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_dir()


_made: list[str] = []


def fresh_path(spark: SparkSession, tag: str) -> str:
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Delete all working tables this process has made, once nothing derived from them is needed."""
    while _made:
        _delete(spark, _made.pop())


def materialize(df: DataFrame, tag: str = "table") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage: whatever is derived from the result sees the same rows in the same
    partitions, also after an executor is lost. Parquet keeps column pruning.
    """
    path = fresh_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(df: DataFrame) -> None:
    """Delete the files of a table made by :func:`materialize` that is no longer needed."""
    files = df.inputFiles()
    for folder in [p for p in _made if any(p.rsplit("/", 1)[-1] in f for f in files)]:
        _delete(df.sparkSession, folder)
        _made.remove(folder)
