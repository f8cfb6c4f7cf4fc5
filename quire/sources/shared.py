"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; only a local session may go without, and gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    import tempfile

    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="quire-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder of its own in the shared one, as a URI that Arrow's file systems know too; it goes when the driver ends."""
    folder = shared_folder(spark)
    if ":" not in folder:
        folder = f"file://{os.path.abspath(folder)}"
    elif folder.startswith("file:/") and not folder.startswith("file:///"):
        folder = folder.replace("file:/", "file:///", 1)
    path = f"{folder}/{name}-{uuid.uuid4().hex}"
    atexit.register(removed, spark, path)
    return path


def staged(df: DataFrame, *by: str) -> DataFrame:
    """``df`` written to the shared folder, in a folder for each value of ``by``, and read back, for tables that several parts of a plan read; the files go when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/quire-staged-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
    atexit.register(removed, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def by_sorting(df: DataFrame) -> DataFrame:
    """``df`` for a join that sorts both sides, whatever its files' size.

    Stored rows that repeat shrink to a small part of what they take in memory, so files of a few megabytes may stand for more rows than a
    driver can hold, and by their size Spark would have it hold them, for a copy to each executor.
    """
    return df.hint("merge")


def removed(spark: SparkSession, path: str) -> None:
    """Removes a folder of intermediate files, if the session is still there to do it."""
    try:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session may have ended before
        pass
