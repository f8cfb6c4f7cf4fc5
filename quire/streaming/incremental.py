"""Incremental extraction: new files in a folder, taken in as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from quire.functions.text import last_segment
from quire.plans.expand import expand

FILES = "path string, modificationTime timestamp, length long, content binary"


def new_files(spark: SparkSession, folder: str, most_files: int = 1000) -> DataFrame:
    """Files of ``folder`` as a stream, at most ``most_files`` at a time."""
    return spark.readStream.format("binaryFile").schema(FILES).option("maxFilesPerTrigger", most_files).load(folder)


def extract_stream(spark: SparkSession, folder: str, table_path: str, checkpoint: str) -> StreamingQuery:
    """Expands what has come since the last call and adds its documents to the Parquet table at ``table_path``.

    A session is one version of a file: its path and time.  Each batch has a folder of its own, so a batch that runs
    again after a failure replaces itself.
    """

    def take(batch: DataFrame, number: int) -> None:
        session = F.md5(F.concat_ws("|", "path", F.col("modificationTime").cast("string")))
        sources = batch.select(session.alias("session_id"), last_segment(F.col("path")).alias("file_name"), "content")
        expand(sources)["docs"].write.mode("overwrite").parquet(f"{table_path}/batch={number}")

    return new_files(spark, folder).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
