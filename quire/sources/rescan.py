"""A corpus on disk read back: manifests, chunk indexes, chunk files and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "session_id string, source_file string, docs array<struct<seq:int,dir:string,source:string,source_copy:string,type:string,element_count:int,data_ref_count:int,image_count:int,parent:string>>"
INDEX = (
    "source string, total_elements int, total_large_tables int, total_images int, chunk_size int, chunks array<struct<file:string,pos_range:array<int>,element_count:int,includes_large_table:boolean>>,"
    "large_tables array<struct<name:string,sheet:string,pos:int,rows:int,file:string,in_chunk:string>>"
)


def manifests(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per document of the manifests at ``paths``."""
    rows = spark.read.schema(MANIFEST).option("multiLine", True).json(paths)
    return rows.select("session_id", "source_file", F.inline("docs"))


def indexes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One row per chunk index, with the folder that it describes."""
    rows = spark.read.schema(INDEX).option("multiLine", True).json(paths)
    return rows.withColumn("folder", F.regexp_extract(F.input_file_name(), r"([^/]+)/chunks/[^/]+\z", 1))


def units(indexed: DataFrame) -> DataFrame:
    """What a review loads: ``(folder, task_type, file)`` for every chunk and table of the indexes."""
    chunk = F.transform("chunks", lambda c: F.struct(F.lit("chunk").alias("task_type"), F.concat(F.lit("chunks/"), c["file"]).alias("file")))
    csv = F.transform("large_tables", lambda t: F.struct(F.lit("csv").alias("task_type"), t["file"].alias("file")))
    return indexed.select("folder", F.inline(F.concat(chunk, csv)))


def texts(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``(path, value)`` of whole text files."""
    return spark.read.option("wholetext", True).text(paths).select(F.input_file_name().alias("path"), "value")
