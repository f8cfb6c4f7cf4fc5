"""Numbered elements of documents, chunks of fifty, and per-document counts.

A parsed document is one row: its key columns and ``elements``, an array of structs (position, type,
content, metadata).  Numbering and chunking work on that array, so none of them shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.functions.text import lines
from quire.operators.ranking import ranked

CHUNK = 50
ELEMENT = "struct<position:int,type:string,content:string,metadata:string>"


def text_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, elements)``: each non-blank line of a text is a paragraph, numbered from 0."""
    paragraph = lambda x, i: F.struct(i.alias("position"), F.lit("paragraph").alias("type"), x.alias("content"), F.lit(None).cast("string").alias("metadata"))
    return docs.select(id_col, F.transform(lines(F.col(text_col)), paragraph).alias("elements"))


def exploded(parsed: DataFrame) -> DataFrame:
    """One row per element with its list index ``idx``; position and index may differ.

    The outer form keeps the optimizer from testing the list's size beforehand, which would parse the text twice.
    """
    keys = [c for c in parsed.columns if c != "elements"]
    rows = parsed.select(*keys, F.posexplode_outer("elements").alias("idx", "e")).where("idx is not null")
    return rows.select(*keys, "idx", "e.position", "e.type", "e.content", "e.metadata")


def chunk_file(number: Column) -> Column:
    """File name of the chunk with this number, from 1."""
    return F.format_string("chunk_%04d.md", number)


def with_chunks(parsed: DataFrame, size: int = CHUNK) -> DataFrame:
    """One row per chunk: the keys, ``elements`` of the document, ``chunk_no``, ``chunks``, ``pos_lo``, ``pos_hi``, ``element_count``.

    Ranges are on the list index.  A document without elements has one chunk with the range 0 to -1.
    """
    n = F.size("elements")
    chunks = F.greatest(F.lit(1), F.ceil(n / size)).cast("int")
    rows = parsed.withColumn("chunks", chunks).withColumn("chunk_no", F.explode(F.sequence(F.lit(1), F.col("chunks"))))
    lo = (F.col("chunk_no") - 1) * size
    rows = rows.withColumn("pos_lo", lo).withColumn("pos_hi", F.least(F.col("pos_lo") + size - 1, n - 1))
    return rows.withColumn("element_count", F.col("pos_hi") - F.col("pos_lo") + 1)


def element_counts(elements: DataFrame, keys: list[str]) -> DataFrame:
    """Elements of each type under ``keys``."""
    return elements.groupBy(*keys, "type").agg(F.count("*").alias("n"))


def path_key(path: Column) -> Column:
    """An array of child ordinals as bytes that sort as it does: four bytes for each, so a parent comes before its children."""
    return F.unhex(F.array_join(F.transform(path, lambda x: F.lpad(F.hex(x), 8, "0")), ""))


def preorder(nodes: DataFrame, session: list[str], path: str = "path") -> DataFrame:
    """``nodes`` with ``seq``: the place of each in its session in the order of ``path``, an array of child ordinals.

    Arrays compare element by element with the shorter first, so the order is parents before children.
    A session may hold any number of nodes: ranges of paths are numbered side by side.
    """
    rows = ranked(nodes.withColumn("__path", path_key(F.col(path))), session, ["__path"], "seq")
    return rows.withColumn("seq", F.col("seq").cast("int")).drop("__path")
