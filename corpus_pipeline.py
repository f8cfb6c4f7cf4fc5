"""A training corpus from ``documents``: quality, near-duplicates, repeated passages, benchmark leaks, packing.

Every stage takes rows with nulls in any column, empty and very long texts, repeated rows and columns of any other name; an
empty table gives an empty result.  What each does with them is said at the operator that it calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quire.llm import decontaminate, packing, quality, simhash, substring
from quire.llm.common import mark, release_since, stored
from quire.llm.queries import table


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose importance ratio the labelled good text supports; the others go.

    The ratio is held against a threshold: a Gumbel top-k draw, which ``op8_quality`` makes too, would drop clean
    documents by chance.
    """
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies (five-word shingles, similarity 0.8 or more), the document with the smallest id."""
    return simhash.keep_one_of_each(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages of 35 words or more that occur more than once; ``n_chars`` follows the text."""
    return substring.without_repeats(docs).withColumn("n_chars", F.length("text").cast("long"))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of each document, in pieces, in bins of equal capacity; near copies are gone by now, so the cluster is the text."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("simhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", decontamination),
    ("best-fit packing", best_fit_packing),
]

#: Fingerprints and trained ratios have no SQL form; the tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result but the last is written as Parquet and read again as the next one's ``docs``.

    What a stage has stored for itself, and what it read, is removed once its result is written.
    """
    docs, since = table(spark, sf_dir, "documents"), mark()
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)
            release_since(since, docs)
    return docs
