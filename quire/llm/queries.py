"""The dealt operators applied to their whole tables, for ``__spark_entry__``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quire.llm import decontaminate, html, media, packing, periodic, pieces, quality, simhash, spelling, substring, tokencount, tokenfiles, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public tokenizer's file on the driver; executors get its contents."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.learn(docs, table(spark, sf_dir, "labels")))


def op2_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.removed_words(table(spark, sf_dir, "documents"))


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.text_audio(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters are components of near copies, as in ``op3_simhash``."""
    docs = table(spark, sf_dir, "documents").withColumn("words", packing.word_count("text"))
    return packing.pack(simhash.with_cluster(docs, "near", keep=["source", "words"]), cluster_col="near", words_col="words")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = tokencount.with_sample_edits(table(spark, sf_dir, "documents"))
    return tokencount.edited_counts(docs, vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.token_output(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=2)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.run_digests(periodic.collapsed_runs(table(spark, sf_dir, "documents"), order=periodic.planted))


def op12_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digests(pieces.piece_ids(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), decode=True))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"), damage=97)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_html, op3_simhash, op4_substring, op5_media, op6_packing, op7_token_counts, op8_quality, op9_decontamination, op10_token_files,
        op11_periodic_runs, op12_pieces, op13_spelling,
    )
}

ORACLE_SQL: dict[str, str] = {"op9_decontamination": decontaminate.ORACLE}
