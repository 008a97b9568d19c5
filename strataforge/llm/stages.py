"""Stages of the corpus pipeline: each takes (spark, docs, sf_dir) and keeps the columns of documents but for the last."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataforge.llm import bpe_codec, decontaminate, line_dedup, ngram_join, quality
from strataforge.llm.naming import unused

#: Near duplicates in the pipeline: words of a shingle and similarity in percent.
SHINGLE, PERCENT = 5, 80


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.quality_scores(docs).where("kept").select(*docs.columns)


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines found in ten or more documents go, in all of them; ``n_chars`` follows the text."""
    kept = line_dedup.drop_repeated_lines(docs, min_docs=10, min_chars=1)
    n_chars = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", n_chars).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by near-duplicate texts, the one with the smallest id stays.

    Documents without words are no duplicates of each other; rows without an id stay.
    """
    name = unused(docs.columns, "_gone")
    groups = ngram_join.ngram_components(docs, k=SHINGLE, percent=PERCENT)
    gone = groups.where("component_id < doc_id").select(F.col("doc_id").alias(name)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(name), "left_anti").select(*docs.columns)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.clean_documents(docs, benchmark).select(*docs.columns)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the text decoded from them."""
    from strataforge.llm.queries import vocabulary

    coded = bpe_codec.round_trip(docs, vocabulary("word_bpe_49k.json"))
    return coded.select("doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")
