"""The corpus pipeline: stages over documents, each written and read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataforge.llm import stages
from strataforge.sources.store import materialize

#: (name, function) in order; each function takes (spark, docs, sf_dir) and returns a DataFrame.
STAGES = [
    ("quality classifier", stages.good_documents),
    ("line dedup", stages.without_repeated_lines),
    ("n-gram Jaccard join", stages.one_of_each_group),
    ("benchmark decontamination", stages.without_benchmark),
    ("BPE encoding and decoding", stages.encoded),
]

#: The classifier and the latent retrieval can't be written in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
