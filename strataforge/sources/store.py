"""Intermediate tables and fitted models on shared storage."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from strataforge.session import fresh_path


def materialize(df: DataFrame, label: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back with a short plan."""
    path = fresh_path(df.sparkSession, label)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of this library's own, wherever Spark can write; nothing if it isn't there."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def save_model(model, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str, kind=PipelineModel):
    return kind.load(path)
