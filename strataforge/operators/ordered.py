"""Operators defined by a row order: progressive means, blocks, batches, sorting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strataforge.functions.ordering import average_rank, positions, running_totals


def running_mean(
    df: DataFrame, value: Column, order: list[str], every: int = 1000, out: str = "running_mean"
) -> DataFrame:
    """Mean of ``value`` over all rows so far, reported at every ``every``-th row."""
    rows = df.select(*order, value.alias("_v"), F.lit(1).cast("long").alias("_one"))
    totals = running_totals(rows, order, ["_v", "_one"])
    seq = F.col("before__one") + 1
    return (
        totals.where(seq % every == 0)
        .select(seq.alias("seq"), ((F.col("before__v") + F.col("_v")) / seq).alias(out))
    )


def row_batches(df: DataFrame, order: list[str], size: int = 10_000) -> DataFrame:
    """Batch number by row order, for sinks that want bounded chunks."""
    numbered = positions(df, order)
    return numbered.withColumn("batch", F.ceil(F.col("position") / size)).drop(
        "position", "group_rows"
    )


def top_by_rank(df: DataFrame, value: str, k: int, keys: list[str] | None = None) -> DataFrame:
    """Rows whose tie-averaged descending rank is at most ``k``."""
    ranked = average_rank(df, value, keys, "_r", descending=True)
    return ranked.where(F.col("_r") <= k).drop("_r")


def sorted_rows(df: DataFrame, order: list[str]) -> DataFrame:
    return df.orderBy(*order)


def best_by(df: DataFrame, score: str, tie: str, keys: list[str] | None = None) -> DataFrame:
    """The ``tie`` value with the highest score per group, the smallest one when tied."""
    pick = F.min(F.struct((-F.col(score)).alias("m"), F.col(tie).alias("t"))).alias("_b")
    return df.groupBy(*(keys or [])).agg(pick).select(
        *(keys or []), F.col("_b.t").alias(tie), (-F.col("_b.m")).alias(score)
    )
