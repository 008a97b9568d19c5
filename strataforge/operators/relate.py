"""Joins and set operations, always by key and never by row position."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from strataforge.functions.lookup import lookup


def merge_all(tables: list[DataFrame], on: str, value: str) -> DataFrame:
    """Inner merge of k tables; ``value`` of table i becomes ``<value>i``."""
    named = [t.select(on, F.col(value).alias(f"{value}{i}")) for i, t in enumerate(tables, 1)]
    return reduce(lambda a, b: a.join(b, on), named)


def merge_all_long(long: DataFrame, on: str, model: str, value: str, names: list[str]) -> DataFrame:
    """The same from the long form: one shuffle for any number of models."""
    wide = long.groupBy(on).pivot(model, names).agg(F.first(value))
    return wide.dropna(subset=names)


def lookup_join(df: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    return lookup(df, table, on)


def attach_folds(df: DataFrame, folds: DataFrame, on: str) -> DataFrame:
    return df.join(folds, on)


def hconcat(tables: list[DataFrame], on: str) -> DataFrame:
    """Columns of several tables side by side; a repeated column stays once."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t.drop(*[c for c in t.columns if c in out.columns and c != on]), on)
    return out


def vconcat(train: DataFrame, test: DataFrame, mark: str = "split") -> DataFrame:
    return train.withColumn(mark, F.lit("train")).unionByName(
        test.withColumn(mark, F.lit("test")), allowMissingColumns=True
    )


def split_back(df: DataFrame, mark: str = "split") -> tuple[DataFrame, DataFrame]:
    return (
        df.where(F.col(mark) == "train").drop(mark),
        df.where(F.col(mark) == "test").drop(mark),
    )


def _marked(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """The lookup measures the keys and spreads hot and missing ones."""
    return lookup(df, keys.select(*on).distinct().withColumn("_member", F.lit(True)), on)


def members(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    return _marked(df, keys, on).where(F.col("_member").isNotNull()).drop("_member")


def non_members(df: DataFrame, keys: DataFrame, on: list[str]) -> DataFrame:
    """Rows without a match; a NULL key has none."""
    return _marked(df, keys, on).where(F.col("_member").isNull()).drop("_member")


def distinct_union(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.union(b).distinct()


def column_pairs(df: DataFrame, cols: list[str]) -> DataFrame:
    """The (i < j) pairs of a table's columns, as rows; its size is set by the schema."""
    rows = [
        (i + 1, j + 1, cols[i], cols[j])
        for i in range(len(cols))
        for j in range(i + 1, len(cols))
    ]
    return df.sparkSession.createDataFrame(rows, "i int, j int, a string, b string")


def pair_by_model(valid: DataFrame, full: DataFrame, model: str = "model") -> DataFrame:
    """Models that have both a holdout and a test score table."""
    return valid.select(model).distinct().join(full.select(model).distinct(), model)


def dedup_rows(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*cols).dropDuplicates(cols)
