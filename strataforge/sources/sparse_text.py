"""Sparse text rows: libsvm in, namespaced rows out."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from strataforge.operators.columns import signed_label


def libsvm_lines(df: DataFrame, label: str, cols: list[str]) -> DataFrame:
    """``label idx:val ...`` with 1-based indices; zeros and NULLs are left out."""
    cells = [
        F.when(F.col(c).isNotNull() & (F.col(c) != 0), F.concat(F.lit(f"{i}:"), F.col(c).cast("string")))
        for i, c in enumerate(cols, 1)
    ]
    return df.select(F.concat_ws(" ", F.col(label).cast("string"), *cells).alias("value"))


def read_libsvm(spark: SparkSession, path, features: int, parts: int | None = None) -> DataFrame:
    """Labelled sparse vectors; giving the width saves a scan of the files."""
    table = spark.read.format("libsvm").option("numFeatures", features).load(path)
    return table.repartition(parts) if parts else table


def namespaced_line(
    row_id: str, label: Column | None, families: Mapping[str, list[str]], numeric: list[str]
) -> Column:
    """``label 'id |r name:value |f name_value ...``; label 1 where there is no target."""
    def block(name: str, parts: list[Column]) -> Column:
        return F.concat_ws(" ", F.lit(f"|{name}"), *parts)

    def shown(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    numbers = block("r", [F.concat(F.lit(f"{c}:"), shown(c)) for c in numeric])
    groups = [
        block(name, [F.concat(F.lit(f"{c}_"), shown(c)) for c in cols])
        for name, cols in families.items()
    ]
    sign = F.lit(1) if label is None else F.coalesce(signed_label(label), F.lit(1))
    head = F.concat(sign.cast("string"), F.lit(" '"), F.col(row_id).cast("string"))
    return F.concat_ws(" ", head, numbers, *groups)


def namespaced_rows(
    df: DataFrame, row_id: str, families: Mapping[str, list[str]], numeric: list[str],
    label: str | None = None,
) -> DataFrame:
    line = namespaced_line(row_id, F.col(label) if label else None, families, numeric)
    return df.select(line.alias("value"))


def write_lines(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").text(path)
