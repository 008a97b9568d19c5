"""Turning columns into rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def melted(
    df: DataFrame, cols: list[str], keep: list[str] | None = None, to: str = "double",
    var: str = "var", value: str = "value",
) -> DataFrame:
    """(kept columns, var, value): one row per (row, column).

    The columns go into one array and the names are looked up by position, so
    the generated code stays small however many columns there are.
    """
    names = F.array(*[F.lit(c) for c in cols])
    values = F.array(*[F.col(c).cast(to) for c in cols])
    rows = df.select(*(keep or []), F.posexplode(values).alias("_pos", value))
    return rows.select(*(keep or []), F.element_at(names, F.col("_pos") + 1).alias(var), value)
