"""Whole-table column profiles: one aggregation pass for all columns."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

from strataforge.operators.columns import columns_of_kind


def per_column(df: DataFrame, measures: dict[str, Column | object], cols: list[str]) -> DataFrame:
    """Rows (var, <measure>...) from one aggregate over all columns.

    ``measures`` maps an output name to a function of the column.  The single
    aggregate row is turned on its side, so no data row is ever unpivoted.
    """
    exprs, structs = [], []
    for i, c in enumerate(cols):
        fields = [F.lit(c).alias("var"), F.lit(i + 1).alias("idx")]
        for name, measure in measures.items():
            exprs.append(measure(F.col(c)).alias(f"_{i}_{name}"))
            fields.append(F.col(f"_{i}_{name}").alias(name))
        structs.append(F.struct(*fields))
    return df.agg(*exprs).select(F.inline(F.array(*structs)))


def null_counts(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    cols = list(df.columns if cols is None else cols)
    return per_column(
        df,
        {"n_null": lambda c: F.count_if(c.isNull()), "n_rows": lambda c: F.count(F.lit(1))},
        cols,
    )


def all_null_columns(df: DataFrame, cols: Iterable[str] | None = None) -> list[str]:
    hits = null_counts(df, cols).where("n_null = n_rows and n_rows > 0").orderBy("idx")
    return [r["var"] for r in hits.collect()]


def columns_with_nulls(df: DataFrame, cols: Iterable[str] | None = None) -> list[str]:
    hits = null_counts(df, cols).where("n_null > 0").orderBy("idx")
    return [r["var"] for r in hits.collect()]


def constant_columns(
    df: DataFrame, cols: Iterable[str] | None = None, fill: float | None = None
) -> list[str]:
    """Numeric columns whose values (after an optional fill) are all the same.

    Equality of minimum and maximum is exact where a deviation of zero is not.
    A column with fewer than two values has no deviation and is kept.
    """
    cols = columns_of_kind(df, "numeric") if cols is None else list(cols)

    def filled(c: Column) -> Column:
        return c if fill is None else F.coalesce(c, F.lit(fill))

    spans = per_column(
        df,
        {
            "same": lambda c: F.min(filled(c)) == F.max(filled(c)),
            "n": lambda c: F.count(filled(c)),
        },
        cols,
    )
    return [r["var"] for r in spans.where("same and n > 1").orderBy("idx").collect()]


def min_max(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    cols = columns_of_kind(df, "numeric") if cols is None else list(cols)
    return per_column(
        df,
        {
            "min_value": lambda c: F.min(c.cast("double")),
            "max_value": lambda c: F.max(c.cast("double")),
        },
        cols,
    )


def _content(name: str, row_id: str) -> Column:
    return F.xxhash64(F.col(row_id), F.col(name))


def duplicate_columns(
    df: DataFrame, row_id: str, cols: Iterable[str] | None = None
) -> list[str]:
    """Columns equal, NULLs included, to an earlier column of the same type.

    Pass one fingerprints every column (hash of row id and value, combined by
    xor, and the NULL count); pass two compares candidates value by value.  A
    fingerprint clash leaves several distinct columns in one candidate group,
    so the comparison repeats with the next column as the model until the
    group is used up.
    """
    cols = [c for c in (df.columns if cols is None else cols) if c != row_id]
    types = dict(df.dtypes)
    prints = per_column(
        df.select(row_id, *cols),
        {
            "nulls": lambda c: F.count_if(c.isNull()),
            "mark": lambda c: F.bit_xor(F.xxhash64(F.col(row_id), c)),
        },
        cols,
    ).collect()
    groups: dict[tuple, list[str]] = {}
    for r in sorted(prints, key=lambda r: r["idx"]):
        groups.setdefault((types[r["var"]], r["nulls"], r["mark"]), []).append(r["var"])
    open_groups = [g for g in groups.values() if len(g) > 1]
    found: list[str] = []
    while open_groups:
        pairs = [(g[0], other) for g in open_groups for other in g[1:]]
        row = df.agg(
            *[
                F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias(f"d{i}")
                for i, (a, b) in enumerate(pairs)
            ]
        ).first()
        unequal = {b for i, (_, b) in enumerate(pairs) if row[f"d{i}"]}
        found += [b for _, b in pairs if b not in unequal]
        open_groups = [
            rest for g in open_groups if len(rest := [c for c in g[1:] if c in unequal]) > 1
        ]
    return [c for c in cols if c in found]


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)).cast("long")
    )
