"""Choosing, renaming, deriving and cleaning columns.

All functions build one projection; none of them loops over ``withColumn``.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """An empty list leaves the table as it is."""
    return df.drop(*names)


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def select_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*present(df, names))


def columns_of_kind(df: DataFrame, kind: str) -> list[str]:
    """``kind``: numeric or text."""
    wanted = {"numeric": T.NumericType, "text": T.StringType}[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, wanted)]


def columns_like(df: DataFrame, contains: str, without: str | None = None) -> list[str]:
    """Names matching a pattern, optionally leaving out a second one."""
    return [
        c
        for c in df.columns
        if re.search(contains, c) and not (without and re.search(without, c))
    ]


def rename_columns(df: DataFrame, how, names: Iterable[str] | None = None) -> DataFrame:
    """Rename with a function; two columns ending up alike is an error."""
    chosen = set(df.columns if names is None else names)
    new = [how(c) if c in chosen else c for c in df.columns]
    twice = sorted({n for n in new if new.count(n) > 1})
    if twice:
        raise ValueError(f"renaming makes these names ambiguous: {twice}")
    return df.toDF(*new)


def strip_text(df: DataFrame, text: str, names: Iterable[str] | None = None) -> DataFrame:
    return rename_columns(df, lambda c: c.replace(text, ""), names)


def with_all(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """Add or replace columns in one projection."""
    kept = [new[c].alias(c) if c in new else F.col(c) for c in df.columns]
    return df.select(*kept, *[e.alias(n) for n, e in new.items() if n not in df.columns])


def scaled(df: DataFrame, name: str, divisor: float) -> DataFrame:
    return with_all(df, {name: F.col(name) / F.lit(float(divisor))})


def pair_name(kind: str, later: str, earlier: str, strip: str = "") -> str:
    """Name of a derived pair column: kind, then the earlier and the later name."""
    name = f"{kind}{earlier}{later}"
    return name.replace(strip, "") if strip else name


def pair_columns(
    df: DataFrame, pairs: Iterable[tuple[str, str]], kinds=("sum", "diff"), strip: str = ""
) -> DataFrame:
    """Sum and difference columns for (later, earlier) column pairs."""
    new: dict[str, Column] = {}
    for later, earlier in pairs:
        if "sum" in kinds:
            new[pair_name("sum", later, earlier, strip)] = F.col(later) + F.col(earlier)
        if "diff" in kinds:
            new[pair_name("diff", later, earlier, strip)] = F.col(later) - F.col(earlier)
    return with_all(df, new)


def ratio(top: Column, bottom: Column) -> Column:
    """NULL where the denominator is zero."""
    return F.try_divide(top, bottom)


def flag_equal(a: Column, b) -> Column:
    return (a == b).cast("int")


def flag_both(a: Column, b: Column) -> Column:
    return a * b


def casted(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return with_all(df, {c: F.col(c).cast(t) for c, t in types.items()})


def signed_label(y: Column) -> Column:
    """0/1 to -1/+1."""
    return (2 * y - 1).cast("int")


def fill_nulls(df: DataFrame, value: float, names: Iterable[str] | None = None) -> DataFrame:
    names = columns_of_kind(df, "numeric") if names is None else list(names)
    return df.fillna(value, subset=names) if names else df


def blank_to(c: Column, label: str = "mis", blanks: Iterable[str] = ("",)) -> Column:
    """NULL and the given blank spellings become ``label``."""
    return F.when(c.isNull() | c.isin(*blanks), F.lit(label)).otherwise(c)


def recode_blanks(
    df: DataFrame, names: Iterable[str], label: str = "mis", blanks: Iterable[str] = ("",)
) -> DataFrame:
    return with_all(df, {c: blank_to(F.col(c), label, blanks) for c in present(df, names)})


def one_hot(df: DataFrame, name: str, classes: Iterable, prefix: str | None = None) -> DataFrame:
    prefix = f"{name}_" if prefix is None else prefix
    return with_all(df, {f"{prefix}{k}": (F.col(name) == F.lit(k)).cast("int") for k in classes})


def where_valid(df: DataFrame, folds: DataFrame, id_col: str, valid: bool = True) -> DataFrame:
    """Rows flagged as holdout in the fold table, or the others."""
    flags = folds.select(id_col, "valid").where(F.col("valid") == (1 if valid else 0))
    return df.join(flags, id_col, "left_semi")


def where_fold(df: DataFrame, fold: str, k: int, inside: bool = True) -> DataFrame:
    return df.where(F.col(fold) == k if inside else F.col(fold) != k)


def where_beyond(df: DataFrame, name: str, bound: float, absolute: bool = False) -> DataFrame:
    c = F.abs(F.col(name)) if absolute else F.col(name)
    return df.where(c > bound)
