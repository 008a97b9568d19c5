"""Dates given as ddMONyy text and their per-row summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strataforge.operators.columns import drop_columns, present

# Fixed value: two-digit years from this one on belong to the 1900s.
PIVOT_YEAR = 2069


def parse_ddmonyy(text: Column) -> Column:
    """Date from the first seven characters; NULL for blank or unreadable text."""
    day = F.try_to_date(F.substring(text, 1, 7), "ddMMMyy")
    return F.when(F.year(day) >= PIVOT_YEAR, F.add_months(day, -1200)).otherwise(day)


def year_text(text: Column) -> Column:
    """Characters 6-7: the two-digit year as text."""
    return F.substring(text, 6, 2)


def date_summary(df: DataFrame, names: list[str]) -> DataFrame:
    """Counts, first and last year, span in days and years across date columns of a row.

    All zero when the row has no date.  One array per row, no row loop.
    """
    names = present(df, names)
    days = F.array_compact(F.array(*[parse_ddmonyy(F.col(c)) for c in names]))
    first, last = F.array_min("_days"), F.array_max("_days")
    some = F.size("_days") > 0

    def or_zero(c: Column) -> Column:
        return F.when(some, c).otherwise(F.lit(0)).cast("int")

    return (
        df.withColumn("_days", days)
        .select(
            *df.columns,
            F.size("_days").alias("nof_dates"),
            F.size(F.array_distinct("_days")).alias("nof_unique_dates"),
            or_zero(F.year(first)).alias("initial_year"),
            or_zero(F.year(last)).alias("last_year"),
            or_zero(F.datediff(last, first)).alias("duration_contact"),
            or_zero(F.year(last) - F.year(first)).alias("nof_years"),
        )
    )


def drop_date_columns(df: DataFrame, names: list[str]) -> DataFrame:
    """The raw texts and the last year go once the summary exists."""
    return drop_columns(df, [*present(df, names), "last_year"])


def run_date() -> Column:
    return F.date_format(F.current_date(), "yyyyMMdd")
