"""Scores of predictions: AUC, log loss, and summaries of per-group scores."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from strataforge.functions.ordering import rank_sums

# Fixed value: probabilities are clipped this far from 0 and 1.
LOGLOSS_CLIP = 1e-14


def area(out: str = "auc") -> Column:
    """Mann-Whitney AUC from ``n_rows``, ``n_pos`` and ``rank_sum``; NULL when a class is missing."""
    n_pos, n_neg = F.col("n_pos"), F.col("n_rows") - F.col("n_pos")
    return F.try_divide(F.col("rank_sum") - n_pos * (n_pos + 1) / 2, n_pos * n_neg).alias(out)


def auc_by(
    df: DataFrame, label: str, score: str, keys: list[str] | None = None, out: str = "auc"
) -> DataFrame:
    """Mann-Whitney AUC with averaged ties per group; NULL when a class is missing."""
    keys = list(keys or [])
    return rank_sums(df, label, score, keys).select(*keys, area(out))


def auc(df: DataFrame, label: str, score: str) -> DataFrame:
    return auc_by(df, label, score)


def auc_over_folds(
    df: DataFrame, label: str, score: str, fold: str, keys: list[str] | None = None
) -> DataFrame:
    """Mean, sample deviation and mean - 3 sd of the per-fold AUC."""
    keys = list(keys or [])
    per_fold = auc_by(df, label, score, keys + [fold])
    return per_fold.groupBy(*keys).agg(
        F.avg("auc").alias("mean_auc"),
        F.stddev_samp("auc").alias("sd_auc"),
        (F.avg("auc") - 3 * F.stddev_samp("auc")).alias("lower_bound"),
    )


def logloss_term(p: Column, y: Column, clip: float = LOGLOSS_CLIP) -> Column:
    inside = F.least(F.greatest(p, F.lit(clip)), F.lit(1.0 - clip))
    return -F.when(y == 1, F.log(inside)).otherwise(F.log(1 - inside))


def logloss(
    df: DataFrame, label: str, p: str, keys: list[str] | None = None, out: str = "logloss"
) -> DataFrame:
    keys = list(keys or [])
    return df.groupBy(*keys).agg(F.avg(logloss_term(F.col(p), F.col(label))).alias(out))


def aggregate_columns(df: DataFrame, cols: list[str], measure) -> DataFrame:
    """Apply a user aggregate (Column -> Column) to many columns: rows (var, value).

    One aggregation for all columns; the single result row is turned on its side.
    """
    one = df.agg(*[measure(F.col(c)).cast("double").alias(f"_{i}") for i, c in enumerate(cols)])
    pairs = [F.struct(F.lit(c).alias("var"), F.col(f"_{i}").alias("value")) for i, c in enumerate(cols)]
    return one.select(F.inline(F.array(*pairs)))
