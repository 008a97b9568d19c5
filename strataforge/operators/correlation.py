"""Correlated column pairs and what their sums and differences are worth."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, functions as F

from strataforge.functions.long import melted
from strataforge.functions.metrics import auc_over_folds
from strataforge.operators.columns import pair_columns, pair_name
from strataforge.operators.profile import constant_columns

PAIR_SCHEMA = "ref_idx int, dep_idx int, ref_name string, dep_name string, corr_value double"


def correlation_matrix(df: DataFrame, cols: list[str]) -> np.ndarray:
    """Pearson matrix of NULL-free columns.

    One distributed pass of summed outer products; only the (columns x columns)
    result reaches the driver, whatever the number of rows.
    """
    vectors = VectorAssembler(inputCols=cols, outputCol="_x").transform(df).select("_x")
    return Correlation.corr(vectors, "_x").first()[0].toArray()


def correlation_table(df: DataFrame, cols: list[str]) -> DataFrame:
    """All pairs (later, earlier) with their correlation; constants give NULL."""
    return _pairs(df, cols, None)


def correlated_pairs(df: DataFrame, cols: list[str], threshold: float = 0.95) -> DataFrame:
    """Pairs with |r| above the threshold, the later column as ``ref``."""
    return _pairs(df, cols, threshold)


def _pairs(df: DataFrame, cols: list[str], threshold: float | None) -> DataFrame:
    # A constant column has no correlation.
    flat = set(constant_columns(df, cols))
    matrix = correlation_matrix(df, cols)
    rows = []
    for i in range(len(cols)):
        for j in range(i):
            r = matrix[i, j]
            r = None if np.isnan(r) or {cols[i], cols[j]} & flat else float(r)
            if threshold is None or (r is not None and abs(r) > threshold):
                rows.append((i + 1, j + 1, cols[i], cols[j], r))
    return df.sparkSession.createDataFrame(rows, PAIR_SCHEMA)


def columns_to_drop(pairs: DataFrame, threshold: float = 0.95, signed: bool = False) -> list[str]:
    """The later column of every pair beyond the threshold."""
    r = F.col("corr_value") if signed else F.abs("corr_value")
    hits = pairs.where(r > threshold).select("ref_idx", "ref_name").distinct().orderBy("ref_idx")
    return [h["ref_name"] for h in hits.collect()]


def pair_information(
    df: DataFrame, pairs: DataFrame, label: str, fold: str, strip: str = ""
) -> DataFrame:
    """For each pair: mean - 3 sd over folds of the AUC of its sum and of its difference.

    All derived columns of all pairs are scored in one grouped job.
    """
    listed = [(p["ref_name"], p["dep_name"]) for p in pairs.collect()]
    if not listed:
        return df.sparkSession.createDataFrame(
            [], "ref_name string, dep_name string, xsum double, xdiff double"
        )
    names = {
        (kind, ref, dep): pair_name(kind, ref, dep, strip)
        for ref, dep in listed
        for kind in ("sum", "diff")
    }
    wide = pair_columns(df.select(label, fold, *{c for p in listed for c in p}), listed, strip=strip)
    long = melted(wide, list(names.values()), [label, fold])
    scores = auc_over_folds(long, label, "value", fold, ["var"])
    rows = [(ref, dep, names["sum", ref, dep], names["diff", ref, dep]) for ref, dep in listed]
    keyed = df.sparkSession.createDataFrame(
        rows, "ref_name string, dep_name string, _sum string, _diff string"
    )
    plus = scores.select(F.col("var").alias("_sum"), F.col("lower_bound").alias("xsum"))
    minus = scores.select(F.col("var").alias("_diff"), F.col("lower_bound").alias("xdiff"))
    return keyed.join(plus, "_sum", "left").join(minus, "_diff", "left").select(
        "ref_name", "dep_name", "xsum", "xdiff"
    )


def add_informative_pairs(
    df: DataFrame, information: DataFrame, threshold: float = 0.53, strip: str = ""
) -> DataFrame:
    """Attach the sums and differences whose score is above the threshold."""
    rows = information.orderBy("ref_name", "dep_name").collect()
    sums = [(r["ref_name"], r["dep_name"]) for r in rows if (r["xsum"] or 0) > threshold]
    diffs = [(r["ref_name"], r["dep_name"]) for r in rows if (r["xdiff"] or 0) > threshold]
    return pair_columns(pair_columns(df, sums, ("sum",), strip), diffs, ("diff",), strip)
