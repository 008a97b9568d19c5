"""Folds, leakage-free response rates and their AUC, end to end."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataforge.functions.metrics import auc_by
from strataforge.operators.response_rate import encode_response_rate
from strataforge.operators.split import k_folds
from strataforge.plans import fixtures as fx
from strataforge.session import cut


def fold_encode_and_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(encoding, split, auc) of two encoded columns on train (out of fold) and test rows."""
    rows = fx.base(spark, sf_dir).drop("fold10")
    rows = rows.select("id", "y", "split", "prio", "lvl")
    # The fold table is written once; every later step reads the same folds.
    rows = cut(k_folds(rows, "id", 10, "fold10", ["y"], "fold10"))
    rated = encode_response_rate(
        rows, ["prio", "lvl"], "y", "fold10", 10,
        F.col("split") == "train",
    )
    cells = [F.struct(F.lit(c).alias("encoding"), F.col(c + "dmp").alias("rate")) for c in ("prio", "lvl")]
    long = rated.select("split", "y", F.inline(F.array(*cells)))
    # Equal rates may differ in the last bit after summing in another order.
    long = long.withColumn("rate", F.round("rate", 9))
    return auc_by(long, "y", "rate", ["encoding", "split"])
