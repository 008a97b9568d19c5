"""Hash every column of a table, learn online, score a second table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from strataforge.operators.ftrl import FtrlParams, score_rows
from strataforge.operators.hashed import DEFAULT_SLOTS, hash_features
from strataforge.operators.local_ftrl import PART_ROWS, SYNCS, train_in_parts


def hashed_rows(
    df: DataFrame, features: list[str], row_id: str = "id", label: str | None = "y",
    size: int = DEFAULT_SLOTS, method: str = "xxhash64",
) -> DataFrame:
    """(id, indices, y): the row generator as a DataFrame transform; y is 0 where absent."""
    y = F.coalesce(F.col(label).cast("double"), F.lit(0.0)) if label else F.lit(0.0)
    hashed = hash_features(df.select(*dict.fromkeys([row_id, *features, *([label] if label else [])])), features, size, method)
    return hashed.select(row_id, "indices", y.alias("y"))


def learn_and_score(
    train_df: DataFrame, test_df: DataFrame, features: list[str], row_id: str = "id",
    label: str = "y", params: FtrlParams = FtrlParams(), epochs: int = 2, syncs: int = SYNCS, part_rows: int = PART_ROWS,
    size: int = DEFAULT_SLOTS,
) -> DataFrame:
    """(id, target) for the test rows.  Their label is unknown, so no loss is taken."""
    model, _ = train_in_parts(hashed_rows(train_df, features, row_id, label, size), params, epochs, syncs, part_rows, row_id)
    scored = score_rows(hashed_rows(test_df, features, row_id, None, size), model, row_id)
    return scored.select(row_id, F.col("p").alias("target"))
