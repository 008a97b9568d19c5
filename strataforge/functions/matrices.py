"""Merging many task-sized matrices without piling them up in one task."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from strataforge.session import cut

FAN_IN = 16
PART_SCHEMA = "part int, g int, m binary"


def tree_merge(
    parts: DataFrame, merge: Callable[[list[bytes]], bytes], fan_in: int = FAN_IN
) -> dict[int, bytes]:
    """Merge the matrices of each group ``g`` by rounds of at most ``fan_in``.

    ``parts`` has one row per (task, group).  Only the last matrix of each group
    reaches the driver; its size is set by the columns, not the rows.
    ``merge`` should be a local function, so that workers need no copy of this
    package.
    """

    def step(group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("part")
        return pd.DataFrame(
            {
                "part": [int(ordered["part"].iloc[0]) // fan_in],
                "g": [int(ordered["g"].iloc[0])],
                "m": [merge(list(ordered["m"]))],
            }
        )

    parts = cut(parts)
    top = parts.agg(F.max("part")).first()[0]
    while top:
        parts = parts.groupBy("g", F.floor(F.col("part") / fan_in).alias("_b")).applyInPandas(
            step, PART_SCHEMA
        )
        top //= fan_in
    return {r["g"]: bytes(r["m"]) for r in parts.collect()}
