"""Columns that are linear combinations of earlier columns.

The rows are reduced to the triangular factor R of the table: each task keeps
only a (columns x columns) factor of the batches it has seen, and factors are
merged in groups of bounded size.  R has the same linear dependencies among its
columns as the table, without squaring the condition number the way a Gram
matrix would.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from strataforge.functions.matrices import PART_SCHEMA, tree_merge


def triangular_factor(df: DataFrame, cols: list[str]) -> np.ndarray:
    """R of the table's columns; the columns must be free of NULLs (fill first)."""
    width = len(cols)
    data = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(cols)])

    def local(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        factor = np.zeros((0, width))
        for batch in batches:
            if len(batch):
                rows = batch.to_numpy(dtype=np.float64)
                factor = np.linalg.qr(np.vstack([factor, rows]), mode="r")
        if len(factor):
            part = TaskContext.get().partitionId()
            yield pd.DataFrame({"part": [part], "g": [0], "m": [factor.tobytes()]})

    def merge(factors: list[bytes]) -> bytes:
        stacked = np.vstack([np.frombuffer(f).reshape(-1, width) for f in factors])
        return np.linalg.qr(stacked, mode="r").tobytes()

    found = tree_merge(data.mapInPandas(local, PART_SCHEMA), merge)
    return np.frombuffer(found[0]).reshape(-1, width) if found else np.zeros((0, width))


def dependent_indices(factor: np.ndarray, tolerance: float = 1e-7) -> list[int]:
    """Columns whose part outside the kept earlier columns is negligible.

    Dropped columns do not join the basis, so their noise cannot mask others.
    """
    basis: list[np.ndarray] = []
    dropped = []
    for j in range(factor.shape[1]):
        column = factor[:, j]
        size = np.linalg.norm(column)
        rest = column.copy()
        for _ in range(2):
            if basis:
                q = np.array(basis)
                rest = rest - q.T @ (q @ rest)
        if size == 0 or np.linalg.norm(rest) < tolerance * size:
            dropped.append(j)
        else:
            basis.append(rest / np.linalg.norm(rest))
    return dropped


def linear_combinations(
    df: DataFrame, cols: list[str], tolerance: float = 1e-7
) -> list[str]:
    return [cols[j] for j in dependent_indices(triangular_factor(df, cols), tolerance)]


def windowed_linear_combinations(
    df: DataFrame, cols: list[str], widths: Iterable[int] = (101, 501), step: int = 100,
    tolerance: float = 1e-7,
) -> list[str]:
    """The same inside sliding column windows, a pass per width over what is left.

    A window of columns of R has the dependencies of that window of the table,
    so all windows share one distributed pass.
    """
    factor = triangular_factor(df, cols)
    kept = list(range(len(cols)))
    dropped: list[int] = []
    for width in widths:
        gone: set[int] = set()
        for start in range(0, len(kept), step):
            window = kept[start : start + width]
            gone |= {window[j] for j in dependent_indices(factor[:, window], tolerance)}
        dropped += sorted(gone)
        kept = [j for j in kept if j not in gone]
    return [cols[j] for j in sorted(dropped)]


def combinations_of_codes(
    df: DataFrame, coded_cols: list[str], tolerance: float = 1e-7
) -> list[str]:
    """Dependent columns among integer-coded factors."""
    return linear_combinations(df, coded_cols, tolerance)
