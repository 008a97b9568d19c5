"""Vectors as whole numbers: exact floors of scaled components, and their bytes."""

from __future__ import annotations

import json
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F

#: The range of a long; larger results are given as its ends.
LONG_MIN, LONG_MAX = -(1 << 63), (1 << 63) - 1


def sound(vector: Column) -> Column:
    """Whether a vector and all its components are there and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def floors(values: np.ndarray, scale: int) -> np.ndarray:
    """``floor(scale * x)`` of finite doubles, for a scale that is a power of two.

    The product is exact then, so the floor is too.  Long integers, or Python's own
    where a number is too large for squares and sums of them.
    """
    with np.errstate(over="ignore"):
        scaled = np.floor(values * float(scale))
    if np.abs(scaled).max(initial=0.0) < limit(values.shape[1]):
        return scaled.astype(np.int64)
    exact = [math.floor(x) if abs(x) < 2**52 else int(v) * scale for v, x in zip(values.ravel().tolist(), scaled.ravel().tolist())]
    return np.array(exact, dtype=object).reshape(values.shape)


def limit(width: int) -> int:
    """Components below this can be squared and summed over ``width`` of them in long integers."""
    return math.isqrt((1 << 58) // max(1, width))


def pack(numbers: np.ndarray) -> bytes:
    """The numbers of an array in a row, in as few bytes as their range allows."""
    if numbers.dtype == object:
        return b"j" + json.dumps([int(x) for x in numbers.ravel()]).encode()
    top = int(np.abs(numbers).max(initial=0))
    kind, code = (np.int16, b"2") if top < 1 << 15 else (np.int32, b"4") if top < 1 << 31 else (np.int64, b"8")
    return code + np.ascontiguousarray(numbers, dtype=kind).tobytes()


def unpack(data: bytes, width: int | None = None) -> np.ndarray:
    """What ``pack`` packed, as rows of ``width`` where that is given."""
    if data[:1] == b"j":
        flat = np.array(json.loads(data[1:]), dtype=object)
    else:
        flat = np.frombuffer(data, dtype=f"i{data[:1].decode()}", offset=1).astype(np.int64)
    return flat if width is None else flat.reshape(-1, width)


def matrices(column: pa.Array) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """The vectors of a column of lists by length: (length, rows, matrix of doubles)."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    out = []
    for d in np.unique(sizes):
        rows = np.flatnonzero(sizes == d)
        part = column if len(rows) == len(sizes) else column.take(pa.array(rows))
        flat = part.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        out.append((int(d), rows, flat.reshape(len(rows), int(d))))
    return out


def within_long(number: int) -> int:
    return max(LONG_MIN, min(LONG_MAX, int(number)))
