"""Keyed hashes that every engine computes alike."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_SPACE = 1 << 32


def md5_bucket(tag: str, *parts: Column) -> Column:
    """First 32 bits of md5(tag || parts) as a long: portable and partition-free."""
    text = F.concat(F.lit(tag), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def feature_slot(name: str, value: Column, size: int, method: str = "xxhash64") -> Column:
    """Slot of ``name_value`` in 1..size-1.  Slot 0 stays free for the intercept."""
    text = F.concat(F.lit(name + "_"), F.coalesce(value.cast("string"), F.lit("")))
    if method == "md5":
        raw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")
    elif method == "xxhash64":
        raw = F.xxhash64(text)
    else:
        raise ValueError(f"unknown hash method {method!r}")
    return F.pmod(raw, F.lit(size - 1).cast("long")) + F.lit(1).cast("long")
