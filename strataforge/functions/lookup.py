"""Left lookup joins that stay safe when the table is large or one key is hot."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import AtomicType, BinaryType, StringType

from strataforge.session import cut

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 32 << 20
HOT_SHARE = 1 / 512
SALTS = 1024


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int

    def fits(self, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> bool:
        return self.rows <= rows and self.bytes <= size


def row_bytes(df: DataFrame) -> Column:
    """Approximate size of a row: text at its length, everything else at 16 bytes."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, (StringType, BinaryType))]
    width = F.lit(16 * len(df.columns))
    for t in texts:
        width = width + F.coalesce(F.octet_length(t), F.lit(0))
    return width


def measure(df: DataFrame) -> Size:
    r = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()
    return Size(r["n"], r["b"])


def _matches(df: DataFrame, table: DataFrame, pairs: list[tuple[str, str]], null_safe: set[str]) -> Column:
    each = [
        df[a].eqNullSafe(table[b]) if a in null_safe else df[a] == table[b] for a, b in pairs
    ]
    return reduce(lambda x, y: x & y, each)


def hot_hashes(df: DataFrame, on: list[str], share: float) -> list[int]:
    """Hashes of the keys that hold at least ``share`` of the rows of ``df``, by a sketch of bounded size.

    A key that the sketch misses costs time, not the answer.
    """
    keys = ", ".join(f"`{k}`" for k in on)
    most = max(1, round(1 / share))
    found = df.agg(F.expr(f"approx_top_k(xxhash64({keys}), {most}, {16 * most})").alias("top"), F.count("*").alias("n")).first()
    return [r["item"] for r in found["top"] or [] if r["count"] >= max(2, found["n"] * share)]


def lookup(
    df: DataFrame,
    table: DataFrame,
    on: list[str],
    weight: str | None = None,
    size: Size | None = None,
    limit: Size = Size(BROADCAST_ROWS, BROADCAST_BYTES),
    hot_share: float = HOT_SHARE,
    null_safe: list[str] | None = None,
) -> DataFrame:
    """Attach the value columns of ``table`` (unique on ``on``) to ``df``.

    * Measured size within ``limit``: broadcast, so ``df`` is not moved.
    * Larger: keys that hold at least ``hot_share`` of the rows of ``df``, whether
      the table has them or not -- there are at most 1/hot_share of them -- go by
      broadcast, and the rest by an ordinary shuffle join.  Rows of hot keys, and
      rows with a NULL key, carry a salt so that they do not pile up in one
      shuffle partition.

    In the columns of ``null_safe`` a NULL finds a NULL.  Give ``size`` when the
    table is already written and measured.  ``weight`` names a column of the table
    that is not attached.
    """
    safe = set(null_safe or [])
    values = [c for c in table.columns if c not in on and c != weight]
    if size is None:
        table = cut(table)
        size = measure(table)
    keyed = [F.col(k).alias(f"_t_{k}") for k in on]
    pairs = [(k, f"_t_{k}") for k in on]
    if size.fits(limit.rows, limit.bytes):
        right = F.broadcast(table.select(*keyed, *values))
        return df.join(right, _matches(df, right, pairs, safe), "left").select(*df.columns, *values)

    # Keys of both sides as one type, so that equal keys have equal hashes.
    as_df = [F.col(f"_t_{k}").cast(df.schema[k].dataType) for k in on]
    hashes = hot_hashes(df, on, hot_share) or [0]
    is_hot = lambda cols: F.xxhash64(*cols).isin(hashes)
    marked_df = df.withColumn("_served", is_hot([F.col(k) for k in on]))
    all_rows = table.select(*keyed, *values).withColumn("_served", is_hot(as_df))
    hot = all_rows.where("_served").select(*[t for _, t in pairs], *[F.col(v).alias(f"_hot_{v}") for v in values])
    cold = all_rows.where("not _served").select(
        *[t for _, t in pairs], *[F.col(v).alias(f"_cold_{v}") for v in values], F.lit(0).alias("_zero")
    )
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in on if k not in safe], F.lit(False))
    # The salt is a function of the row, so a retried task salts its rows alike.
    hashed = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    spread = F.pmod(F.xxhash64(*hashed), F.lit(SALTS).cast("long")).cast("int") + 1
    marked = (
        marked_df.join(F.broadcast(hot), _matches(marked_df, hot, pairs, safe), "left")
        .withColumn("_salt", F.when(F.col("_served") | missing, spread).otherwise(F.lit(0)))
        .drop(*[t for _, t in pairs])
    )
    return marked.join(cold, _matches(marked, cold, [*pairs, ("_salt", "_zero")], safe), "left").select(
        *df.columns, *[F.coalesce(f"_hot_{v}", f"_cold_{v}").alias(v) for v in values]
    )
