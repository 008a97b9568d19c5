"""Exact ranks and running totals with no single-task sort.

``Window.orderBy`` over a whole table, or over one hot group, runs in one task.
Here the rows are range-partitioned on (group, order) so that a large group
spreads over many slices; a window runs inside each slice, and a slice-sized
table carries the offsets between slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import AtomicType

from strataforge.functions.lookup import SALTS, Size, lookup
from strataforge.session import cut

SLICE = "_slice"
#: Rows of a slice of ranked rows at least, and slices of a group at most.
SLICE_ROWS, MOST_SLICES = 250_000, 4096
#: Distinct values of all groups that are ranked as a table of their own, and rows per value at least.
VALUE_ROWS, ROWS_A_VALUE = 100_000, 8


def _sliced(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    return df.repartitionByRange(*keys, *order).withColumn(SLICE, F.spark_partition_id())


def _cell(keys: list[str]) -> Column:
    """(group, slice) as one value.

    Grouping, window and join all use this one column, so they share a single
    shuffle; inside a struct a NULL group key equals another NULL.
    """
    return F.struct(*keys, SLICE)


def _offsets(per_slice: DataFrame, keys: list[str], names: list[str]) -> DataFrame:
    """``per_slice``: (_cell, sums).  At most (number of slices) rows per group."""
    group = [F.col(f"_cell.{k}") for k in keys] or [F.lit(0)]
    at = F.col(f"_cell.{SLICE}")
    before = W.partitionBy(*group).orderBy(at).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*group)
    return per_slice.select(
        "_cell",
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"_off_{n}") for n in names],
        *[F.sum(n).over(whole).alias(f"total_{n}") for n in names],
    )


def running_totals(
    df: DataFrame, order: list[str], sums: list[str], keys: list[str] | None = None
) -> DataFrame:
    """Add ``before_<s>`` (sum over earlier rows) and ``total_<s>`` per group.

    ``order`` should be unique inside a group.  The slices are checkpointed
    once, because range bounds come from sampling and both the offsets and the
    rows must see the same slices.
    """
    keys = list(keys or [])
    rows = cut(_sliced(df, keys, order)).withColumn("_cell", _cell(keys))
    per_slice = rows.groupBy("_cell").agg(*[F.sum(s).alias(s) for s in sums])
    offsets = _offsets(per_slice, keys, sums)
    inside = W.partitionBy("_cell").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    local = rows.select(
        "*", *[F.coalesce(F.sum(s).over(inside), F.lit(0)).alias(f"_in_{s}") for s in sums]
    )
    return local.join(offsets, "_cell").select(
        *df.columns,
        *[(F.col(f"_in_{s}") + F.col(f"_off_{s}")).alias(f"before_{s}") for s in sums],
        *[F.col(f"total_{s}") for s in sums],
    )


def positions(
    df: DataFrame, order: list[str], keys: list[str] | None = None, out: str = "position"
) -> DataFrame:
    """1-based row number per group, and the group size as ``group_rows``."""
    one = df.withColumn("_one", F.lit(1).cast("long"))
    return (
        running_totals(one, order, ["_one"], keys)
        .withColumn(out, F.col("before__one") + 1)
        .withColumnRenamed("total__one", "group_rows")
        .drop("_one", "before__one")
    )


def hashed_positions(
    df: DataFrame,
    hashed: Column,
    space: int,
    tie: list[str],
    keys: list[str] | None = None,
    out: str = "position",
) -> DataFrame:
    """Row number per group in the order of a uniform hash, then ``tie``.

    A uniform hash needs no sampling: its top bits are the slice, so the plan
    stays lazy and every retry sees the same slices.  The offset table has
    slices x groups rows.
    """
    keys = list(keys or [])
    slices = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = -(-space // slices)
    rows = df.withColumn("_h", hashed).withColumn(
        SLICE, F.floor(F.col("_h") / F.lit(width)).cast("int")
    )
    rows = rows.withColumn("_cell", _cell(keys))
    counts = rows.groupBy("_cell").agg(F.count("*").alias("n"))
    offsets = _offsets(counts, keys, ["n"])
    inside = W.partitionBy("_cell").orderBy("_h", *tie)
    local = rows.withColumn("_rn", F.row_number().over(inside).cast("long"))
    return local.join(offsets, "_cell").select(
        *df.columns,
        (F.col("_rn") + F.col("_off_n")).alias(out),
        F.col("total_n").alias("group_rows"),
    )


def _cuts(known: DataFrame, sizes: DataFrame, value: str, keys: list[str], slice_rows: int) -> tuple[DataFrame, Size]:
    """(keys, _cuts, _block, _heads): values that cut the groups of more than ``slice_rows`` rows into slices of about that many.

    A value with more rows than a slice is a cut itself, as it holds one of the quantiles.
    """
    most = min(4 * int(known.sparkSession.conf.get("spark.sql.shuffle.partitions")), MOST_SLICES)
    shares = F.array(*[F.lit(i / most) for i in range(1, most)])
    if keys:
        large = sizes.where(F.col("_n") > slice_rows).select(*keys, F.lit(True).alias("_large"))
        known = lookup(known.select(*keys, value), large, keys, null_safe=keys).where("_large")
    found = known.groupBy(*keys).agg(F.percentile_approx(value, shares, 8 * most).alias("_q"), F.count("*").alias("_n"))
    step = F.ceil(F.lit(float(most * slice_rows)) / F.col("_n"))
    every = F.filter("_q", lambda _, i: (i + 1) % step == 0)
    cuts = found.select(*keys, F.array_distinct(every).alias("_cuts"))
    blocks = cuts.withColumn("_block", F.greatest(F.ceil(F.sqrt(F.size("_cuts"))).cast("int"), F.lit(1)))
    table = cut(blocks.withColumn("_heads", F.filter("_cuts", lambda _, i: i % F.col("_block") == 0)))
    many = table.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("_cuts")), F.lit(0)).alias("cuts")).first()
    return table, Size(many["rows"], 16 * (len(keys) + 2) * many["rows"] + 16 * many["cuts"])


def _slice_of(value: Column) -> Column:
    """2 x (cuts below the value), one more where the value is a cut: a search among the heads of blocks of cuts, then in one block."""
    below = lambda xs: F.size(F.filter(xs, lambda b: b < value))
    at = F.greatest(below(F.col("_heads")) - 1, F.lit(0)) * F.col("_block")
    before = at + below(F.slice("_cuts", at + 1, F.col("_block")))
    return 2 * before + F.get("_cuts", before).eqNullSafe(value).cast("int")


def average_rank(
    df: DataFrame,
    value: str,
    keys: list[str] | None = None,
    out: str = "rank",
    percentile: bool = False,
    descending: bool = False,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Tie-averaged rank of a numeric ``value`` per group, or rank/n; NULL stays NULL.

    Quantiles cut groups of more than ``slice_rows`` rows into slices; counts per slice, a small table, give the
    offsets, and a window inside the slice gives the rest, so the rows move once and
    meet no table of their own size.  A value with more rows than a slice is a slice
    by itself, whose rank follows from its count alone: its rows are spread by a salt.
    Where few values have many rows each, ranks follow from the counts of all values,
    and no row moves.
    """
    keys = list(keys or [])
    missing = F.col(value).isNull()
    known = df.where(~missing)
    sizes = cut(known.groupBy(*keys).agg(F.count("*").alias("_n"), F.approx_count_distinct(value).alias("_values")))
    whole = sizes.agg(F.max("_n").alias("most"), F.sum("_n").alias("rows"), F.sum("_values").alias("values")).first()
    if whole["values"] and whole["values"] <= min(VALUE_ROWS, whole["rows"] / ROWS_A_VALUE):
        return _ranks_of_values(df, known, value, keys, out, percentile, descending)
    if (whole["most"] or 0) <= slice_rows:
        rows = df.withColumn(SLICE, F.when(missing, -1).otherwise(0))
        offsets = sizes.select(*keys, F.lit(0).alias(SLICE), "_n", F.lit(0).cast("long").alias("_off"), F.col("_n").alias("_total"))
    else:
        table, size = _cuts(known, sizes, value, keys, slice_rows)
        if keys:
            rows = lookup(df, table, keys, size=size, null_safe=keys)
        else:
            one = table.first()
            rows = df.select("*", *[F.lit(one[c]).cast(table.schema[c].dataType).alias(c) for c in ("_cuts", "_block", "_heads")])
        place = F.coalesce(F.when(F.col("_cuts").isNotNull(), _slice_of(F.col(value))), F.lit(0))
        rows = rows.select(*df.columns, F.when(missing, -1).otherwise(place).alias(SLICE))
        cells = rows.groupBy(*keys, SLICE).agg(F.count("*").alias("_n")).where(F.col(SLICE) >= 0)
        group = [F.col(k) for k in keys] or [F.lit(0)]
        before = W.partitionBy(*group).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
        offsets = cells.select(
            *keys, SLICE, "_n", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"), F.sum("_n").over(W.partitionBy(*group)).alias("_total")
        )
    rows = lookup(rows, offsets, [*keys, SLICE], null_safe=keys)
    hashed = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    alone = missing | (F.col(SLICE) % 2 == 1)
    spread = F.when(alone, F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in hashed]), F.lit(SALTS))).otherwise(F.lit(0))
    inside = W.partitionBy(*keys, SLICE, "_salt").orderBy(value)
    peers = F.count("*").over(inside.rangeBetween(W.currentRow, W.currentRow))
    local = F.when(alone, (F.col("_n") + 1) / 2).otherwise(F.rank().over(inside) + (peers - 1) / 2)
    rank = F.col("_off") + local
    if descending:
        rank = F.col("_total") + 1 - rank
    if percentile:
        rank = rank / F.col("_total")
    kept = [F.col(f"`{c}`") for c in df.columns if c != out]
    return rows.withColumn("_salt", spread).select(*kept, F.when(~missing, rank).alias(out))


def _ranks_of_values(
    df: DataFrame, known: DataFrame, value: str, keys: list[str], out: str, percentile: bool, descending: bool
) -> DataFrame:
    """``average_rank`` from a table of the distinct values of every group, which the rows look up."""
    counts = known.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    group = [F.col(k) for k in keys] or [F.lit(0)]
    before = W.partitionBy(*group).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    total = F.sum("_n").over(W.partitionBy(*group))
    rank = F.coalesce(F.sum("_n").over(before), F.lit(0)) + (F.col("_n") + 1) / 2
    if descending:
        rank = total + 1 - rank
    if percentile:
        rank = rank / total
    kept = [c for c in df.columns if c != out]
    found = lookup(df, counts.select(*keys, value, rank.alias("_rank")), [*keys, value], null_safe=[*keys, value])
    return found.select(*[F.col(f"`{c}`") for c in kept], F.col("_rank").alias(out))


def rank_sums(df: DataFrame, label: str, value: str, keys: list[str] | None = None) -> DataFrame:
    """Per group: rows, positives and the rank sum of the positives.

    A straight chain with no second reader, so it needs no checkpoint: offsets
    are added to the slice totals rather than joined to the rows.
    """
    keys = list(keys or [])
    cells = (
        df.where(F.col(value).isNotNull() & F.col(label).isNotNull())
        .groupBy(*keys, value)
        .agg(F.count("*").alias("n"), F.sum(F.col(label).cast("double")).alias("pos"))
    )
    rows = _sliced(cells, keys, [value])
    inside = (
        W.partitionBy(*keys, SLICE).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
    )
    mean_rank = F.col("_before") + (F.col("n") + 1) / 2
    per_slice = (
        rows.withColumn("_before", F.coalesce(F.sum("n").over(inside), F.lit(0)))
        .groupBy(*keys, SLICE)
        .agg(
            F.sum(F.col("pos") * mean_rank).alias("_local"),
            F.sum("n").alias("n"),
            F.sum("pos").alias("pos"),
        )
    )
    return summed_slices(per_slice, keys)


def summed_slices(per_slice: DataFrame, keys: list[str]) -> DataFrame:
    """Rank sums of groups from those of their slices: (keys, slice, n, pos, _local), where ``_local`` counts ranks inside the slice."""
    group = [F.col(k) for k in keys] or [F.lit(0)]
    before = W.partitionBy(*group).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    return (
        per_slice.withColumn("_off", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("n_rows"),
            F.sum("pos").alias("n_pos"),
            F.sum(F.col("_local") + F.col("_off") * F.col("pos")).alias("rank_sum"),
        )
    )
