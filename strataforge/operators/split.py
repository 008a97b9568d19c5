"""Folds, holdouts and repeated samples, fixed by a keyed hash of the row id.

Row order, partitioning and engine do not matter: the same id always lands in
the same place, and sizes are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strataforge.functions.hashing import HASH_SPACE, md5_bucket
from strataforge.functions.lookup import lookup
from strataforge.functions.ordering import hashed_positions, positions
from strataforge.session import cut


def _others(df: DataFrame, *new: str) -> list[str]:
    return [c for c in df.columns if c not in new]


def shuffled(
    df: DataFrame, row_id: str, tag: str, keys: list[str] | None = None, out: str = "position"
) -> DataFrame:
    """Position of each row in a reproducible shuffle, per group."""
    return hashed_positions(
        df, md5_bucket(tag, F.col(row_id)), HASH_SPACE, [row_id], keys, out
    )


CELLS = 1 << 10  # cells of the hash space that are counted to find a limit: few, as every task counts them for every group


def _first(df: DataFrame, row_id: str, hashed: Column, keys: list[str], wanted, out: str) -> DataFrame:
    """Flag the first ``wanted(rows of the group)`` rows of each group in the order of a hash, then of the id.

    Rows are neither moved nor sorted.  Counts per cell of the hash space tell in which
    cell a group's limit lies; only the rows of that cell are ordered, and their
    ``wanted``-th is the limit that every row is compared with.  The limits have one
    row per group.
    """
    group = keys or ["_all"]
    rows = df if keys else df.withColumn("_all", F.lit(0))
    narrow = rows.select(*group, hashed.alias("_h"), F.col(row_id).alias("_id"))
    top = F.floor(F.col("_h") * CELLS / HASH_SPACE)
    cells = cut(narrow.groupBy(*group, top.alias("_top")).agg(F.count("*").alias("_n")))
    upto = Window.partitionBy(*group).orderBy("_top")
    counted = cells.withColumn("_upto", F.sum("_n").over(upto)).withColumn("_total", F.sum("_n").over(Window.partitionBy(*group)))
    goal = F.least(wanted(F.col("_total")).cast("long"), F.col("_total"))
    before = F.col("_upto") - F.col("_n")
    at = counted.where((before < goal) & (goal <= F.col("_upto"))).select(*group, F.col("_top").alias("_cut"), (goal - before).alias("_left"))
    near = lookup(narrow, at, group, null_safe=group).where(top == F.col("_cut"))
    place = F.row_number().over(Window.partitionBy(*group).orderBy("_h", "_id"))
    limits = near.withColumn("_place", place).where("_place = _left").select(*group, F.struct("_h", "_id").alias("_limit"))
    marked = lookup(rows, limits, group, null_safe=group)
    inside = F.struct(hashed.alias("_h"), F.col(row_id).alias("_id")) <= F.col("_limit")
    return marked.select(*_others(df, out), F.coalesce(inside, F.lit(False)).cast("int").alias(out))


def k_folds(
    df: DataFrame, row_id: str, k: int, tag: str = "fold", strata: list[str] | None = None,
    out: str = "fold",
) -> DataFrame:
    """1-based fold; sizes differ by at most one inside each stratum."""
    placed = shuffled(df, row_id, tag, strata, "_p")
    return placed.select(*_others(df, out), ((F.col("_p") - 1) % k + 1).cast("int").alias(out))


def holdout(df: DataFrame, row_id: str, n: int, tag: str = "valid", out: str = "valid") -> DataFrame:
    """Flag exactly ``n`` rows (all of them when there are fewer)."""
    return _first(df, row_id, md5_bucket(tag, F.col(row_id)), [], lambda total: F.lit(n), out)


def fold_table(
    df: DataFrame, row_id: str, holdout_rows: int, strata: list[str] | None = None
) -> DataFrame:
    """(id, fold5, fold10, valid): the split every later step shares.

    Each split reads its input twice (slice counts, then rows), so the narrow
    table is written between the splits instead of being worked out 2^3 times.
    """
    narrow = cut(df.select(*dict.fromkeys([row_id, *(strata or [])])))
    out = cut(k_folds(narrow, row_id, 5, "fold5", strata, "fold5"))
    out = cut(k_folds(out, row_id, 10, "fold10", strata, "fold10"))
    return holdout(out, row_id, holdout_rows).select(row_id, "fold5", "fold10", "valid")


def repeated_samples(
    df: DataFrame, row_id: str, times: int, share: float, strata: list[str] | None = None,
    tag: str = "rep",
) -> DataFrame:
    """Rows x repeats with ``inside`` = 1 for a share of every stratum in every repeat.

    The repeat is part of the hash, so each repeat is its own shuffle.
    """
    # Small tables come in few partitions; their rows are dealt before they become many.
    session = df.sparkSession
    tasks = max(2 * session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    reps = df.repartition(tasks).withColumn("rep", F.explode(F.sequence(F.lit(1), F.lit(times))))
    hashed = md5_bucket(tag, F.col("rep"), F.lit("_"), F.col(row_id))
    marked = _first(
        reps, row_id, hashed, ["rep", *(strata or [])], lambda total: F.ceil(F.round(total * F.lit(share), 6)), "inside"
    )
    return marked.select(*_others(df, "rep", "inside"), "rep", "inside")


def with_samples(
    df: DataFrame, row_id: str, times: int, share: float, strata: list[str] | None = None,
    tag: str = "rep",
) -> DataFrame:
    """``df`` plus ``samples``: the list of repeats each row is in, written once.

    Only ids and strata are repeated; the wide rows are joined and stored a
    single time however many repeats there are.
    """
    narrow = df.select(*dict.fromkeys([row_id, *(strata or [])]))
    picked = repeated_samples(narrow, row_id, times, share, strata, tag).where("inside = 1")
    sets = picked.groupBy(row_id).agg(F.array_sort(F.collect_list("rep")).alias("samples"))
    return cut(df.join(sets, row_id, "left"))


def in_sample(marked: DataFrame, rep: int) -> DataFrame:
    return marked.where(F.array_contains("samples", rep)).drop("samples")


def random_split(df: DataFrame, row_id: str, share: float, seed: int, out: str = "held") -> DataFrame:
    """Plain split: a hash threshold, no shuffle."""
    bar = int(share * HASH_SPACE)
    held = md5_bucket(f"split{seed}_", F.col(row_id)) < F.lit(bar)
    return df.withColumn(out, held.cast("int"))


def contiguous_folds(df: DataFrame, order: list[str], k: int, out: str = "block") -> DataFrame:
    """Unshuffled blocks by row order; the first blocks take the extra rows."""
    numbered = positions(df, order)
    n, p = F.col("group_rows"), F.col("position") - 1
    big = F.floor(n / k) + 1
    extra = n % k
    in_big = F.floor(p / big)
    in_small = extra + F.floor(F.try_divide(p - extra * big, F.floor(n / k)))
    block = F.when(p < extra * big, in_big).otherwise(in_small) + 1
    return numbered.select(*_others(df, out), block.cast("int").alias(out))


def equal_split(df: DataFrame, row_id: str, parts: int, tag: str = "equal", out: str = "part") -> DataFrame:
    """Shuffled blocks whose sizes differ by at most one, the larger ones first; fewer rows than parts leave parts empty."""
    placed = shuffled(df, row_id, tag, None, "_p")
    n, p = F.col("group_rows"), F.col("_p") - 1
    small, extra = F.floor(n / parts), n % parts
    in_larger = F.floor(p / (small + 1))
    block = F.when(p < extra * (small + 1), in_larger).otherwise(extra + F.floor(F.try_divide(p - extra * (small + 1), small))) + 1
    return placed.select(*_others(df, out), block.cast("int").alias(out))


def head_split(
    df: DataFrame, row_id: str, rows: int = 133_000, tag: str = "shuf", out: str = "part"
) -> DataFrame:
    """Shuffle, then train = the first ``rows``, valid = the next ``rows``, rest = what is left."""
    hashed = md5_bucket(tag, F.col(row_id))
    one = _first(df, row_id, hashed, [], lambda total: F.lit(rows), "_one")
    two = _first(one, row_id, hashed, [], lambda total: F.lit(2 * rows), "_two")
    part = F.when(F.col("_one") == 1, "train").when(F.col("_two") == 1, "valid").otherwise("rest")
    return two.select(*_others(df, out), part.alias(out))


def column_bags(df: DataFrame, cols: list[str], times: int, share: float, tag: str = "bag") -> DataFrame:
    """(bag, var) for ``times`` column subsets of one size; sized by the schema."""
    rows = [(i + 1, c) for i, c in enumerate(cols)]
    table = df.sparkSession.createDataFrame(rows, "idx int, var string")
    picked = repeated_samples(table, "idx", times, share, None, tag)
    return picked.where("inside = 1").select(F.col("rep").alias("bag"), "idx", "var")


def every_nth(df: DataFrame, seq: Column, n: int, inside: bool = True) -> DataFrame:
    return df.where(seq % n == 0 if inside else seq % n != 0)
