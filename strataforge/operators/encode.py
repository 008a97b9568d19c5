"""Level tables and encodings of categorical columns.

Statistics of all columns come from one pass: each row contributes one
(var, level) cell per column, combined on the map side, so a level that fills a
third of the table still reaches the shuffle as one row per task.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from strataforge.functions.lookup import BROADCAST_BYTES, BROADCAST_ROWS, Size, lookup, row_bytes
from strataforge.functions.long import melted
from strataforge.functions.ordering import positions
from strataforge.operators.columns import blank_to, with_all
from strataforge.session import cut


def level_cells(df: DataFrame, cols: list[str], keep: list[str] | None = None) -> DataFrame:
    """One row per (row, column): var, level as text, and the kept columns."""
    return melted(df, cols, keep, "string", value="level")


def level_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(var, level, n); NULL levels are not counted."""
    return (
        level_cells(df, cols)
        .where(F.col("level").isNotNull())
        .groupBy("var", "level")
        .agg(F.count("*").alias("n"))
    )


def attach_by_level(
    df: DataFrame,
    table: DataFrame,
    cols: list[str],
    value: str,
    name,
    on_extra: list[str] | None = None,
    weight: str = "n",
    row_id: str | None = None,
    limit: Size = Size(BROADCAST_ROWS, BROADCAST_BYTES),
) -> DataFrame:
    """Look up ``value`` of (var, level) for each column; ``name(c)`` names the result.

    ``table`` is written once and measured per column in one job.  The columns with
    the smallest level tables are broadcast, as many as ``limit`` holds together,
    all without moving ``df``.  The others would each shuffle the wide table; given
    a ``row_id``, they are instead looked up together as narrow (id, var, level)
    rows, with one join, one regrouping by id, and one join back.
    """
    extra = on_extra or []
    table = cut(table)
    measured = table.groupBy("var").agg(
        F.count("*").alias("n"), F.sum(row_bytes(table)).alias("b")
    )
    sizes = {r["var"]: Size(r["n"], r["b"]) for r in measured.collect()}
    none = Size(0, 0)
    small, rows, size = set(), 0, 0
    for c in sorted(cols, key=lambda c: (sizes.get(c, none).bytes, sizes.get(c, none).rows)):
        rows, size = rows + sizes.get(c, none).rows, size + sizes.get(c, none).bytes
        if Size(rows, size).fits(limit.rows, limit.bytes):
            small.add(c)
    large = [c for c in cols if c not in small]
    together = large if row_id is not None and len(large) > 1 else []
    out = df
    for c in cols:
        if c in together:
            continue
        mine = table.where(F.col("var") == c).select(
            F.col("level").alias("_level"), *extra, F.col(value).alias(name(c)),
            F.col(weight).alias("_weight"),
        )
        keyed = out.withColumn("_level", F.col(c).cast("string"))
        own = limit if c in small else Size(-1, -1)
        found = lookup(keyed, mine, ["_level", *extra], "_weight", sizes.get(c, none), own)
        out = found.drop("_level")
    if together:
        long = level_cells(df, together, [row_id, *extra])
        values = table.where(F.col("var").isin(together)).select(
            "var", "level", *extra, F.col(value).alias("_value"), F.col(weight).alias("_weight")
        )
        whole = Size(sum(sizes[c].rows for c in together), sum(sizes[c].bytes for c in together))
        found = lookup(long, values, ["var", "level", *extra], "_weight", whole, Size(-1, -1))
        wide = found.groupBy(row_id).agg(
            *[F.max(F.when(F.col("var") == c, F.col("_value"))).alias(name(c)) for c in together]
        )
        out = out.join(wide, row_id, "left")
    return out.select(*df.columns, *[name(c) for c in cols])


def sorted_codes(df: DataFrame, cols: list[str], start: int = 1) -> DataFrame:
    """(var, level, n, code): levels numbered in binary text order."""
    coded = positions(level_counts(df, cols), ["level"], ["var"], "code")
    return coded.select("var", "level", "n", (F.col("code") + (start - 1)).cast("int").alias("code"))


def encode_sorted(
    df: DataFrame, cols: list[str], start: int = 1, suffix: str = "_code", row_id: str | None = None
) -> DataFrame:
    """Integer codes by sorted level; ``df`` is the union of train and test."""
    table = sorted_codes(df, cols, start)
    return attach_by_level(df, table, cols, "code", lambda c: c + suffix, row_id=row_id)


def label_encode(
    df: DataFrame, cols: list[str], suffix: str = "_label", row_id: str | None = None
) -> DataFrame:
    return encode_sorted(df, cols, start=0, suffix=suffix, row_id=row_id)


def encode_first_seen(
    df: DataFrame, cols: list[str], order: list[str], suffix: str = "_seen", row_id: str | None = None
) -> DataFrame:
    """1-based codes in the order in which levels first appear under ``order``."""
    firsts = (
        level_cells(df, cols, order)
        .where(F.col("level").isNotNull())
        .groupBy("var", "level")
        .agg(F.min(F.struct(*order)).alias("_first"), F.count("*").alias("n"))
    )
    coded = positions(firsts, ["_first"], ["var"], "code")
    table = coded.select("var", "level", "n", F.col("code").cast("int").alias("code"))
    return attach_by_level(df, table, cols, "code", lambda c: c + suffix, row_id=row_id)


def count_encode(
    df: DataFrame, cols: list[str], prefix: str = "ct", row_id: str | None = None
) -> DataFrame:
    """Frequency of each row's level, for every column."""
    return attach_by_level(
        df, level_counts(df, cols), cols, "n", lambda c: prefix + c, row_id=row_id
    )


def collapse_rare(
    df: DataFrame, col: str, min_rows: int = 1000, label: str = "RARE"
) -> DataFrame:
    """Levels with fewer than ``min_rows`` rows become ``label``."""
    counted = attach_by_level(df, level_counts(df, [col]), [col], "n", lambda c: "_n")
    rare = F.col("_n") < min_rows
    return counted.withColumn(col, F.when(rare, F.lit(label)).otherwise(F.col(col))).drop("_n")


def missing_flags(
    df: DataFrame, a: str, b: str, names: tuple[str, str, str], same: str | None = None,
    label: str = "mis",
) -> DataFrame:
    """Flags for the label in a, in b, in both, and optionally for a = b."""
    first = (F.col(a) == label).cast("int")
    second = (F.col(b) == label).cast("int")
    new = {names[0]: first, names[1]: second, names[2]: first * second}
    if same:
        new[same] = (F.col(a) == F.col(b)).cast("int")
    return with_all(df, new)


def _pasted(cols: list[str], sep: str) -> Column:
    # A missing part shows as "NA", it does not vanish.
    return F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in cols])


def interactions(df: DataFrame, cols: list[str], prefix: str = "bi", sep: str = "_") -> DataFrame:
    """A pasted column for every two of ``cols``."""
    return with_all(
        df, {f"{prefix}_{a}_{b}": _pasted([a, b], sep) for a, b in combinations(cols, 2)}
    )


def interactions_with(
    df: DataFrame, left: str, rights: list[str], prefix: str, sep: str = "_"
) -> DataFrame:
    """``left`` pasted with each of ``rights``, under separator-free names."""
    return with_all(
        df, {(prefix + r).replace("_", ""): _pasted([left, r], sep) for r in rights}
    )


def paste_columns(df: DataFrame, cols: list[str], name: str, sep: str = "_") -> DataFrame:
    return with_all(df, {name: _pasted(cols, sep)})


def clean_flags(df: DataFrame, cols: list[str], label: str = "mis") -> DataFrame:
    """Blank true/false texts get their own level."""
    return with_all(df, {c: blank_to(F.col(c), label) for c in cols if c in df.columns})


def standardize(df: DataFrame, cols: list[str], suffix: str = "") -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes 0.

    The fitted numbers are one row of two values per column.
    """
    stats = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)],
    ).first()
    new = {}
    for i, c in enumerate(cols):
        mean, sd = stats[f"m{i}"], stats[f"s{i}"]
        shifted = F.col(c).cast("double") - F.lit(0.0 if mean is None else float(mean))
        new[c + suffix] = shifted / F.lit(float(sd)) if sd else shifted
    return with_all(df, new)


def level_lookup(df: DataFrame, table: DataFrame, on: list[str]) -> DataFrame:
    """Table lookup, NULL where there is no match."""
    return lookup(df, table, on)
