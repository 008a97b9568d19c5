"""Dropping repeated lines, with DataFrame functions only.

Lines travel as 128-bit hashes of their keys with document and position, never as
text.  They are range-partitioned by hash and sorted by document and position, so a
window streams through each key's occurrences.  What comes back are run-length
compressed bitmaps of the kept lines of each document.

A key that may hold a large share of all lines is found by a bounded sketch and dealt
over many cells; its exact document count comes from a pre-aggregated sum.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from strataforge.llm.naming import others

#: A key with this share of all lines is dealt over CELLS cells.
HOT_SHARE, CELLS, TRACKED = 1 / 256, 256, 4096

#: White space of ASCII, which is stripped from both ends of a line.
BLANK = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case, all other letters as they are."""
    plain = F.octet_length(c) == F.char_length(c)
    return F.when(plain, F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _row_hash(text: Column) -> Column:
    """Rows with the same id and different texts have line numbers of their own."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_marks(docs: DataFrame, id: str, text: str, min_chars: int) -> DataFrame:
    """(id, _row, pos, h1, h2) of every line whose key has at least ``min_chars`` code points."""
    source = F.col(f"`{text}`")
    lines = docs.select(
        F.col(f"`{id}`").alias("id"), _row_hash(source).alias("_row"), F.posexplode(lines_of(source)).alias("pos", "line")
    )
    keyed = lines.select("id", "_row", "pos", F.btrim("line", F.lit(BLANK)).alias("line"))
    if min_chars > 0:
        keyed = keyed.where(F.char_length("line") >= min_chars)
    keyed = keyed.select("id", "_row", "pos", lower_ascii(F.col("line")).alias("key"))
    return keyed.select("id", "_row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))


def _hot_keys(marks: DataFrame) -> list[int]:
    """First hash halves with a large share of the lines; at most 1 / HOT_SHARE of them."""
    found = marks.agg(F.expr(f"approx_top_k(h1, {int(1 / HOT_SHARE)}, {TRACKED})").alias("top"), F.count("*").alias("n")).first()
    return [r["item"] for r in found["top"] or [] if r["count"] >= max(2, found["n"] * HOT_SHARE)]


def dropped_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_docs: int = 10, min_chars: int = 1, keep_first: bool = False
) -> DataFrame:
    """(id, _row, pos) of the lines to drop.

    A key is a line without white space at its ends, with A-Z in lower case.  Keys
    found in at least ``min_docs`` documents lose all lines; with ``keep_first`` the
    first one in the order of id and position stays.
    """
    marks = line_marks(docs, id, text, min_chars)
    hot = _hot_keys(marks)
    is_hot = F.col("h1").isin(hot) if hot else F.lit(False)
    cell = F.when(is_hot, F.pmod(F.xxhash64("id"), F.lit(CELLS))).otherwise(F.lit(0))
    # One range exchange serves the window as well: its cells are ranges of its keys.
    dealt = marks.withColumn("cell", cell).repartitionByRange("h1", "cell")
    key = Window.partitionBy("h1", "cell", "h2")
    stream = key.orderBy("id", "pos", "_row")
    before = F.lag(F.struct("id")).over(stream)
    ranked = dealt.withColumn("_new", F.when(before.isNull() | ~before.eqNullSafe(F.struct("id")), 1).otherwise(0))
    ranked = ranked.withColumn("_docs", F.sum("_new").over(key)).withColumn("_at", F.row_number().over(stream))
    if hot:
        totals = (
            marks.where(is_hot)
            .groupBy("h1", "h2", "id")
            .agg(F.min(F.struct("pos", "_row")).alias("_p"))
            .groupBy("h1", "h2")
            .agg(F.count("*").alias("_all"), F.min(F.struct("id", "_p")).alias("_first"))
        )
        # At most a few rows for each of the 1 / HOT_SHARE hot hashes.
        ranked = ranked.join(F.broadcast(totals), ["h1", "h2"], "left")
        first = F.struct("id", F.struct("pos", "_row").alias("_p"))
        is_first = F.when(F.col("_all").isNull(), F.col("_at") == 1).otherwise(first == F.col("_first"))
        n = F.coalesce("_all", "_docs")
    else:
        is_first, n = F.col("_at") == 1, F.col("_docs")
    gone = ranked.where(n >= min_docs)
    if keep_first:
        gone = gone.where(~is_first)
    return gone.select("id", "_row", "pos")


def keep_bitmaps(docs: DataFrame, id: str = "doc_id", text: str = "text", **rules) -> DataFrame:
    """(id, _row, n_dropped, dropped_runs): per document with dropped lines, its bitmap as runs.

    A run is the first line and the number of lines that go; lines outside the runs
    stay.  Documents without a row keep all their lines.
    """
    gone = dropped_lines(docs, id, text, **rules)
    at = gone.groupBy("id", "_row").agg(F.array_sort(F.collect_set("pos")).alias("at"))
    starts = F.filter("at", lambda x, i: (i == 0) | (F.get("at", i - 1) != x - 1))
    ends = F.filter("at", lambda x, i: (i == F.size("at") - 1) | (F.get("at", i + 1) != x + 1))
    runs = F.zip_with(starts, ends, lambda s, e: F.struct(s.alias("start"), (e - s + 1).alias("length")))
    return at.select("id", "_row", F.size("at").alias("n_dropped"), runs.alias("dropped_runs"))


def _kept(lines: Column, runs: Column) -> Column:
    n = F.size(runs)
    start = lambda i: F.when(i == 0, 0).otherwise(F.get(runs, i - 1)["start"] + F.get(runs, i - 1)["length"])
    end = lambda i: F.when(i == n, F.size(lines)).otherwise(F.get(runs, i)["start"])
    return F.flatten(F.transform(F.sequence(F.lit(0), n), lambda i: F.slice(lines, start(i) + 1, end(i) - start(i))))


def drop_repeated_lines(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_docs: int = 10, min_chars: int = 1, keep_first: bool = False
) -> DataFrame:
    """The documents without their repeated lines, with ``n_lines`` (before) and ``n_dropped``.

    A null or empty text is one empty line and comes back as an empty text.  Rows
    with the same id count as one document; a null id is a document of its own.
    Repeated rows and other columns stay (columns called n_lines or n_dropped are
    replaced); an empty table stays empty.
    """
    bitmaps = keep_bitmaps(docs, id, text, min_docs=min_docs, min_chars=min_chars, keep_first=keep_first)
    kept = others(docs.columns, ("n_lines", "n_dropped"))
    source = F.col(f"`{text}`")
    marked = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_in"), F.col(f"`{id}`").alias("_own"), _row_hash(source).alias("_own_row")
    )
    # The bitmaps are the small side, so the texts are moved once and not sorted.
    right = bitmaps.hint("shuffle_hash")
    joined = marked.join(right, marked["_own"].eqNullSafe(right["id"]) & (marked["_own_row"] == right["_row"]), "left")
    whole = F.coalesce(F.col(f"_in.`{text}`"), F.lit(""))
    lines = lines_of(whole)
    shorter = F.when(F.col("dropped_runs").isNull(), whole).otherwise(F.array_join(_kept(lines, F.col("dropped_runs")), "\n"))
    return joined.select(
        *[shorter.alias(c) if c == text else F.col(f"_in.`{c}`").alias(c) for c in kept],
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
    )
