"""Line dedup against a plain loop; the registered query is also checked by SQL."""

from __future__ import annotations

from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from strataforge.llm import line_dedup
from strataforge.llm.line_dedup import BLANK, drop_repeated_lines, keep_bitmaps

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows, min_docs, min_chars, keep_first):
    key = lambda line: line.strip(BLANK).translate(LOWER)
    seen = defaultdict(set)
    order = sorted((i is not None, i or 0, p, line) for i, t in rows for p, line in enumerate((t or "").split("\n")))
    first = {}
    for known, i, p, line in order:
        seen[key(line)].add((known, i))
        first.setdefault(key(line), (known, i, p))
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keep = [
            line for p, line in enumerate(lines)
            if len(key(line)) < min_chars or len(seen[key(line)]) < min_docs or keep_first and first[key(line)] == (i is not None, i or 0, p)
        ]
        out.append((i, "\n".join(keep), len(lines), len(lines) - len(keep)))
    return sorted(out, key=str)


ROWS = (
    [(i, f"Head\n own {i} \n\t FOOT\x0b\n\nÉtÉ {i % 2}") for i in range(12)]
    + [(100, None), (101, ""), (102, "\n\n"), (103, "foot"), (104, "Foot\nfoot\nFOOT"), (105, "été 0"), (105, "foot\nmore"), (None, "foot\nx")]
    + [(200, "head\n" * 500 + "end"), (201, "x\r"), (201, "x\r")]
)


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("min_docs,min_chars", [(2, 1), (10, 1), (12, 0), (5, 5)])
def test_by_hand(spark, keep_first, min_docs, min_chars):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(5)
    got = drop_repeated_lines(docs, min_docs=min_docs, min_chars=min_chars, keep_first=keep_first)
    assert sorted(map(tuple, got.collect()), key=str) == by_hand(ROWS, min_docs, min_chars, keep_first)


@pytest.mark.parametrize("keep_first", [False, True])
def test_hot_line(spark, keep_first):
    """A line that most rows hold is dealt over cells and still counted exactly."""
    rows = [(i, f"all\nown {i}\n" + ("pair" if i // 2 in (3, 4) else "")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert line_dedup._hot_keys(line_dedup.line_marks(docs, "doc_id", "text", 1))
    got = drop_repeated_lines(docs, min_docs=4, keep_first=keep_first)
    assert sorted(map(tuple, got.collect()), key=str) == by_hand(rows, 4, 1, keep_first)


def test_bitmaps_hold_no_text(spark):
    docs = spark.createDataFrame([(i, "a\nb\nc\na\nown %d\na" % i) for i in range(3)], "doc_id long, text string")
    rows = keep_bitmaps(docs, min_docs=3).select("id", "n_dropped", "dropped_runs").collect()
    assert {r["id"]: (r["n_dropped"], [tuple(x) for x in r["dropped_runs"]]) for r in rows} == {
        i: (5, [(0, 4), (5, 1)]) for i in range(3)
    }


def test_native(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    plan = drop_repeated_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))


def test_empty_and_clashing_names(spark):
    schema = "doc_id long, text string, _row string, id string, pos int, N_LINES int"
    empty = drop_repeated_lines(spark.createDataFrame([], schema))
    assert empty.columns == ["doc_id", "text", "_row", "id", "pos", "n_lines", "n_dropped"] and empty.count() == 0
    docs = spark.createDataFrame([(i, "same\nown", "r", "i", None, 7) for i in range(10)], schema)
    rows = drop_repeated_lines(docs).collect()
    assert {(r["text"], r["_row"], r["id"], r["pos"], r["n_lines"], r["n_dropped"]) for r in rows} == {("", "r", "i", None, 2, 2)}
    assert docs.select(F.max("doc_id")).first()[0] == 9
