from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strataforge.functions.lookup import Size, hot_hashes, lookup
from strataforge.operators import encode as E
from strataforge.operators.relate import members, non_members

NONE = Size(0, 0)  # nothing may be broadcast as small


def _big(spark, n=6000):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, None).otherwise(
        F.concat(F.lit("k"), (F.col("id") % 997).cast("string"))
    )
    return spark.range(n).select("id", key.alias("k"))


@pytest.mark.parametrize("weight", [None, "n"])
def test_large_tables_give_the_same_rows(spark, weight):
    df = _big(spark)
    table = df.where("k <> 'k5'").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    table = table.where("k is not null")
    if weight is None:
        table = table.drop("n")
    want = {r["id"]: r["top"] for r in df.join(table, "k", "left").collect()}
    got = lookup(df, table, ["k"], weight, limit=NONE, hot_share=0.1)
    assert got.columns == ["id", "k", "top"]
    assert {r["id"]: r["top"] for r in got.collect()} == want
    small = lookup(df, table, ["k"], weight)
    assert {r["id"]: r["top"] for r in small.collect()} == want


def test_hot_rows_leave_the_shuffled_key(spark):
    """A third of the rows has one key; the shuffle join must not see it in one partition."""
    df = _big(spark)
    table = df.where("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    plan = lookup(df, table, ["k"], "n", limit=NONE, hot_share=0.1)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in text and "BroadcastHashJoin" in text


def test_hot_key_that_the_table_lacks(spark):
    """A level that most looked-up rows have and the table does not: its rows are salted, found or not."""
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, -1).otherwise(F.col("id")).cast("int").alias("k"))
    table = spark.range(0, 3000, 3).select(F.col("id").alias("k"), F.col("id").alias("v"))
    assert len(hot_hashes(df, ["k"], 0.1)) == 1
    got = lookup(df, table, ["k"], limit=NONE, hot_share=0.1)
    assert {r["id"]: r["v"] for r in got.collect()} == {i: i if i % 3 == 0 else None for i in range(3000)}


def test_members(spark, monkeypatch):
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i % 3) for i in range(60)], "id int, k int")
    keys = spark.createDataFrame([(1,), (1,), (7,), (None,)], "k int")
    for fits in (True, False):
        monkeypatch.setattr(Size, "fits", lambda self, *a: fits)
        inside = {r["id"] for r in members(df, keys, ["k"]).collect()}
        assert inside == {i for i in range(60) if i % 5 and i % 3 == 1}
        assert {r["id"] for r in non_members(df, keys, ["k"]).collect()} == set(range(60)) - inside


def test_one_broadcast_budget(spark):
    """Columns share the limit: what does not fit together goes by the narrow join."""
    df = spark.range(400).select("id", *[(F.col("id") % 100).cast("string").alias(f"c{i}") for i in range(6)])
    cols = [f"c{i}" for i in range(6)]
    out = E.attach_by_level(df, E.level_counts(df, cols), cols, "n", lambda c: "ct" + c, row_id="id", limit=Size(250, 1 << 20))
    assert out.where(" and ".join(f"ct{c} = 4" for c in cols)).count() == 400
    text = out._jdf.queryExecution().executedPlan().toString()
    assert text.count("BroadcastHashJoin") - text.count("_served") <= 4


def test_null_safe_keys_match(spark):
    df = spark.createDataFrame([(1, None, 5), (2, "a", 5), (3, "a", None)], "id int, g string, v int")
    table = spark.createDataFrame([(None, 5, 10, 1), ("a", 5, 20, 1)], "g string, v int, out int, w int")
    for limit in (Size(10, 1000), NONE):
        got = lookup(df, table, ["g", "v"], "w", limit=limit, hot_share=2.0, null_safe=["g"])
        assert {r["id"]: r["out"] for r in got.collect()} == {1: 10, 2: 20, 3: None}


def test_long_lookup_equals_column_by_column(spark):
    df = _big(spark).withColumn("c", F.col("id") % 50).withColumn("d", F.concat(F.lit("x"), F.col("id") % 400))
    cols = ["k", "c", "d"]
    counts = E.level_counts(df, cols)
    name = lambda c: "ct" + c
    one = E.attach_by_level(df, counts, cols, "n", name)
    many = E.attach_by_level(df, counts, cols, "n", name, row_id="id", limit=NONE)
    assert many.columns == one.columns
    assert sorted(map(tuple, many.collect()), key=str) == sorted(map(tuple, one.collect()), key=str)
