from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strataforge.operators import split as S


def _df(spark, n=1003, parts=3):
    return spark.range(n).select("id", (F.col("id") % 3 == 0).cast("int").alias("y")).repartition(parts)


def test_fold_sizes(spark):
    folds = S.k_folds(_df(spark), "id", 10, "f", ["y"])
    for y in (0, 1):
        sizes = [r["count"] for r in folds.where(F.col("y") == y).groupBy("fold").count().collect()]
        assert len(sizes) == 10 and max(sizes) - min(sizes) <= 1


def test_splits_do_not_depend_on_partitions(spark):
    for make in (
        lambda d: S.k_folds(d, "id", 5),
        lambda d: S.holdout(d, "id", 100),
        lambda d: S.repeated_samples(d, "id", 3, 0.25, ["y"]),
        lambda d: S.contiguous_folds(d, ["id"], 4),
        lambda d: S.random_split(d, "id", 0.1, 7),
    ):
        a, b = make(_df(spark, parts=1)), make(_df(spark, parts=9))
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_exact_sizes(spark):
    df = _df(spark)
    assert S.holdout(df, "id", 140).agg(F.sum("valid")).first()[0] == 140
    assert S.holdout(df, "id", 5000).agg(F.sum("valid")).first()[0] == 1003
    parts = {r["part"]: r["count"] for r in S.head_split(df, "id", 400).groupBy("part").count().collect()}
    assert parts == {"train": 400, "valid": 400, "rest": 203}
    blocks = sorted(r["count"] for r in S.equal_split(df, "id", 7).groupBy("part").count().collect())
    assert blocks == [143] * 5 + [144] * 2
    even = S.equal_split(_df(spark, 21), "id", 7).groupBy("part").count().collect()
    assert {(r["part"], r["count"]) for r in even} == {(k, 3) for k in range(1, 8)}


def test_contiguous_blocks_are_in_order(spark):
    rows = S.contiguous_folds(_df(spark, 10), ["id"], 4).orderBy("id").collect()
    assert [r["block"] for r in rows] == [1, 1, 1, 2, 2, 2, 3, 3, 4, 4]


@pytest.mark.parametrize("n,k", [(3, 5), (4, 4), (1, 3)])
def test_contiguous_blocks_with_few_rows(spark, n, k):
    rows = S.contiguous_folds(_df(spark, n), ["id"], k).orderBy("id").collect()
    assert [r["block"] for r in rows] == list(range(1, n + 1))


def test_repeats_differ_and_keep_the_class_share(spark):
    reps = S.repeated_samples(_df(spark), "id", 4, 0.25, ["y"])
    by = reps.where("inside = 1").groupBy("rep", "y").count().collect()
    assert {(r["y"], r["count"]) for r in by} == {(0, 167), (1, 84)}
    sets = {frozenset(r["id"] for r in reps.where(f"rep = {k} and inside = 1").collect()) for k in range(1, 5)}
    assert len(sets) == 4


def test_sample_lists_equal_the_long_form(spark):
    df = _df(spark)
    marked = S.with_samples(df, "id", 5, 0.3, ["y"], "t")
    long = S.repeated_samples(df, "id", 5, 0.3, ["y"], "t").where("inside = 1")
    for rep in range(1, 6):
        a = {r["id"] for r in S.in_sample(marked, rep).collect()}
        assert a == {r["id"] for r in long.where(F.col("rep") == rep).collect()}
    assert marked.count() == df.count()


def test_few_cells_are_counted_to_find_a_limit(spark, monkeypatch):
    counted = []
    monkeypatch.setattr(S, "cut", lambda df: counted.append(df.count()) or df)
    rows = spark.range(6000).withColumnRenamed("id", "i")
    got = S.repeated_samples(rows, "i", 2, 0.25)
    assert {r["rep"]: r["n"] for r in got.groupBy("rep").agg(F.sum("inside").alias("n")).collect()} == {1: 1500, 2: 1500}
    assert counted[0] <= 2 * 1024
