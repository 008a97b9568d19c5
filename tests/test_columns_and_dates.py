from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from strataforge.operators import columns as C
from strataforge.operators import dates as D
from strataforge.operators import encode as E
from strataforge.operators import profile as P
from strataforge.sources import delimited, sinks, sparse_text


def test_blanks(spark):
    df = spark.createDataFrame([("",), ("-1",), ("NA",), (None,), ("x",)], "c string")
    strict = [r["c"] for r in C.recode_blanks(df, ["c"]).collect()]
    wide = [r["c"] for r in C.recode_blanks(df, ["c", "absent"], "mis", ("", "-1")).collect()]
    assert strict == ["mis", "-1", "NA", "mis", "x"]
    assert wide == ["mis", "mis", "NA", "mis", "x"]


def test_empty_lists_change_nothing(spark):
    df = spark.createDataFrame([(1, 2.0)], "a int, b double")
    assert C.drop_columns(df, []).columns == ["a", "b"]
    assert C.fill_nulls(df, -1, []).collect() == df.collect()
    assert C.pair_columns(df, []).columns == ["a", "b"]


def test_rename_collision_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], "a_b int, ab int")
    with pytest.raises(ValueError, match="ab"):
        C.strip_text(df, "_")


def test_ratio_with_zero(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, 2.0)], "a double, b double")
    assert [r["r"] for r in df.select(C.ratio(F.col("a"), F.col("b")).alias("r")).collect()] == [None, 0.5]


def test_pair_names_put_the_earlier_column_first():
    assert C.pair_name("sum", "VAR_0200", "VAR_0010", "VAR") == "sum_0010_0200"


def test_dates(spark):
    rows = [(1, "01JAN69:00:00:00", "31OCT99", None), (2, "xx", "", None), (3, "05FEB14", "05FEB14", "05MAR14"), (4, "31DEC68", "30FEB10", "")]
    df = spark.createDataFrame(rows, "id int, a string, b string, c string")
    got = {r["id"]: r.asDict() for r in D.date_summary(df, ["a", "b", "c"]).collect()}
    assert str(df.select(D.parse_ddmonyy(F.col("a")).alias("d")).first()["d"]) == "1969-01-01"
    assert (got[1]["nof_dates"], got[1]["initial_year"], got[1]["last_year"], got[1]["nof_years"]) == (2, 1969, 1999, 30)
    assert [got[2][c] for c in ("nof_dates", "nof_unique_dates", "initial_year", "last_year", "duration_contact", "nof_years")] == [0] * 6
    assert (got[3]["nof_dates"], got[3]["nof_unique_dates"], got[3]["duration_contact"]) == (3, 2, 28)
    assert (got[4]["nof_dates"], got[4]["initial_year"]) == (1, 2068)


def test_profile_corner_cases(spark):
    df = spark.createDataFrame(
        [(1, None, 5.0, 1.0, 1.0, 2.0), (2, None, None, 1.0, 1.0, 2.0), (3, None, None, None, None, 3.0)],
        "id int, gone double, single double, a double, b double, c double",
    )
    assert P.all_null_columns(df) == ["gone"]
    # One value has no deviation, so the column is not called constant.
    assert P.constant_columns(df, ["gone", "single", "a", "c"]) == ["a"]
    assert P.constant_columns(df, ["a"], fill=-1) == []
    assert P.duplicate_columns(df, "id") == ["b"]
    assert P.all_null_columns(df.limit(0)) == []


def test_standardize_constant_and_union(spark):
    df = spark.createDataFrame([(1.0, 7.0), (3.0, 7.0)], "a double, k double")
    assert [tuple(r) for r in E.standardize(df, ["a", "k"]).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_first_seen_follows_the_given_order(spark):
    rows = [(0, 5, "z"), (0, 1, "b"), (1, 0, "new"), (0, 3, "z"), (0, 2, None)]
    df = spark.createDataFrame(rows, "part int, id int, c string")
    got = {r["c"]: r["c_seen"] for r in E.encode_first_seen(df, ["c"], ["part", "id"]).collect()}
    assert got == {"b": 1, "z": 2, "new": 3, None: None}


def test_template_needs_every_id(spark):
    ids = spark.createDataFrame([(1, 0.0), (2, 0.0)], "ID long, target double")
    scores = spark.createDataFrame([(1, 0.7)], "ID long, target double")
    with pytest.raises(Exception, match="no score for id 2"):
        sinks.fill_template(ids, scores).collect()


def test_score_files_in_different_row_order(spark, tmp_path):
    a = spark.createDataFrame([(1, 0.1), (2, 0.2)], "ID long, target double")
    b = spark.createDataFrame([(2, 0.8), (1, 0.9)], "ID long, target double")
    sinks.write_table(a, f"{tmp_path}/predValid_a.csv", "csv")
    sinks.write_table(b, f"{tmp_path}/predValid_b_2.csv", "csv")
    got = {(r["model"], r["ID"]): r["target"] for r in delimited.read_scores(spark, str(tmp_path), "predValid_").collect()}
    assert got == {("a", 1): 0.1, ("a", 2): 0.2, ("b_2", 1): 0.9, ("b_2", 2): 0.8}


def test_csv_keeps_blank_and_null_apart(spark, tmp_path):
    df = spark.createDataFrame([(1, ""), (2, None), (3, "NA"), (4, "x")], "id int, c string")
    sinks.write_table(df, f"{tmp_path}/t", "csv")
    got = {r["id"]: r["c"] for r in delimited.read_table(spark, f"{tmp_path}/t", "id int, c string").collect()}
    assert got == {1: "", 2: None, 3: None, 4: "x"}


def test_namespaced_row_without_target(spark):
    df = spark.createDataFrame([(7, "t", 1.5)], "ID int, c string, v double")
    line = sparse_text.namespaced_rows(df, "ID", {"f": ["c"], "t": []}, ["v"]).first()["value"]
    assert line == "1 '7 |r v:1.5 |f c_t |t"
