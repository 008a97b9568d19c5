"""Projections, predicates and null handling."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataforge.operators import columns as C
from strataforge.plans import fixtures as fx
from strataforge.plans.fixture_sql import with_base, with_scores
from strataforge.plans.registry import query


def _slim(spark, sf):
    return fx.base(spark, sf).select("id", "y", "prio", "st", "n4")


@query("p1_drop_cols", with_base("select id, prio, st, n4 from base"))
def p1(spark, sf):
    return C.drop_columns(C.drop_columns(_slim(spark, sf), ["y"]), [])


@query("p2_select_present", with_base("select id, prio, st from base"))
def p2(spark, sf):
    return C.select_present(_slim(spark, sf), ["id", "prio", "not_there", "st"])


@query("p3_select_by_type", with_base("select id, y, n4, concat(prio, st) as texts from base"))
def p3(spark, sf):
    df = _slim(spark, sf)
    texts = F.concat(*[F.col(c) for c in C.columns_of_kind(df, "text")])
    return df.select(*C.columns_of_kind(df, "numeric"), texts.alias("texts"))


@query("p4_select_by_pattern", with_base("select id, prio as facprio, st as facst from base"))
def p4(spark, sf):
    df = _slim(spark, sf).select(
        "id", F.col("prio").alias("facprio"), F.col("st").alias("facst"), F.col("n4").alias("facpriodmp")
    )
    return df.select("id", *C.columns_like(df, "fac", "dmp"))


@query("p5_rename", with_base("select id, prio as facprio, st as facst, n4 as n4x from base"))
def p5(spark, sf):
    df = _slim(spark, sf).select("id", "prio", "st", F.col("n4").alias("n_4x"))
    return C.strip_text(C.rename_columns(df, lambda c: "fac_" + c, ["prio", "st"]), "_")


@query("p6_scale_const", with_base("select id, round(n2 / 1e9, 12) as n2 from base"))
def p6(spark, sf):
    df = C.scaled(fx.base(spark, sf).select("id", "n2"), "n2", 1e9)
    return df.select("id", F.round("n2", 12).alias("n2"))


@query(
    "p7_pair_sum_diff",
    with_base(
        """select id, round(n4 + n2, 4) as sumn2n4, round(n4 - n2, 4) as diffn2n4,
             round(n5 + n2, 4) as sumn2n5, round(n5 - n2, 4) as diffn2n5 from base"""
    ),
)
def p7(spark, sf):
    df = C.pair_columns(fx.base(spark, sf).select("id", "n2", "n4", "n5"), [("n4", "n2"), ("n5", "n2")])
    new = ["sumn2n4", "diffn2n4", "sumn2n5", "diffn2n5"]
    return df.select("id", *[F.round(c, 4).alias(c) for c in new])


@query("p8_ratio", with_base("select id, round(n4 / nullif(zip, 0), 6) as ratio from base"))
def p8(spark, sf):
    return fx.base(spark, sf).select("id", F.round(C.ratio(F.col("n4"), F.col("zip")), 6).alias("ratio"))


@query("p9_flag_eq", with_base("select id, cast(state1 = state2 as int) as same_state from base"))
def p9(spark, sf):
    return fx.base(spark, sf).select("id", C.flag_equal(F.col("state1"), F.col("state2")).alias("same_state"))


@query("p10_flag_and", with_base("select id, cast(state2 = '' and st = 'F' as int) as both_flags from base"))
def p10(spark, sf):
    a, b = C.flag_equal(F.col("state2"), F.lit("")), C.flag_equal(F.col("st"), F.lit("F"))
    return fx.base(spark, sf).select("id", C.flag_both(a, b).alias("both_flags"))


@query(
    "p11_casts",
    with_base(
        """select cast(id as varchar) as id, cast(zip as double) as zip, cast(fold10 as varchar) as fold10,
             round(cast(cast(n4 as float) as double), 3) as n4 from base"""
    ),
)
def p11(spark, sf):
    df = fx.base(spark, sf).select("id", "zip", "fold10", "n4")
    out = C.casted(df, {"id": "string", "zip": "double", "fold10": "string", "n4": "float"})
    return out.withColumn("n4", F.round(F.col("n4").cast("double"), 3))


@query("p12_label_remap", with_base("select id, 2 * y - 1 as label from base"))
def p12(spark, sf):
    return fx.base(spark, sf).select("id", C.signed_label(F.col("y")).alias("label"))


@query("p13_fill_null", with_base("select id, coalesce(n1, -1) as n1, coalesce(n7, -1) as n7 from base"))
def p13(spark, sf):
    return C.fill_nulls(fx.base(spark, sf).select("id", "n1", "n7"), -1.0, ["n1", "n7"])


@query(
    "p14_recode_blank",
    with_base("select id, case when state2 = '' then 'mis' else state2 end as state2, state1 from base"),
)
def p14(spark, sf):
    df = fx.base(spark, sf).select("id", "state1", "state2")
    return C.recode_blanks(df, ["state1", "state2", "absent"], "mis", ("", "-1"))


@query("p15_one_hot_label", with_base("select id, y, 1 - y as y_0, y as y_1 from base"))
def p15(spark, sf):
    return C.one_hot(fx.base(spark, sf).select("id", "y"), "y", [0, 1])


@query(
    "p16_where_valid",
    with_base(
        """select case when fold10 = 3 then 'valid' else 'rest' end as part, count(*) as n,
             cast(sum(id) as bigint) as sum_id from base group by 1"""
    ),
)
def p16(spark, sf):
    rows = fx.base(spark, sf)
    folds = rows.select("id", (F.col("fold10") == 3).cast("int").alias("valid"))
    inside = C.where_valid(rows, folds, "id").select("id", F.lit("valid").alias("part"))
    outside = C.where_valid(rows, folds, "id", False).select("id", F.lit("rest").alias("part"))
    return inside.union(outside).groupBy("part").agg(F.count("*").alias("n"), F.sum("id").alias("sum_id"))


@query(
    "p17_where_fold",
    with_base(
        """select st, cast(count(*) filter (fold10 = 4) as bigint) as n_in,
             cast(count(*) filter (fold10 <> 4) as bigint) as n_out from base group by st"""
    ),
)
def p17(spark, sf):
    rows = fx.base(spark, sf)
    a = C.where_fold(rows, "fold10", 4).groupBy("st").agg(F.count("*").alias("n_in"))
    b = C.where_fold(rows, "fold10", 4, False).groupBy("st").agg(F.count("*").alias("n_out"))
    return a.join(b, "st")


@query(
    "p18_where_threshold",
    with_scores(
        "select id, model, round(score, 6) as score from scores where score - 0.5 > 0.301 or score - 0.5 < -0.301"
    ),
)
def p18(spark, sf):
    df = fx.scores(spark, sf).withColumn("off", F.col("score") - F.lit(0.5))
    return C.where_beyond(df, "off", 0.301, absolute=True).select("id", "model", F.round("score", 6).alias("score"))
