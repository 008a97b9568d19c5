"""Joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataforge.operators import relate as J
from strataforge.operators.profile import null_counts
from strataforge.plans import fixtures as fx
from strataforge.plans.fixture_sql import with_base, with_scores
from strataforge.plans.registry import query

MODELS = list(fx.SCORE_MODELS)
WIDE_SQL = ", ".join(f"round({m}, 6) as target{i}" for i, m in enumerate(MODELS, 1))


def _rounded(df, names):
    return df.select("id", *[F.round(n, 6).alias(n) for n in names])


@query("j1_inner_merge_all", with_scores(f"select id, {WIDE_SQL} from wide where id % 3 <> 0"))
def j1(spark, sf):
    long = fx.scores(spark, sf)
    parts = [long.where(F.col("model") == m).select("id", F.col("score").alias("target")) for m in MODELS]
    # The third table lacks some ids, so the merge must lose them.
    parts[2] = parts[2].where("id % 3 <> 0")
    return _rounded(J.merge_all(parts, "id", "target"), [f"target{i}" for i in range(1, 5)])


@query("j1_merge_long", with_scores("select id, " + ", ".join(f"round({m}, 6) as {m}" for m in MODELS) + " from wide where id % 3 <> 0"))
def j1_long(spark, sf):
    long = fx.scores(spark, sf).where("model <> 'm3' or id % 3 <> 0")
    return _rounded(J.merge_all_long(long, "id", "model", "score", MODELS), MODELS)


@query("j2_lookup_join", "select s_suppkey, n_name from supplier left join nation on n_nationkey = s_nationkey and n_nationkey < 20")
def j2(spark, sf):
    nation = fx.table(spark, sf, "nation").where("n_nationkey < 20").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return J.lookup_join(fx.table(spark, sf, "supplier").select("s_suppkey", "s_nationkey"), nation, ["s_nationkey"]).select("s_suppkey", "n_name")


@query("j3_fold_attach", with_base("select id, y, fold10 from base"))
def j3(spark, sf):
    rows = fx.base(spark, sf)
    return J.attach_folds(rows.select("id", "y"), rows.select("id", "fold10").orderBy(F.desc("id")), "id")


@query("j4_hconcat", with_base("select id, y, n2, n4, prio from base"))
def j4(spark, sf):
    rows = fx.base(spark, sf)
    return J.hconcat([rows.select("id", "y", "n2"), rows.select("id", "y", "n4"), rows.select("id", "prio")], "id")


@query(
    "j5_vconcat_then_split",
    with_base(
        """select 'train' as part, count(*) as n, cast(sum(y) as bigint) as sum_y from base where split = 'train'
           union all select 'test', count(*), cast(null as bigint) from base where split = 'test'"""
    ),
)
def j5(spark, sf):
    rows = fx.base(spark, sf)
    train = rows.where("split = 'train'").select("id", "y", "prio")
    test = rows.where("split = 'test'").select("id", "prio")
    a, b = J.split_back(J.vconcat(train, test))
    sums = [F.count("*").alias("n"), F.sum("y").alias("sum_y")]
    return a.agg(F.lit("train").alias("part"), *sums).union(b.agg(F.lit("test").alias("part"), *sums))


@query("j6_semi_members", with_base("select id, city from base where city in (select city from base group by city having count(*) > 400)"))
def j6(spark, sf):
    rows = fx.base(spark, sf).select("id", "city")
    common = rows.groupBy("city").count().where("count > 400")
    return J.members(rows, common, ["city"])


@query("j7_anti_members", with_base("select id, city from base where city not in (select city from base group by city having count(*) > 400)"))
def j7(spark, sf):
    rows = fx.base(spark, sf).select("id", "city")
    common = rows.groupBy("city").count().where("count > 400")
    return J.non_members(rows, common, ["city"])


@query("j8_distinct_union", with_base("select state1 as level from base union select state2 from base"))
def j8(spark, sf):
    rows = fx.base(spark, sf)
    return J.distinct_union(rows.select(F.col("state1").alias("level")), rows.select("state2"))


PAIRED = ["n1", "n4", "n7", "zip"]


@query(
    "j9_pair_self_join",
    with_base(
        " union all ".join(
            f"select {i + 1} as i, {j + 1} as j, '{a}' as a, '{b}' as b, "
            f"cast(count(*) filter ({a} is null) as bigint) as nulls_a, "
            f"cast(count(*) filter ({b} is null) as bigint) as nulls_b from base"
            for i, a in enumerate(PAIRED)
            for j, b in enumerate(PAIRED)
            if i < j
        )
    ),
)
def j9(spark, sf):
    df = fx.base(spark, sf).select(*PAIRED)
    nulls = null_counts(df)
    pairs = J.column_pairs(df, PAIRED)
    a = nulls.select(F.col("var").alias("a"), F.col("n_null").alias("nulls_a"))
    b = nulls.select(F.col("var").alias("b"), F.col("n_null").alias("nulls_b"))
    return pairs.join(a, "a").join(b, "b").select("i", "j", "a", "b", "nulls_a", "nulls_b")


@query("j10_pair_valid_full", with_scores("select model, count(*) as n_full from scores where model <> 'm2' and model <> 'm4' group by model"))
def j10(spark, sf):
    long = fx.scores(spark, sf)
    valid, full = long.where("id % 5 <> 0 and model <> 'm4'"), long.where("model <> 'm2'")
    return J.pair_by_model(valid, full).join(full, "model").groupBy("model").agg(F.count("*").alias("n_full"))


@query("j11_dedup_rows", with_base("select distinct prio, st, y, fold10 from base"))
def j11(spark, sf):
    return J.dedup_rows(fx.base(spark, sf), ["prio", "st", "y", "fold10"])
