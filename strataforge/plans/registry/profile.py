"""Column profiles, correlation, linear combinations and selection."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from strataforge.operators import correlation as R
from strataforge.operators import lincomb as L
from strataforge.operators import profile as P
from strataforge.operators import selection as S
from strataforge.operators.encode import encode_sorted
from strataforge.plans import fixtures as fx
from strataforge.plans.fixture_sql import auc_sql, with_base
from strataforge.plans.registry import query
from strataforge.session import cut

PROFILED = ["id", "y", "prio", "state2", "n1", "n2", "n4", "n6", "n7"]
CORRELATED = ["n2", "n3", "n4", "n5", "n8", "zip"]


def _union(parts) -> str:
    return " union all ".join(parts)


@query(
    "c1_null_counts",
    with_base(
        _union(
            f"select '{c}' as var, {i} as idx, cast(count(*) filter ({c} is null) as bigint) as n_null, "
            f"count(*) as n_rows from base"
            for i, c in enumerate(PROFILED, 1)
        )
    ),
)
def c1(spark, sf):
    return P.null_counts(fx.base(spark, sf), PROFILED)


@query("c1_drop_all_null", with_base("select id, n1, n6 from base"))
def c1_drop(spark, sf):
    df = fx.base(spark, sf).select("id", "n1", "n6", "n7")
    return df.drop(*P.all_null_columns(df))


@query(
    "c2_has_missing",
    with_base(
        "select var, n_null from (" + _union(
            f"select '{c}' as var, cast(count(*) filter ({c} is null) as bigint) as n_null from base" for c in PROFILED
        ) + ") where n_null > 0"
    ),
)
def c2(spark, sf):
    df = fx.base(spark, sf).select(*PROFILED)
    return P.null_counts(df, P.columns_with_nulls(df)).select("var", "n_null")


@query("c3_drop_duplicate_columns", with_base("select id, n2, n3, n4, state1 from base"))
def c3(spark, sf):
    df = fx.base(spark, sf).select("id", "n2", "n3", "n4", "n8", "state1", F.col("state1").alias("state1b"))
    return df.drop(*P.duplicate_columns(df, "id"))


@query("c4_drop_constant", with_base("select id, n1, n4, n7, case when id % 2 = 0 then 5 end as half from base"))
def c4(spark, sf):
    df = fx.base(spark, sf).select(
        "id", "n1", "n4", "n6", "n7", "k", F.when(F.col("id") % 2 == 0, 5).alias("half")
    )
    # Constant where present stays when NULLs count as another value.
    return df.drop(*[c for c in P.constant_columns(df) if c != "half"], *P.constant_columns(df, ["half"], -1))


@query(
    "c5_col_min_max",
    with_base(
        _union(
            f"select '{c}' as var, {i} as idx, cast(min({c}) as double) as min_value, "
            f"cast(max({c}) as double) as max_value from base"
            for i, c in enumerate(["n1", "n2", "n3", "n4", "n7", "zip"], 1)
        )
    ),
)
def c5(spark, sf):
    return P.min_max(fx.base(spark, sf), ["n1", "n2", "n3", "n4", "n7", "zip"])


PAIRS = [(b, a) for a, b in combinations(CORRELATED, 2)]
CORR_SQL = "corrs as (" + _union(
    f"select {CORRELATED.index(r) + 1} as ref_idx, {CORRELATED.index(d) + 1} as dep_idx, "
    f"'{r}' as ref_name, '{d}' as dep_name, corr({r}, {d}) as r from base"
    for r, d in PAIRS
) + ")"


@query(
    "c6_corr_matrix",
    with_base("select ref_idx, dep_idx, ref_name, dep_name, round(r, 6) as corr_value from corrs", CORR_SQL),
)
def c6(spark, sf):
    table = R.correlation_table(fx.base(spark, sf), CORRELATED)
    return table.withColumn("corr_value", F.round("corr_value", 6))


@query(
    "c7_corr_pairs",
    with_base(
        "select ref_idx, dep_idx, ref_name, dep_name, round(r, 6) as corr_value from corrs where abs(r) > 0.95",
        CORR_SQL,
    ),
)
def c7(spark, sf):
    # The constant column k has no correlation and so is in no pair.
    pairs = R.correlated_pairs(fx.base(spark, sf), [*CORRELATED, "k"])
    return pairs.withColumn("corr_value", F.round("corr_value", 6))


@query(
    "c8_drop_correlated",
    with_base(
        """select distinct 'abs' as mode, ref_name as var from corrs where abs(r) > 0.95
           union all select distinct 'signed', ref_name from corrs where r > 0.95""",
        CORR_SQL,
    ),
)
def c8(spark, sf):
    pairs = cut(R.correlated_pairs(fx.base(spark, sf), CORRELATED))
    rows = [("abs", c) for c in R.columns_to_drop(pairs)]
    rows += [("signed", c) for c in R.columns_to_drop(pairs, signed=True)]
    return spark.createDataFrame(rows, "mode string, var string")


@query("c9_drop_linear_combos", with_base("select id, n2, n3, n4 from base"))
def c9(spark, sf):
    df = fx.base(spark, sf).select("id", "n2", "n3", "n4", "n5", "n8", "k")
    return df.drop(*L.linear_combinations(df, ["n2", "n3", "n4", "n5", "n8", "k"]))


@query("c10_linear_combos_windowed", with_base("select id, n2, n3, n4, k from base"))
def c10(spark, sf):
    # Width 3 sees n2,n3,n4 / n5,n8,k only; width 5 then finds the rest but k.
    df = fx.base(spark, sf).select("id", "n2", "n3", "n4", "n5", "n8", "k")
    gone = L.windowed_linear_combinations(df, ["n2", "n3", "n4", "n5", "n8", "k"], (3, 5), 3)
    return df.drop(*gone)


@query("c11_linear_combos_of_codes", with_base("select id, st, prio from base"))
def c11(spark, sf):
    df = fx.base(spark, sf).select("id", "st", "prio", F.concat(F.lit("z"), "st").alias("st_again"))
    codes = ["st", "prio", "st_again"]
    coded = encode_sorted(df, codes)
    gone = L.combinations_of_codes(coded, [c + "_code" for c in codes])
    return df.drop(*[c.removesuffix("_code") for c in gone])


SIGNAL = "cast(10 * cast(substr(prio, 1, 1) as int) + zip % 20 as double)"
SIGNAL_SQL = f"""sig as (select id, y, fold10, {SIGNAL} as a, {SIGNAL} * 2 + fold10 as b, n2, n8, n4, zip
  from base where split = 'train')"""


def _signal(spark, sf):
    a = (10 * F.substring("prio", 1, 1).cast("int") + F.col("zip") % 20).cast("double")
    return fx.base(spark, sf).where("split = 'train'").select(
        "id", "y", "fold10", a.alias("a"), (a * 2 + F.col("fold10")).alias("b"), "n2", "n8", "n4", "zip"
    )


DERIVED_SQL = """derived as (
  select 'b' as ref_name, 'a' as dep_name, 's' as kind, y, fold10, b + a as score from sig
  union all select 'b', 'a', 'd', y, fold10, b - a from sig
  union all select 'n8', 'n2', 's', y, fold10, n8 + n2 from sig
  union all select 'n8', 'n2', 'd', y, fold10, n8 - n2 from sig)"""
WORTH_SQL = (
    "worth as (select ref_name, dep_name, kind, avg(auc) - 3 * stddev_samp(auc) as low from ("
    + auc_sql("derived", "ref_name, dep_name, kind, fold10")
    + ") group by 1, 2, 3)"
)


def _information(spark, sf):
    df = cut(_signal(spark, sf))
    pairs = R.correlated_pairs(df, ["a", "b", "n2", "n8", "n4"])
    return df, cut(R.pair_information(df, pairs, "y", "fold10"))


@query(
    "c12_pair_information",
    with_base(
        """select ref_name, dep_name, round(max(low) filter (kind = 's'), 6) as xsum,
             round(max(low) filter (kind = 'd'), 6) as xdiff from worth group by 1, 2""",
        SIGNAL_SQL, DERIVED_SQL, WORTH_SQL,
    ),
)
def c12(spark, sf):
    _, worth = _information(spark, sf)
    return worth.select("ref_name", "dep_name", F.round("xsum", 6).alias("xsum"), F.round("xdiff", 6).alias("xdiff"))


@query("c13_add_informative_pairs", with_base("select id, a, b, n2, n8, b + a as sumab, b - a as diffab from sig", SIGNAL_SQL))
def c13(spark, sf):
    df, worth = _information(spark, sf)
    return R.add_informative_pairs(df.select("id", "a", "b", "n2", "n8"), worth)


RELEVANT = ["a", "b", "n2", "n4", "zip"]
RELEVANCE_SQL = (
    "long as (" + _union(f"select '{c}' as var, y, fold10, cast({c} as double) as score from sig" for c in RELEVANT)
    + "), relevance as (select var, avg(auc) as mean_auc from ("
    + auc_sql("long", "var, fold10") + ") group by var)"
)


@query(
    "c14_univariate_relevance",
    with_base("select var, round(mean_auc, 6) as mean_auc from relevance", SIGNAL_SQL, RELEVANCE_SQL),
)
def c14(spark, sf):
    table = S.univariate_relevance(_signal(spark, sf), RELEVANT, "y", "fold10")
    return table.select("var", F.round("mean_auc", 6).alias("mean_auc"))


@query(
    "c14_most_relevant",
    with_base(
        "select var, round(mean_auc, 6) as mean_auc from relevance order by mean_auc desc, var limit 1",
        SIGNAL_SQL, RELEVANCE_SQL,
    ),
)
def c14_best(spark, sf):
    table = S.univariate_relevance(_signal(spark, sf), RELEVANT, "y", "fold10")
    return S.most_relevant(table).select("var", F.round("mean_auc", 6).alias("mean_auc"))


@query("c15_greedy_forward_select")
def c15(spark, sf):
    df = _signal(spark, sf).withColumn("p", F.floor(F.col("a") / 10)).withColumn("c", F.col("zip") % 20)
    return S.greedy_forward(df, ["p", "c", "n2", "n4", "zip"], "y", "fold10")


@query("c16_importance_rf")
def c16(spark, sf):
    return S.forest_importance(_signal(spark, sf), ["a", "n2", "n4", "zip"])


@query("c17_importance_gbm")
def c17(spark, sf):
    return S.boosted_importance(_signal(spark, sf), ["a", "n2", "n4", "zip"])


# Importances here are sums over lineitem: sparse ones stand for boosting, dense for forests.
IMPORTANCE_SQL = """boosted as (
    select concat('v', cast(l_suppkey % 50 as varchar)) as var, l_linenumber as rep,
      sum(case when l_quantity = 50 and l_suppkey % 3 > 0 and l_discount > 0.08 and l_linenumber <= l_suppkey % 8
          then l_discount else 0 end) as importance
    from lineitem group by 1, 2),
  forest as (
    select concat('v', cast(l_suppkey % 50 as varchar)) as var, l_linenumber as rep,
      avg(l_quantity) * (l_suppkey % 50) / cast(400 as double) as importance
    from lineitem group by var, rep, l_suppkey % 50),
  bs as (select var, sum(importance) as total, avg(case when importance > 0 then 1.0::double else 0 end) as share
         from boosted group by var),
  fs as (select var, avg(importance) as mean from forest group by var)"""


@query(
    "c18_select_by_importance",
    "with " + IMPORTANCE_SQL + """
      select 'r1' as version, var from bs where total <> 0
      union all select 'r2', var from bs where share > 0.05
      union all select 'r3', var from bs where share > 0.10
      union all select 'r4', var from bs where share > 0.25
      union all select 'r5', var from fs where mean > 0.5
      union all select 'r6', var from fs where mean > 1
      union all select 'r7', var from fs where mean > 2""",
)
def c18(spark, sf):
    items = fx.table(spark, sf, "lineitem")
    supp = F.col("l_suppkey")
    keyed = items.withColumn("var", F.concat(F.lit("v"), (supp % 50).cast("string"))).withColumn(
        "rep", F.col("l_linenumber")
    )
    hit = (F.col("l_quantity") == 50) & (supp % 3 > 0) & (F.col("l_discount") > 0.08) & (F.col("rep") <= supp % 8)
    boosted = keyed.groupBy("var", "rep").agg(
        F.sum(F.when(hit, F.col("l_discount")).otherwise(0.0)).alias("importance")
    )
    forest = keyed.groupBy("var", "rep", (supp % 50).alias("m")).agg(F.avg("l_quantity").alias("q"))
    forest = forest.select("var", "rep", (F.col("q") * F.col("m") / F.lit(400.0)).alias("importance"))
    return S.select_by_importance(boosted, forest)
