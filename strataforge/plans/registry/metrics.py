"""Aggregates, metrics, ranks and ordered operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from strataforge.functions import metrics as H
from strataforge.functions.ordering import average_rank, positions
from strataforge.operators import blend as B
from strataforge.operators import ordered as W
from strataforge.operators.encode import level_counts
from strataforge.operators.models import search
from strataforge.operators.profile import shape
from strataforge.plans import fixtures as fx
from strataforge.plans.fixture_sql import auc_sql, with_base, with_scores
from strataforge.plans.hashed_learning import hashed_rows
from strataforge.plans.registry import query
from strataforge.plans.registry.encode import HASHED_SQL, SLOTS
from strataforge.session import cut

FOLDED_SQL = "folded as (select scores.*, fold10 from scores join base using (id, y))"
FOLD_AUC_SQL = "fold_auc as (" + auc_sql("folded", "model, fold10") + ")"


def _folded(spark, sf):
    return fx.scores(spark, sf).join(fx.base(spark, sf).select("id", "fold10"), "id")


@query("h1_auc", with_scores("select round(auc, 6) as auc from (" + auc_sql("(select * from scores where model = 'm2')", "") + ")"))
def h1(spark, sf):
    one = fx.scores(spark, sf).where("model = 'm2'")
    return H.auc(one, "y", "score").select(F.round("auc", 6).alias("auc"))


@query("h2_auc_by", with_scores("select model, fold10, round(auc, 6) as auc from fold_auc", FOLDED_SQL, FOLD_AUC_SQL))
def h2(spark, sf):
    by = H.auc_by(_folded(spark, sf), "y", "score", ["model", "fold10"])
    return by.select("model", "fold10", F.round("auc", 6).alias("auc"))


@query(
    "h3_lower_bound",
    with_scores(
        "select model, round(avg(auc) - 3 * stddev_samp(auc), 6) as lower_bound from fold_auc group by model",
        FOLDED_SQL, FOLD_AUC_SQL,
    ),
)
def h3(spark, sf):
    table = H.auc_over_folds(_folded(spark, sf), "y", "score", "fold10", ["model"])
    return table.select("model", F.round("lower_bound", 6).alias("lower_bound"))


@query(
    "h4_cv_auc_mean",
    with_scores(
        "select model, round(avg(auc), 6) as mean_auc, round(stddev_samp(auc), 6) as sd_auc from fold_auc group by model",
        FOLDED_SQL, FOLD_AUC_SQL,
    ),
)
def h4(spark, sf):
    table = H.auc_over_folds(_folded(spark, sf), "y", "score", "fold10", ["model"])
    return table.select("model", F.round("mean_auc", 6).alias("mean_auc"), F.round("sd_auc", 6).alias("sd_auc"))


@query(
    "h5_logloss",
    with_scores(
        """select model, round(avg(-case when y = 1 then ln(p) else ln(1 - p) end), 6) as logloss from (
             select *, least(greatest(score, 1e-14::double), 1 - 1e-14::double) as p from scores) group by model"""
    ),
)
def h5(spark, sf):
    table = H.logloss(fx.scores(spark, sf), "y", "score", ["model"])
    return table.select("model", F.round("logloss", 6).alias("logloss"))


@query("h6_freq_table", with_base("select 'city' as var, city as level, count(*) as n from base group by city union all select 'st', st, count(*) from base group by st"))
def h6(spark, sf):
    return level_counts(fx.base(spark, sf), ["city", "st"])


@query("h7_row_mean_sd", with_scores("select id, round(avg(score), 6) as mean, round(stddev_samp(score), 6) as sd from scores group by id"))
def h7(spark, sf):
    table = B.row_spread(fx.scores(spark, sf), "id", "score")
    return table.select("id", F.round("mean", 6).alias("mean"), F.round("sd", 6).alias("sd"))


SUMMED = ["m1", "m2", "m3", "m4"]


@query(
    "h8_col_sum_mean",
    with_scores(
        "select model as var, round(sum(score), 4) as total, round(avg(score), 6) as mean from scores group by model"
    ),
)
def h8(spark, sf):
    wide = fx.scores_wide(spark, sf)
    total = H.aggregate_columns(wide, SUMMED, F.sum).select("var", F.round("value", 4).alias("total"))
    mean = H.aggregate_columns(wide, SUMMED, F.avg).select("var", F.round("value", 6).alias("mean"))
    return total.join(mean, "var")


@query(
    "h9_argmax",
    with_scores(
        """select fold10, model, round(auc, 6) as auc from fold_auc
           qualify row_number() over (partition by fold10 order by auc desc, model) = 1""",
        FOLDED_SQL, FOLD_AUC_SQL,
    ),
)
def h9(spark, sf):
    by = H.auc_by(_folded(spark, sf), "y", "score", ["model", "fold10"])
    return W.best_by(by, "auc", "model", ["fold10"]).withColumn("auc", F.round("auc", 6))


@query("h10_mean_y", with_base("select split, round(avg(y), 6) as mean_y from base group by split"))
def h10(spark, sf):
    return fx.base(spark, sf).groupBy("split").agg(F.round(F.avg("y"), 6).alias("mean_y"))


@query("h11_corr", with_base("select split, round(corr(n2, n5), 6) as r25, round(corr(n4, n5), 6) as r45 from base group by split"))
def h11(spark, sf):
    return fx.base(spark, sf).groupBy("split").agg(
        F.round(F.corr("n2", "n5"), 6).alias("r25"), F.round(F.corr("n4", "n5"), 6).alias("r45")
    )


@query(
    "h12_sd_min_max_unique",
    with_base(
        """select st, round(stddev_samp(n4), 4) as sd, min(n4) as low, max(n4) as high,
             count(distinct city) as n_city from base group by st"""
    ),
)
def h12(spark, sf):
    return fx.base(spark, sf).groupBy("st").agg(
        F.round(F.stddev_samp("n4"), 4).alias("sd"), F.min("n4").alias("low"), F.max("n4").alias("high"),
        F.countDistinct("city").alias("n_city"),
    )


@query(
    "h13_level_counts_of_list",
    with_scores(
        """select model, count(*) as picks from (select id, model from scores
             qualify row_number() over (partition by id order by score desc, model) = 1) group by model"""
    ),
)
def h13(spark, sf):
    picked = W.best_by(fx.scores(spark, sf), "score", "model", ["id"])
    return picked.groupBy("model").agg(F.count("*").alias("picks"))


@query("h14_shape", with_base("select count(*) as n_rows, cast(20 as bigint) as n_cols from base"))
def h14(spark, sf):
    return shape(fx.base(spark, sf))


# ---- ranks and ordered rows -------------------------------------------------------------

RANKED_SQL = """ranked as (select *, rank() over (partition by model order by score)
    + (count(*) over (partition by model, score) - 1) / cast(2 as double) as rank from scores)"""


@query("w1_rank_average", with_scores("select id, model, rank from ranked", RANKED_SQL))
def w1(spark, sf):
    return average_rank(fx.scores(spark, sf), "score", ["model"]).select("id", "model", "rank")


@query(
    "w2_rank_percentile",
    with_scores("select id, model, round(rank / count(*) over (partition by model), 8) as pct from ranked", RANKED_SQL),
)
def w2(spark, sf):
    out = average_rank(fx.scores(spark, sf), "score", ["model"], "pct", percentile=True)
    return out.select("id", "model", F.round("pct", 8).alias("pct"))


@query(
    "w3_top_k_by_rank",
    with_scores(
        "select id, model from ranked qualify count(*) over (partition by model) + 1 - rank <= 500",
        RANKED_SQL,
    ),
)
def w3(spark, sf):
    return W.top_by_rank(fx.scores(spark, sf), "score", 500, ["model"]).select("id", "model")


EVENT_P = "0.05::double + 0.9::double * (user_id % 100) / 100"


@query(
    "w4_running_mean_every",
    f"""select seq, round(total / seq, 6) as running_mean from (
          select row_number() over w as seq, sum(loss) over w as total from (
            select ts, event_id, -case when event_type = 'purchase' then ln({EVENT_P}) else ln(1 - ({EVENT_P})) end as loss
            from events) window w as (order by ts, event_id rows between unbounded preceding and current row))
        where seq % 1000 = 0""",
)
def w4(spark, sf):
    p = F.lit(0.05) + F.lit(0.9) * (F.col("user_id") % 100) / 100
    events = fx.table(spark, sf, "events").select(
        "ts", "event_id", p.alias("p"), (F.col("event_type") == "purchase").cast("int").alias("y")
    )
    out = W.running_mean(events, H.logloss_term(F.col("p"), F.col("y")), ["ts", "event_id"])
    return out.select("seq", F.round("running_mean", 6).alias("running_mean"))


@query(
    "w5_sort",
    with_scores("select id, model, round(score, 6) as score, row_number() over (order by model, score, id) as position from scores"),
)
def w5(spark, sf):
    # The place of a row in the sorted table: parts of the table in order, and rows in order inside a part.
    out = cut(W.sorted_rows(fx.scores(spark, sf), ["model", "score", "id"]))
    placed = out.withColumn("_at", F.monotonically_increasing_id())
    return positions(placed, ["_at"]).select("id", "model", F.round("score", 6).alias("score"), "position")


@query("w6_batch_rows", with_base("select id, cast(ceil(row_number() over (order by id) / cast(4000 as double)) as bigint) as batch from base"))
def w6(spark, sf):
    return W.row_batches(fx.base(spark, sf).select("id"), ["id"], 4000)


# ---- user functions -----------------------------------------------------------------------


@query(
    "u1_metric_over_columns",
    with_scores("select model as var, round(max(score) - min(score) + avg(score * score), 6) as value from scores group by model"),
)
def u1(spark, sf):
    out = H.aggregate_columns(fx.scores_wide(spark, sf), SUMMED, lambda c: F.max(c) - F.min(c) + F.avg(c * c))
    return out.select("var", F.round("value", 6).alias("value"))


TRIALS_SQL = "trials as (" + " union all ".join(
    f"select {i} as trial, round(auc, 6) as value from ("
    + auc_sql(f"(select y, round({a}::double * m1 + (1 - {a}::double) * m2, 12) as score from wide)", "")
    + ")"
    for i, a in enumerate((0.2, 0.5, 0.8), 1)
) + ")"


@query("u2_objective_search", with_scores("select trial, value from trials", TRIALS_SQL))
def u2(spark, sf):
    wide = fx.scores_wide(spark, sf)

    def objective(alpha):
        mixed = wide.select("y", F.round(B.weighted_score(["m1", "m2"], [alpha, 1 - alpha]), 12).alias("s"))
        return H.auc(mixed, "y", "s").first()[0]

    trials = search(spark, objective, [{"alpha": a} for a in (0.2, 0.5, 0.8)])
    return trials.select("trial", F.round("value", 6).alias("value"))


@query("u3_row_generator", with_base("select id, cast(y as double) as y, slot from hashed join base using (id)", HASHED_SQL))
def u3(spark, sf):
    rows = hashed_rows(fx.base(spark, sf), ["prio", "st", "state1", "lvl"], "id", "y", SLOTS, "md5")
    return rows.select("id", "y", F.explode("indices").alias("slot"))
