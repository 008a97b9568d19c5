"""Model fitting, search, online learning and dataset builds."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from strataforge.functions.metrics import auc
from strataforge.operators import ftrl
from strataforge.operators import models as M
from strataforge.operators.blend import weighted_score
from strataforge.operators.encode import standardize
from strataforge.operators.factors import score_factors, train_factors
from strataforge.operators.hashed import hash_features
from strataforge.operators.networks import fit_network
from strataforge.operators.selection import ridge_cv
from strataforge.operators.split import k_folds
from strataforge.operators.stacking import path_scores
from strataforge.operators.stumps import bagged_stumps
from strataforge.operators.trees import GrownForest, forest_cv_auc, random_forest, random_thresholds
from strataforge.plans import feature_build as V
from strataforge.plans import fixtures as fx
from strataforge.plans import tuning
from strataforge.plans.fixture_sql import DATES, auc_sql, bucket, with_base, with_scores
from strataforge.plans.hashed_learning import hashed_rows, learn_and_score
from strataforge.plans.registry import query
from strataforge.plans.registry.encode import HASHED_SQL, SLOTS, days_sql, rate_ctes
from strataforge.plans.registry.profile import SIGNAL_SQL
from strataforge.session import cut, fresh_path, spread
from strataforge.streaming import progressive

FEATURES = ["a", "n2", "n4", "zip"]


def _rows(spark, sf):
    """Train, holdout (fold 10) and test rows with planted signal."""
    a = (10 * F.substring("prio", 1, 1).cast("int") + F.col("zip") % 20).cast("double")
    rows = spread(fx.base(spark, sf).select("id", "y", "fold10", "split", a.alias("a"), "n2", "n4", "zip"))
    train = rows.where("split = 'train' and fold10 < 10")
    return train, rows.where("split = 'train' and fold10 = 10"), rows.where("split = 'test'")


@query("m1_gbm")
def m1(spark, sf):
    train, _, test = _rows(spark, sf)
    return M.fit(M.gbm(), train, FEATURES).score(test)


@query("m2_early_stopped_boosting")
def m2(spark, sf):
    train, valid, test = _rows(spark, sf)
    return M.fit_run(M.BOOST_CONFIGS["base"], train, valid, FEATURES).score(test)


@query("m3_rf_probability")
def m3(spark, sf):
    train, _, test = _rows(spark, sf)
    # A row without a label is an error here, not left out.
    train = train.withColumn("y", F.coalesce("y", F.raise_error(F.lit("labels must not be null")).cast("int")))
    return GrownForest(train, FEATURES, 250, random_forest(FEATURES, depth=10), bins=32).score(test)


@query("m4_rf_cv")
def m4(spark, sf):
    train, _, _ = _rows(spark, sf)
    folds = k_folds(train, "id", 5, "cv", ["y"], "fold5")
    return forest_cv_auc(folds, FEATURES, "fold5", 5, 800, random_forest(FEATURES, 2, min_split=5))


@query("m5_extra_trees")
def m5(spark, sf):
    train, _, test = _rows(spark, sf)
    return GrownForest(train, FEATURES, 1000, random_thresholds(FEATURES)).score(test)


@query("m6_adaboost")
def m6(spark, sf):
    train, _, test = _rows(spark, sf)
    soft = M.adaboost(train, FEATURES).score(test)
    hard = M.adaboost(train, FEATURES, rounds=125, rate=0.025, algorithm="SAMME").score(test)
    return soft.select(F.lit("SAMME.R").alias("kind"), "id", "score").union(
        hard.select(F.lit("SAMME").alias("kind"), "id", "score")
    )


@query("m7_bagging")
def m7(spark, sf):
    train, _, test = _rows(spark, sf)
    return bagged_stumps(train, FEATURES).score(test)


@query("m8_elastic_net_path")
def m8(spark, sf):
    out = path_scores(fx.scores(spark, sf), list(fx.SCORE_MODELS))
    return out.select("alpha", "id", "score")


RIDGED = ["a", "n4", "zip"]
RIDGE_SQL = (
    "long as (" + " union all ".join(
        f"select '{c}' as var, y, fold10, cast({c} as double) as x from sig" for c in RIDGED
    )
    + """), folds as (select distinct fold10 as f from sig),
    slopes as (select var, f, sign(covar_pop(x, y)) as s from long join folds on fold10 <> f group by var, f),
    lined as (select long.var, y, fold10, x * s as score from long join slopes on long.var = slopes.var and fold10 = f)"""
)


@query(
    "m9_ridge_cv",
    with_base("select var, fold10, round(auc, 6) as auc from (" + auc_sql("lined", "var, fold10") + ")", SIGNAL_SQL, RIDGE_SQL),
)
def m9(spark, sf):
    train, valid, _ = _rows(spark, sf)
    by = ridge_cv(train.union(valid), RIDGED, "y", "fold10")
    return by.select("var", "fold10", F.round("auc", 6).alias("auc"))


def _weight_sql(z: str, n: str) -> str:
    return f"case when abs({z}) <= 0 then 0 else -{z} / ((1 + sqrt({n})) / 0.005::double + 1) end"


FTRL_SQL = [
    "slots as (select id, slot from hashed union all select id, 0 from base)",
    """one as (select slot, sum(0.5::double - y) as z, count(*) * 0.25::double as n
         from slots join base using (id) where id % 2 = 0 group by slot)""",
    f"one_w as (select *, {_weight_sql('z', 'n')} as w from one)",
    """two_p as (select id, 1 / (1 + exp(-sum(coalesce(w, 0)))) - any_value(y) as g
         from slots join base using (id) left join one_w using (slot) where id % 2 = 1 group by id)""",
    "two as (select slot, sum(g) as g, sum(g * g) as g2 from slots join two_p using (id) group by slot)",
]


@query(
    "m10_ftrl_two_steps",
    with_base(
        """select slot, round(coalesce(z, 0) + coalesce(g, 0)
               - (sqrt(coalesce(n, 0) + coalesce(g2, 0)) - sqrt(coalesce(n, 0))) / 0.005::double * coalesce(w, 0), 5) as z,
             round(coalesce(n, 0) + coalesce(g2, 0), 5) as n
           from one_w full join two using (slot)""",
        HASHED_SQL, *FTRL_SQL,
    ),
)
def m10(spark, sf):
    rows = hashed_rows(fx.base(spark, sf), ["prio", "st", "state1", "lvl"], "id", "y", SLOTS, "md5")
    model = ftrl.empty_model(spark)
    model, _, _ = ftrl.update(rows.where("id % 2 = 0"), model)
    model, _, _ = ftrl.update(rows.where("id % 2 = 1"), model)
    bias = spark.createDataFrame([(0, *map(float, model.bias))], ftrl.WEIGHT_SCHEMA)
    return model.table.union(bias).select("slot", F.round("z", 5).alias("z"), F.round("n", 5).alias("n"))


@query("m10_ftrl_logistic")
def m10_train(spark, sf):
    rows = fx.base(spark, sf)
    return learn_and_score(
        rows.where("split = 'train'"), rows.where("split = 'test'"), ["prio", "st", "state1", "lvl"]
    )


RARE_SQL = "kept as (select slot from hashed group by slot having count(*) >= 140)"


@query(
    "m11_drop_rare_slots",
    with_base("select id, count(kept.slot) as n_slots from hashed left join kept using (slot) group by id", HASHED_SQL, RARE_SQL),
)
def m11_rare(spark, sf):
    cols = ["prio", "st", "state1", "lvl"]
    rows = hash_features(fx.base(spark, sf).select("id", *cols), cols, SLOTS, "md5").select("id", "indices")
    kept = M.drop_rare_slots(rows, "indices", 140)
    return kept.select("id", F.size("indices").cast("long").alias("n_slots"))


@query("m11_factorization_machine")
def m11(spark, sf):
    cols = ["prio", "st", "state1", "lvl"]
    rows = cut(hash_features(fx.base(spark, sf).select("id", "y", "split", *cols), cols).select("id", "y", "split", "indices"))
    model, _ = train_factors(rows.where("split = 'train'"))
    return score_factors(rows.where("split = 'test'"), model)


@query("m12_neural_net")
def m12(spark, sf):
    train, valid, test = _rows(spark, sf)
    both = train.unionByName(valid).unionByName(test)
    scaled = cut(standardize(both, FEATURES))
    model = fit_network(scaled.where("split = 'train'"), FEATURES)
    return model.score(scaled.where("split = 'test'"))


@query("m13_predict")
def m13(spark, sf):
    train, valid, test = _rows(spark, sf)
    models = {
        "forest": GrownForest(train, FEATURES, 250, random_forest(FEATURES)), "extra": GrownForest(train, FEATURES, 1000, random_thresholds(FEATURES))
    }
    return M.predict(models, valid.unionByName(test))


@query("m14_seed_bag")
def m14(spark, sf):
    train, _, test = _rows(spark, sf)
    run = lambda s: M.BoostConfig("search", s, 0.8, 2, 0.7, 0.7, 8, 1.0, 250, 20)
    return M.seed_bag(lambda s: lambda rows, held: M.fit_run(run(s), rows, held, FEATURES), train, test, FEATURES)


ALPHA_TRIALS = [{"alpha": a / 10} for a in range(0, 11)]


@query(
    "m15_param_search",
    with_scores(
        "select trial, round(value, 6) as value from trials qualify row_number() over (order by round(value, 9) desc, trial) = 1",
        "trials as (" + " union all ".join(
            f"select {i} as trial, auc as value from ("
            + auc_sql(f"(select y, round({p['alpha']}::double * m3 + {1 - p['alpha']}::double * m2, 12) as score from wide)", "")
            + ")"
            for i, p in enumerate(ALPHA_TRIALS, 1)
        ) + ")",
    ),
)
def m15(spark, sf):
    wide = cut(fx.scores_wide(spark, sf))

    def objective(alpha):
        mixed = wide.select("y", F.round(weighted_score(["m3", "m2"], [alpha, 1 - alpha]), 12).alias("s"))
        return round(auc(mixed, "y", "s").first()[0], 9)

    trials = cut(M.search(spark, objective, ALPHA_TRIALS))
    return M.best_trial(trials).select("trial", F.round("value", 6).alias("value"))


@query("m15_forest_search")
def m15_forest(spark, sf):
    train, _, _ = _rows(spark, sf)
    folds = cut(k_folds(train, "id", 5, "cv", ["y"], "fold5"))
    objective = tuning.forest_objective(folds, FEATURES, "fold5", 5)
    return tuning.maximize(spark, objective, M.SEARCH_BOXES["forest"][0], M.box_trials("forest"))


@query("m15_boost_search")
def m15_boost(spark, sf):
    train, _, _ = _rows(spark, sf)
    return tuning.maximize(spark, tuning.boost_objective(train, FEATURES), M.SEARCH_BOXES["boost"][0], M.box_trials("boost"))


@query("m15_ftrl_search")
def m15_ftrl(spark, sf):
    rows = cut(hashed_rows(fx.base(spark, sf).where("split = 'train'"), ["prio", "lvl"], "id", "y"))
    return tuning.maximize(spark, tuning.ftrl_objective(rows), M.SEARCH_BOXES["ftrl"][0], 5)


@query(
    "m16_balanced_weights",
    with_base("select id, round(count(*) over () / (2::double * count(*) over (partition by y)), 8) as weight from base"),
)
def m16(spark, sf):
    out = M.balanced_weights(fx.base(spark, sf).select("id", "y"), "y")
    return out.select("id", F.round("weight", 8).alias("weight"))


# ---- streaming ------------------------------------------------------------------------------


SLICES = 4


def _progress_sql() -> str:
    """The stream unrolled: per slice of time the score before the update, and the state after it."""
    bounds = ", ".join(f"quantile_cont(epoch(ts), {k / SLICES})" for k in range(1, SLICES))
    named = {"user_id": "user_id", "hour": "extract(hour from ts)", "size": "cast(floor(value / 20) as bigint)"}
    slots = " union all ".join(f"select event_id, 1 + {bucket(c + '_', e)} % {SLOTS - 1} as slot from events" for c, e in named.items())
    slice_of = " + ".join(f"cast(epoch(ts) >= b[{k}] as int)" for k in range(1, SLICES))
    ctes = [
        f"bounds as materialized (select [{bounds}] as b from events)",
        f"rows as materialized (select event_id, cast(event_type = 'purchase' as double) as y, {slice_of} as k from events, bounds)",
        f"slots as materialized ({slots} union all select event_id, 0 from events)",
        "state0 as (select cast(null as bigint) as slot, 0::double as z, 0::double as n where false)",
    ]
    for k in range(SLICES):
        ctes += [
            f"w{k} as materialized (select *, {_weight_sql('z', 'n')} as w from state{k})",
            f"""p{k} as materialized (select event_id, any_value(y) as y, 1 / (1 + exp(-greatest(least(sum(coalesce(w, 0)), 35), -35))) as p
                from slots join rows using (event_id) left join w{k} using (slot) where k = {k} group by event_id)""",
            f"g{k} as (select slot, sum(p - y) as g, sum((p - y) * (p - y)) as g2 from slots join p{k} using (event_id) group by slot)",
            f"""state{k + 1} as materialized (select slot, coalesce(z, 0) + coalesce(g, 0)
                - (sqrt(coalesce(n, 0) + coalesce(g2, 0)) - sqrt(coalesce(n, 0))) / 0.005::double * coalesce(w, 0) as z,
                coalesce(n, 0) + coalesce(g2, 0) as n from w{k} full join g{k} using (slot))""",
        ]
    losses = " union all ".join(
        f"select {k} as batch_id, count(*) as n_rows, sum(-case when y = 1 then ln(p) else ln(1 - p) end) as loss from p{k}" for k in range(SLICES)
    )
    return f"""with {', '.join(ctes)}, losses as ({losses})
      select cast(batch_id as bigint) as batch_id, cast(n_rows as bigint) as n_rows, round(loss / n_rows, 6) as batch_loss,
        round(sum(loss) over w / sum(n_rows) over w, 6) as mean_loss
      from losses window w as (order by batch_id)"""


@query("x1_progressive_validation", _progress_sql())
def x1(spark, sf):
    root = fresh_path(spark, "progress")
    events = fx.table(spark, sf, "events").withColumn("seconds", F.col("ts").cast("timestamp").cast("double"))
    learner = progressive.ProgressiveLearner(spark, root)

    def prepare(batch):
        rows = batch.withColumn("y", (F.col("event_type") == "purchase").cast("double")).withColumn("id", F.col("event_id"))
        rows = rows.withColumn("hour", F.hour("ts")).withColumn("size", F.floor(F.col("value") / 20))
        return hash_features(rows.select("id", "y", "user_id", "hour", "size"), ["user_id", "hour", "size"], SLOTS, "md5")

    # A slice of time arrives as any number of files; the stream then takes all that is new as one batch.
    shares = [k / SLICES for k in range(1, SLICES)]
    bounds = events.agg(F.percentile("seconds", shares).alias("b")).first()["b"]
    for low, high in zip([None, *bounds], [*bounds, None]):
        part = events.where(F.lit(True) if low is None else F.col("seconds") >= low)
        part = part.where(F.lit(True) if high is None else F.col("seconds") < high)
        part.drop("seconds").write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(events.drop("seconds").schema).parquet(f"{root}/in")
        progressive.start(stream, learner, prepare).awaitTermination()
    done = learner.progress()
    return done.select("batch_id", "n_rows", F.round("batch_loss", 6).alias("batch_loss"), F.round("mean_loss", 6).alias("mean_loss"))


# ---- dataset versions -------------------------------------------------------------------------


def _contest_codes(cols: list[str]) -> list[str]:
    return [
        f"t_{c} as (select level, cast(row_number() over (order by first_at) as int) as code from (select {c} as level, "
        f"min((case when split = 'train' then 0 else 1 end) * 1000000000000 + id) as first_at from base where {c} is not null group by 1))"
        for c in cols
    ]


@query(
    "v1_numeric_version",
    with_base(
        """select id as "ID", split, case when split = 'train' then y end as target, t_prio.code as "VAR_0005",
             t_state2.code as "VAR_0274", t_city.code as "VAR_0200",
             coalesce(n1, -1) as "VAR_1001", n2 as "VAR_1002" from base
           join t_prio on t_prio.level = prio join t_state2 on t_state2.level = state2 join t_city on t_city.level = city""",
        *_contest_codes(["prio", "state2", "city"]),
    ),
)
def v1(spark, sf):
    train, test, _ = fx.contest(spark, sf)
    out = V.numeric_version(train, test)
    return out.select("ID", "split", "target", "VAR_0005", "VAR_0274", "VAR_0200", "VAR_1001", "VAR_1002")


@query(
    "v5_clean_version",
    with_base(
        """select base.id as "ID", split, dense_rank() over (order by prio) as "facVAR0005code",
             cast(state1 = state2 as int) as samestate, cast(state2 = '' as int) as state2mis,
             case when count(*) over (partition by city) < 1000 then 'RARE' else city end as "facVAR0200",
             nof_dates as nofdates, initial_year as initialyear
           from base join summary on summary.id = base.id""",
        DATES, days_sql(["d1", "d2"]),
    ),
)
def v5(spark, sf):
    train, test, _ = fx.contest(spark, sf)
    out = V.clean_version(train, test)
    return out.select(
        "ID", "split", F.col("facVAR0005").cast("long").alias("facVAR0005code"), "samestate", "state2mis",
        "facVAR0200", "nofdates", "initialyear",
    )


def _rate_of(rows: str, level: str) -> str:
    """Subquery (id, rate) of one level expression over ``rows`` (id, y, split, fold10, ...)."""
    fold = "case when b.split = 'train' then b.fold10 else 0 end"
    return f"""(with leveled as (select id, y, split, fold10, {level} as lv from {rows}),
        {', '.join(rate_ctes('leveled', 'lv'))}
      select b.id, coalesce(r.rate, m.mean_y) as rate from leveled b
      left join rates r on r.level = b.lv and r.fold = {fold} join means m on m.fold = {fold})"""


def _version_sql(fac: str, plain: dict[str, str], rates: dict[str, str], more: dict[str, str], *ctes: str) -> str:
    """Plain columns of the level table plus a rounded rate per level expression."""
    joins = " ".join(f"join {_rate_of('fac', e)} r{i} on r{i}.id = fac.id" for i, e in enumerate(rates.values()))
    cols = [f'{e} as "{n}"' for n, e in plain.items()]
    cols += [f'round(r{i}.rate, 6) as "{n}"' for i, n in enumerate(rates)]
    at = {n: f"r{i}.rate" for i, n in enumerate(rates)}
    cols += [f'round({e.format(**at)}, 5) as "{n}"' for n, e in more.items()]
    return with_base(
        "select fac.id as \"ID\", split, case when split = 'train' then y end as target, "
        + ", ".join(cols) + f" from fac {joins}", *ctes, fac,
    )


def _shown(df, rounded=(), coarse=()):
    """Response rates rounded for the comparison."""
    return df.select(
        *[
            F.round(c, 6).alias(c) if c.endswith("dmp") or c in rounded
            else F.round(c, 5).alias(c) if c in coarse else F.col(c)
            for c in df.columns
        ]
    )


ENCODED_SQL = _version_sql(
    """fac as (select base.*, nof_dates, nof_unique_dates, duration_contact, nof_years, initial_year,
         case when zip % 2 = 0 then 'true' when zip % 5 = 0 then 'mis' else 'false' end as flag,
         case when state2 = '' then 'mis' else state2 end as place2,
         case when count(*) over (partition by city) < 1000 then 'RARE' else city end as town,
         case when zip % 7 <> 0 then concat('job', cast(zip % 4 as varchar)) else 'mis' end as job1,
         case when zip % 3 <> 0 then concat('job', cast(zip % 6 as varchar)) else 'mis' end as job2,
         cast(10 * cast(substr(prio, 1, 1) as int) + zip % 20 as double) as sig
       from base join summary using (id))""",
    {
        "VAR0212": "case when fac.id % 11 <> 0 then round(zip * 1000 / 1e9::double, 9) else -1 end",
        "VAR0241": "zip % 50",
        "VAR1001": "coalesce(n1, -1)",
        "VAR1002": "n2",
        "VAR1004": "n4",
        "VAR1009": "sig",
        "sum10091010": "sig + (2 * sig + fold10)",
        "nofdates": "nof_dates",
        "nofuniquedates": "nof_unique_dates",
        "durationcontact": "duration_contact",
        "nofyears": "nof_years",
        "state1mis": "0",
        "state2mis": "cast(place2 = 'mis' as int)",
        "bothstatemis": "0",
        "samestate": "cast(place2 = state1 as int)",
        "job1mis": "cast(job1 = 'mis' as int)",
        "job2mis": "cast(job2 = 'mis' as int)",
        "bothjobsmis": "cast(job1 = 'mis' and job2 = 'mis' as int)",
    },
    {
        "facVAR0008dmp": "flag",
        "facVAR0237dmp": "state1",
        "facVAR0274dmp": "place2",
        "facVAR0200dmp": "town",
        "facVAR0404dmp": "job1",
        "facVAR0493dmp": "job2",
        "facinitialyeardmp": "cast(initial_year as varchar)",
        "facVAR0005dmp": "prio",
        "facVAR0467dmp": "st",
        "facyearStatedmp": "concat(cast(initial_year as varchar), '_', state1)",
    },
    {},
    DATES, days_sql(["d1", "d2"]),
)


@query("v8_encoded_version", ENCODED_SQL)
def v8(spark, sf):
    train, test, folds = fx.contest(spark, sf)
    out = _shown(V.encoded_version(train, test, folds))
    return out.withColumn("VAR0212", F.round("VAR0212", 9))


# All factors of the table, in the order of its columns, and the two zips.
FACTORS = {"VAR0008": "f1", "VAR0005": "f2", "VAR0467": "f3", "VAR0237": "f4", "VAR0274": "f5", "VAR0200": "f6", "zipcode": "f7", "zipcode2": "f8"}
PAIRS = {f"bi{a}{b}": f"concat({x}, '_', {y})" for (a, x), (b, y) in combinations(FACTORS.items(), 2)}
INTERACTION_SQL = _version_sql(
    """fac as (select id, y, split, fold10, case when zip % 2 = 0 then 'true' when zip % 5 = 0 then 'mis' else 'false' end as f1,
         prio as f2, st as f3, state1 as f4, case when state2 = '' then 'mis' else state2 end as f5, city as f6,
         case when id % 11 <> 0 then cast(zip as varchar) else 'mis' end as f7, cast(zip % 50 as varchar) as f8 from base)""",
    {f"ct{n}": f"count(*) over (partition by {e})" for n, e in {**FACTORS, **PAIRS}.items()},
    {"zipcodedmp": "f7", "zipcode2dmp": "f8", **{f"{n}dmp": e for n, e in PAIRS.items()}},
    {},
)


@query("v8a_interaction_version", INTERACTION_SQL)
def v8a(spark, sf):
    train, test, folds = fx.contest(spark, sf)
    return _shown(V.interaction_version(train, test, folds))


YEARLY = {
    f"{p}VAR007{n}dmp": f"concat({e}, '_', t{n})"
    for p, e in {"zip2": "z", "state": "s", "disch": "d"}.items()
    for n in (3, 5)
}
PLACE_SQL = _version_sql(
    """fac as (select base.id, y, split, fold10, cast(zip % 50 as varchar) as z,
         case when state2 = '' then 'unk' else state2 end as s, st as d, substr(d1, 6, 2) as t3,
         coalesce(substr(d2, 6, 2), 'NA') as t5 from base join dates on base.id = dates.id)""",
    {},
    {**YEARLY, "statedischdmp": "concat(s, d)"},
    {f"zipstVAR007{n}": "{stateVAR007%ddmp} / {zip2VAR007%ddmp}" % (n, n) for n in (3, 5)},
    DATES,
)


@query("v8b_place_year_version", PLACE_SQL)
def v8b(spark, sf):
    train, test, folds = fx.contest(spark, sf)
    return _shown(V.place_year_version(train, test, folds), coarse=("zipstVAR0073", "zipstVAR0075"))


@query(
    "u4_model_table",
    with_base(
        """select id as "ID", split, case when split = 'train' then y end as target,
             cast(dense_rank() over (order by prio) - 1 as int) as facprio, n4 as facpriodmp, n2 as num from base"""
    ),
)
def u4(spark, sf):
    return V.model_table(_union(spark, sf)).select("ID", "split", "target", "facprio", "facpriodmp", "num")


def _union(spark, sf):
    rows = fx.base(spark, sf)
    y = F.when(F.col("split") == "train", F.col("y"))
    return rows.select(
        F.col("id").alias("ID"), "split", y.alias("target"), F.col("prio").alias("facprio"),
        F.col("n4").alias("facpriodmp"), F.col("n2").alias("num"),
    )


@query(
    "u4_scaled_model_table",
    with_base(
        """select id as "ID", split, case when split = 'train' then y end as target,
             round((f - avg(f) over ()) / stddev_pop(f) over (), 5) as facpriodmp,
             round((n - avg(n) over ()) / stddev_pop(n) over (), 5) as num from (
             select *, cast(cast(n4 as float) as double) as f, cast(cast(n2 as float) as double) as n from base)"""
    ),
)
def u4_scaled(spark, sf):
    out = V.scaled_model_table(_union(spark, sf))
    return out.select("ID", "split", "target", F.round("facpriodmp", 5).alias("facpriodmp"), F.round("num", 5).alias("num"))
