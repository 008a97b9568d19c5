"""Encodings, response rates, hashing and dates."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from strataforge.operators import dates as D
from strataforge.operators import encode as E
from strataforge.operators.columns import casted, columns_like, drop_columns, recode_blanks
from strataforge.operators.hashed import hash_features
from strataforge.operators.response_rate import encode_response_rate, fit_profile, fitting_sums, level_sums
from strataforge.plans import fixtures as fx
from strataforge.plans.fixture_sql import DATES, bucket, with_base, with_dates
from strataforge.plans.registry import query

def is_train() -> Column:
    return F.col("split") == "train"


def _base(spark, sf, *cols):
    return fx.base(spark, sf).select(*cols)


# ---- level codes ----------------------------------------------------------------------


def _coded(cols: list[str], number: str, suffix: str) -> str:
    """Select attaching a numbering of levels to each column."""
    ctes, joins, outs = [], [], []
    for c in cols:
        ctes.append(f"t_{c} as ({number.format(c=c)})")
        joins.append(f"join t_{c} on t_{c}.level = base.{c}")
        outs.append(f"t_{c}.code as {c}{suffix}")
    return with_base(f"select id, {', '.join(outs)} from base {' '.join(joins)}", *ctes)


FIRST_SEEN = """select level, cast(row_number() over (order by first_at) as int) as code from (
    select {c} as level, min((case when split = 'train' then 0 else 1 end) * 1000000000000 + id) as first_at
    from base group by 1)"""
SORTED = """select level, cast(row_number() over (order by level) as int) as code from (
    select distinct {c} as level from base)"""
SORTED_ZERO = SORTED.replace("row_number() over (order by level)", "row_number() over (order by level) - 1")


@query("e1_encode_first_seen", _coded(["prio", "city", "state2"], FIRST_SEEN, "_seen"))
def e1(spark, sf):
    df = _base(spark, sf, "id", "prio", "city", "state2", F.when(is_train(), 0).otherwise(1).alias("part"))
    out = E.encode_first_seen(df, ["prio", "city", "state2"], ["part", "id"])
    return out.select("id", "prio_seen", "city_seen", "state2_seen")


@query("e2_encode_sorted", _coded(["prio", "city", "state2"], SORTED, "_code"))
def e2(spark, sf):
    out = E.encode_sorted(_base(spark, sf, "id", "prio", "city", "state2"), ["prio", "city", "state2"])
    return out.select("id", "prio_code", "city_code", "state2_code")


@query("e3_label_encode", _coded(["prio", "city"], SORTED_ZERO, "_label"))
def e3(spark, sf):
    out = E.label_encode(_base(spark, sf, "id", "prio", "city"), ["prio", "city"])
    return out.select("id", "prio_label", "city_label")


COUNTED = ["prio", "st", "state1", "state2", "city"]


@query(
    "e4_count_encode",
    with_base(
        "select id, " + ", ".join(f"count(*) over (partition by {c}) as ct{c}" for c in COUNTED) + " from base"
    ),
)
def e4(spark, sf):
    out = E.count_encode(_base(spark, sf, "id", *COUNTED), COUNTED)
    return out.select("id", *[f"ct{c}" for c in COUNTED])


@query(
    "e5_collapse_rare",
    with_base("select id, case when count(*) over (partition by city) < 500 then 'RARE' else city end as city from base"),
)
def e5(spark, sf):
    return E.collapse_rare(_base(spark, sf, "id", "city"), "city", 500)


@query(
    "e6_missing_flags",
    with_base(
        """select id, cast(state1 = state2 as int) as same_state, cast(state1 = 'mis' as int) as state1_mis,
             cast(state2 = '' as int) as state2_mis, cast(state1 = 'mis' and state2 = '' as int) as both_state_mis
           from base"""
    ),
)
def e6(spark, sf):
    df = recode_blanks(_base(spark, sf, "id", "state1", "state2"), ["state1", "state2"], "mis", ("", "-1"))
    names = ("state1_mis", "state2_mis", "both_state_mis")
    return E.missing_flags(df, "state1", "state2", names, "same_state").drop("state1", "state2")


@query(
    "e7_interactions_all",
    with_base(
        """select id, concat(prio, '_', st) as bi_prio_st, concat(prio, '_', f) as bi_prio_f,
             concat(st, '_', f) as bi_st_f from (
             select *, case when fold10 = 2 then 'NA' else cast(fold10 as varchar) end as f from base)"""
    ),
)
def e7(spark, sf):
    sometimes = F.when(F.col("fold10") != 2, F.col("fold10")).alias("f")
    df = E.interactions(_base(spark, sf, "id", "prio", "st", sometimes), ["prio", "st", "f"])
    return df.drop("prio", "st", "f")


@query(
    "e8_interactions_targeted",
    with_base(
        """select base.id, concat(cast(zip as varchar), '_', substr(d1, 6, 2)) as zip2d1,
        concat(cast(zip as varchar), '_', coalesce(substr(d2, 6, 2), 'NA')) as zip2d2,
        concat(state1, '_', substr(d1, 6, 2)) as stated1,
        concat(state1, '_', coalesce(substr(d2, 6, 2), 'NA')) as stated2,
        concat(state1, prio) as state_prio
      from base join dates on base.id = dates.id""",
        DATES,
    ),
)
def e8(spark, sf):
    years = fx.dates(spark, sf).select("id", *[D.year_text(F.col(c)).alias(c) for c in ("d1", "d2")])
    df = _base(spark, sf, "id", "zip", "state1", "prio").join(years, "id")
    df = E.interactions_with(df, "zip", ["d1", "d2"], "zip2")
    df = E.interactions_with(df, "state1", ["d1", "d2"], "state")
    df = E.paste_columns(df, ["state1", "prio"], "state_prio", sep="")
    return df.select("id", "zip2d1", "zip2d2", "stated1", "stated2", "state_prio")


# ---- response rates -------------------------------------------------------------------

DEVIANCE = """select fold, k, ratio, mu,
    round(N * ln(2 * pi() * greatest(SS - 2 * mu * S + N * mu * mu - (c2 - 2 * mu * c1 + mu * mu * c0),
                                     1e-12::double * N) / N) + ldet + N, 6) as dev
  from (select *, a / b as mu from (
    select fold, k, ratio, cast(sum(m * n) as double) as N, cast(sum(s1) as double) as S,
      cast(sum(q) as double) as SS, sum(s1 / (1 + n * ratio)) as a, sum(m * n / (1 + n * ratio)) as b,
      sum(ratio / (1 + n * ratio) * s2) as c2, sum(ratio / (1 + n * ratio) * n * s1) as c1,
      sum(ratio / (1 + n * ratio) * n * n * m) as c0, sum(m * ln(1 + n * ratio)) as ldet
    from {source} group by fold, k, ratio))"""


def rate_ctes(rows: str, level: str, k: int = 10) -> list[str]:
    """Tables up to ``rates`` (level, fold, n, rate, ratio) for one column; fold 0 is the full fit."""
    return [
        f"tr as (select {level} as level, y, fold10 from {rows} where split = 'train')",
        "tot as (select level, count(*) as n, sum(y) as s, sum(y * y) as q from tr group by level)",
        "part as (select level, fold10, count(*) as n, sum(y) as s, sum(y * y) as q from tr group by 1, 2)",
        f"folds as (select cast(unnest(range(0, {k + 1})) as int) as fold)",
        """fits as (select * from (select tot.level, fold, tot.n - coalesce(part.n, 0) as n,
             cast(tot.s - coalesce(part.s, 0) as double) as s, cast(tot.q - coalesce(part.q, 0) as double) as q
             from tot cross join folds left join part on part.level = tot.level and part.fold10 = fold)
             where n > 0)""",
        """prof as (select fold, n, cast(count(*) as double) as m, sum(s) as s1, sum(s * s) as s2, sum(q) as q
             from fits group by fold, n)""",
        """grid as (select 0 as k, cast(0 as double) as ratio union all
             select i, pow(10::double, -6::double + cast(0.05 as double) * i) from (select unnest(range(1, 161)) as i))""",
        "coarse as (" + DEVIANCE.format(source="(select * from prof cross join grid)") + ")",
        "top as (select fold, ratio from coarse qualify row_number() over (partition by fold order by dev, ratio) = 1)",
        """around as (select fold, i as k, case when ratio > 0 then ratio * pow(10::double, cast(0.0025 as double) * i)
             else 0 end as ratio from top cross join (select unnest(range(-20, 21)) as i) where ratio > 0 or i = 0)""",
        "fine as (" + DEVIANCE.format(source="(select prof.*, k, ratio from prof join around using (fold))") + ")",
        "best as (select fold, ratio, mu from fine qualify row_number() over (partition by fold order by dev, ratio) = 1)",
        """rates as (select level, fold, n, mu + ratio / (1 + n * ratio) * (s - n * mu) as rate, ratio
             from fits join best using (fold))""",
        "means as (select fold, avg(case when fold10 <> fold then y end) as mean_y from tr cross join folds group by fold)",
    ]


def rated(rows: str, level: str, where: str, more: list[str] | None = None) -> str:
    fold = "case when b.split = 'train' then b.fold10 else 0 end"
    return with_base(
        f"""select b.id, round(coalesce(r.rate, m.mean_y), 6) as rate from {rows} b
            left join rates r on r.level = b.{level} and r.fold = {fold}
            join means m on m.fold = {fold} where {where}""",
        *(more or []), *rate_ctes(rows, level),
    )


def _rates(df, col):
    out = encode_response_rate(df, [col], "y", "fold10", 10, is_train())
    return out.select("id", "split", F.round(col + "dmp", 6).alias("rate"))


@query("e9_target_encode_oof", rated("base", "lvl", "b.split = 'train'"))
def e9(spark, sf):
    return _rates(_base(spark, sf, "id", "y", "split", "fold10", "lvl"), "lvl").where(is_train()).drop("split")


@query("e10_target_encode_full", rated("base", "city", "b.split = 'test'"))
def e10(spark, sf):
    return _rates(_base(spark, sf, "id", "y", "split", "fold10", "city"), "city").where("split = 'test'").drop("split")


ODD_SQL = """odd as (select id, y, split, fold10, case when split = 'test' and zip % 4 = 0 then 'only_test'
    when fold10 = 4 and zip % 10 = 3 then 'only_fold4' else lvl end as lvl2 from base)"""


@query("e11_unseen_level_default", rated("odd", "lvl2", "b.lvl2 in ('only_test', 'only_fold4')", [ODD_SQL]))
def e11(spark, sf):
    zip_, fold = F.col("zip"), F.col("fold10")
    level = (
        F.when((F.col("split") == "test") & (zip_ % 4 == 0), "only_test")
        .when((fold == 4) & (zip_ % 10 == 3), "only_fold4")
        .otherwise(F.col("lvl"))
    )
    df = _base(spark, sf, "id", "y", "split", "fold10", level.alias("lvl2"))
    out = encode_response_rate(df, ["lvl2"], "y", "fold10", 10, is_train())
    return out.where(F.col("lvl2").isin("only_test", "only_fold4")).select(
        "id", F.round("lvl2dmp", 6).alias("rate")
    )


@query(
    "e9_fixed_ratio",
    with_base(
        """select b.id, round((select 0) + coalesce(f.mu + 0.02::double / (1 + f.n * 0.02::double) * (f.s - f.n * f.mu), m.mean_y), 6) as rate
           from base b left join (select fits.*, mu from fits join (
               select fold, sum(s / (1 + n * 0.02::double)) / sum(n / (1 + n * 0.02::double)) as mu from fits group by fold) g
               using (fold)) f on f.level = b.lvl and f.fold = b.fold10
           join means m on m.fold = b.fold10 where b.split = 'train'""",
        *rate_ctes("base", "lvl")[:5], rate_ctes("base", "lvl")[-1],
    ),
)
def e9_fixed(spark, sf):
    df = _base(spark, sf, "id", "y", "split", "fold10", "lvl").where(is_train())
    out = encode_response_rate(df, ["lvl"], "y", "fold10", 10, ratio=0.02)
    return out.select("id", F.round("lvldmp", 6).alias("rate"))


@query("e12_level_lookup", "select o_orderkey as id, c_mktsegment as segment, n_name as nation "
       "from orders join customer on o_custkey = c_custkey left join nation on n_nationkey = c_nationkey")
def e12(spark, sf):
    orders = fx.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("c_custkey"))
    customer = fx.table(spark, sf, "customer").select("c_custkey", "c_mktsegment", F.col("c_nationkey").alias("n_nationkey"))
    nation = fx.table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    out = E.level_lookup(E.level_lookup(orders, customer, ["c_custkey"]), nation, ["n_nationkey"])
    return out.select("id", F.col("c_mktsegment").alias("segment"), "nation")


@query("e13_drop_raw_factors", with_base("select id, y, n4, n4 as facpriodmp from base"))
def e13(spark, sf):
    df = _base(spark, sf, "id", "y", "n4", F.col("prio").alias("facprio"), F.col("n4").alias("facpriodmp"))
    return drop_columns(df, columns_like(df, "fac", "dmp"))


SLOTS = 1 << 24


def _slot(name: str) -> str:
    return f"1 + {bucket(name + '_', name)} % {SLOTS - 1}"


HASHED_SQL = "hashed as (" + " union all ".join(
    f"select id, {_slot(c)} as slot from base" for c in ("prio", "st", "state1", "lvl")
) + ")"


@query("e14_hash_features", with_base("select id, slot from hashed", HASHED_SQL))
def e14(spark, sf):
    df = hash_features(_base(spark, sf, "id", "prio", "st", "state1", "lvl"), ["prio", "st", "state1", "lvl"], SLOTS, "md5")
    return df.select("id", F.explode("indices").alias("slot"))


@query(
    "e15_hash_interactions",
    with_base(
        f"""select id, slot from hashed union all
            select a.id, 1 + {bucket('', 'a.slot', "'_'", 'b.slot')} % {SLOTS - 1}
            from placed a join placed b on a.id = b.id and a.r < b.r""",
        HASHED_SQL, "placed as (select *, row_number() over (partition by id order by slot) as r from hashed)",
    ),
)
def e15(spark, sf):
    cols = ["prio", "st", "state1", "lvl"]
    df = hash_features(_base(spark, sf, "id", *cols), cols, SLOTS, "md5", pairs=True)
    return df.select("id", F.explode("indices").alias("slot"))


@query(
    "e16_standardize",
    with_base(
        """select id, round((n2 - avg(n2) over ()) / stddev_pop(n2) over (), 6) as n2,
             round((n4 - avg(n4) over ()) / stddev_pop(n4) over (), 6) as n4, k - 1 as k from base"""
    ),
)
def e16(spark, sf):
    out = E.standardize(_base(spark, sf, "id", "n2", "n4", "k"), ["n2", "n4", "k"])
    return out.select("id", F.round("n2", 6).alias("n2"), F.round("n4", 6).alias("n4"), "k")


@query(
    "e17_bool_factor_clean",
    with_base("""select id, case when state2 = '' then 'mis' else state2 end as state2,
        case when fold10 = 2 then 'mis' else st end as flag from base"""),
)
def e17(spark, sf):
    df = _base(spark, sf, "id", "state2", F.when(F.col("fold10") != 2, F.col("st")).alias("flag"))
    return E.clean_flags(df, ["state2", "flag", "absent"])


@query("e18_trim_year", with_dates("select id, substr(d1, 6, 2) as d1, substr(d2, 6, 2) as d2 from dates"))
def e18(spark, sf):
    return fx.dates(spark, sf).select("id", *[D.year_text(F.col(c)).alias(c) for c in ("d1", "d2")])


YEARS = ("d1", "d2", "d3", "d4")


def days_sql(cols) -> str:
    """Tables ``days`` (id, d) and ``summary``, over the given date text columns."""
    rows = " union all ".join(
        f"""select id, case when cast(d as date) >= date '2069-01-01' then cast(d as date) - interval 100 year
              else cast(d as date) end as d from (select id, try_strptime(substr({c}, 1, 7), '%d%b%y') as d from dates)"""
        for c in cols
    )
    return f"""days as ({rows}), summary as (
      select id, cast(count(d) as int) as nof_dates, cast(count(distinct d) as int) as nof_unique_dates,
        cast(coalesce(min(year(d)), 0) as int) as initial_year, cast(coalesce(max(year(d)), 0) as int) as last_year,
        cast(coalesce(datediff('day', min(cast(d as date)), max(cast(d as date))), 0) as int) as duration_contact,
        cast(coalesce(max(year(d)) - min(year(d)), 0) as int) as nof_years from days group by id)"""


DAYS_SQL = days_sql(YEARS)


@query(
    "e19_year_as_level",
    with_dates(
        """select summary.id, concat(cast(initial_year as varchar), '_', o_orderpriority) as year_prio
           from summary join orders on o_orderkey = summary.id""",
        DAYS_SQL,
    ),
)
def e19(spark, sf):
    df = casted(D.date_summary(fx.dates(spark, sf), list(YEARS)), {"initial_year": "string"})
    prio = _base(spark, sf, "id", "prio")
    return E.paste_columns(df.join(prio, "id"), ["initial_year", "prio"], "year_prio").select("id", "year_prio")


@query(
    "e20_level_realign",
    with_base("select fold, count(*) as n_levels, cast(sum(n) as bigint) as n_rows from fits group by fold",
              ODD_SQL, *rate_ctes("odd", "lvl2")[:5]),
)
def e20(spark, sf):
    zip_, fold = F.col("zip"), F.col("fold10")
    level = (
        F.when((F.col("split") == "test") & (zip_ % 4 == 0), "only_test")
        .when((fold == 4) & (zip_ % 10 == 3), "only_fold4")
        .otherwise(F.col("lvl"))
    )
    df = fx.base(spark, sf).where(is_train()).select("y", "fold10", level.alias("lvl2"))
    profile = fit_profile(fitting_sums(level_sums(df, ["lvl2"], "y", "fold10")), 10)
    return profile.groupBy("fold").agg(
        F.sum("m").alias("n_levels"), F.sum(F.col("m") * F.col("n")).alias("n_rows")
    )


# ---- dates ----------------------------------------------------------------------------


def _day_sql(c: str) -> str:
    d = f"cast(try_strptime(substr({c}, 1, 7), '%d%b%y') as date)"
    return (
        f"strftime(case when {d} >= date '2069-01-01' then {d} - interval 100 year else {d} end, '%Y-%m-%d') as {c}"
    )


@query("t1_parse_ddmonyy", with_dates("select id, " + ", ".join(_day_sql(c) for c in ("d1", "d2", "d3")) + " from dates"))
def t1(spark, sf):
    days = [D.parse_ddmonyy(F.col(c)).cast("string").alias(c) for c in ("d1", "d2", "d3")]
    return fx.dates(spark, sf).select("id", *days)


@query("t2_year_pivot", with_dates(f"select id, {_day_sql('d4')} from dates"))
def t2(spark, sf):
    return fx.dates(spark, sf).select("id", D.parse_ddmonyy(F.col("d4")).cast("string").alias("d4"))


@query("t3_date_row_summary", with_dates("select * from summary", DAYS_SQL))
def t3(spark, sf):
    return D.date_summary(fx.dates(spark, sf), list(YEARS)).drop(*YEARS)


@query(
    "t4_drop_time_cols",
    with_dates("select id, nof_dates, nof_unique_dates, initial_year, duration_contact, nof_years from summary", DAYS_SQL),
)
def t4(spark, sf):
    return D.drop_date_columns(D.date_summary(fx.dates(spark, sf), list(YEARS)), list(YEARS))


@query("t5_run_date", "select strftime(current_date, '%Y%m%d') as run_date, count(*) as n from orders")
def t5(spark, sf):
    return fx.table(spark, sf, "orders").groupBy(D.run_date().alias("run_date")).agg(F.count("*").alias("n"))
