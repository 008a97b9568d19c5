"""The tables of ``plans/fixtures.py`` as SQL text, for the oracle queries."""

from __future__ import annotations

from strataforge.plans.fixtures import SCORE_MODELS


def bucket(tag: str, *parts: str) -> str:
    text = ", ".join([f"'{tag}'", *[f"cast({p} as varchar)" for p in parts]])
    return f"cast(('0x' || substr(md5(concat({text})), 1, 8))::UBIGINT as bigint)"


BASE = f"""base as (
  select o_orderkey as id,
    cast({bucket('y', 'o_orderkey')} % 100
         < 10 + 10 * cast(substr(o_orderpriority, 1, 1) as int) + o_custkey % 20 as int) as y,
    cast({bucket('f', 'o_orderkey')} % 10 + 1 as int) as fold10,
    case when o_orderkey % 5 = 0 then 'test' else 'train' end as split,
    o_orderpriority as prio, o_orderstatus as st, n_name as state1,
    case when o_custkey % 9 = 0 then '' when o_custkey % 3 = 0 then n_name
         else concat('S', cast(o_custkey % 25 as varchar)) end as state2,
    concat('city', cast(cast(floor(sqrt(o_custkey)) as int) as varchar)) as city,
    concat(o_orderpriority, '_', cast(o_custkey % 20 as varchar)) as lvl,
    case when o_orderkey % 7 <> 0 then o_totalprice end as n1,
    o_totalprice * 2 + 1 as n2, -o_totalprice as n3, c_acctbal as n4,
    o_totalprice + c_acctbal as n5, 7 as n6, cast(null as double) as n7,
    o_totalprice * 2 + 1 as n8, cast(1 as double) as k, cast(o_custkey % 1000 as int) as zip
  from orders join customer on o_custkey = c_custkey
  join nation on c_nationkey = n_nationkey)"""


def _text(expr: str) -> str:
    return f"upper(strftime({expr}, '%d%b%y')) || ':00:00:00'"


DATES = f"""dates as (
  select o_orderkey as id,
    case when o_orderkey % 4 = 0 then '' else {_text("cast(o_orderdate as date)")} end as d1,
    case when o_orderkey % 6 <> 0 then {_text("cast(o_orderdate as date) + 400")} end as d2,
    case when o_orderkey % 2 = 0 then {_text("cast(o_orderdate as date)")} else '' end as d3,
    case when o_orderkey % 3 = 0 then 'xx' else {_text("cast(o_orderdate as date) - 9500")} end as d4
  from orders)"""


def _score(model: str) -> str:
    a, m = SCORE_MODELS[model]
    return f"cast({a} * y + {bucket(model, 'id')} % {m} as double) / cast({a + m} as double)"


WIDE = "wide as (select id, y, " + ", ".join(f"{_score(m)} as {m}" for m in SCORE_MODELS) + " from base)"
SCORES = "scores as (" + " union all ".join(
    f"select id, y, '{m}' as model, {m} as score from wide" for m in SCORE_MODELS
) + ")"


def with_base(body: str, *more: str) -> str:
    return "with " + ", ".join([BASE, *more]) + " " + body


def with_scores(body: str, *more: str) -> str:
    return "with " + ", ".join([BASE, WIDE, SCORES, *more]) + " " + body


def with_dates(body: str, *more: str) -> str:
    return "with " + ", ".join([DATES, *more]) + " " + body


def auc_sql(source: str, keys: str, label: str = "y", score: str = "score") -> str:
    """Select of (keys, auc) over ``source``; ``keys`` is a comma list or empty."""
    part = f"partition by {keys}" if keys else ""
    lead = f"{keys}, " if keys else ""
    tail = f" group by {keys}" if keys else ""
    return (
        f"select {lead}(sum(case when {label} = 1 then r else 0 end) "
        f"- sum({label}) * (sum({label}) + 1) / cast(2 as double)) "
        f"/ nullif(cast(sum({label}) as double) * (count(*) - sum({label})), 0) as auc from ("
        f"select *, rank() over ({part} order by {score}) "
        f"+ (count(*) over (partition by {lead}{score}) - 1) / cast(2 as double) as r from {source}) q{tail}"
    )
