"""Run registered queries against their SQL twins: python -m tests.checker [name prefix ...]"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, t + ".parquet")
        if os.path.exists(path):
            con.execute(f"create view {t} as select * from '{path}'")
    return con


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return 0.0 if v == 0 else v
    return v


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    rows = df.select(*[f"`{n}`" for n in names]).collect()
    return names, Counter(tuple(_plain(v) for v in r) for r in rows)


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    rel = con.sql(sql)
    names = rel.columns
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = rel.fetchall()
    return [names[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def types_match(df, con, sql: str) -> list[str]:
    """Columns whose type families differ between the two engines."""
    wide = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE"}
    rel = con.sql(sql)
    found = dict(zip(rel.columns, [str(t) for t in rel.types]))
    return [
        f"{n}: {t} / {found.get(n)}" for n, t in df.dtypes if wide.get(t, found.get(n)) != found.get(n)
    ]


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from strataforge.session import local_session

    sf_dir = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    con, oracles, bad = connect(sf_dir), oracle_sql(), 0
    for name, f in queries().items():
        if argv and not any(name.startswith(a) for a in argv):
            continue
        start = time.time()
        try:
            df = f(spark, sf_dir)
            names, got = spark_rows(df)
            took = time.time() - start
            note = f"{sum(got.values())} rows"
            if name in oracles:
                want_names, want = sql_rows(con, oracles[name])
                if names != want_names:
                    note, ok = f"columns {names} / {want_names}", False
                else:
                    ok = got == want
                    if not ok:
                        note += f" / {sum(want.values())}; only spark {list((got - want).items())[:3]}"
                        note += f"; only sql {list((want - got).items())[:3]}"
                    types = types_match(df, con, oracles[name])
                    if types:
                        note, ok = note + f" types {types}", False
            else:
                ok = sum(got.values()) > 0
                note += " (no sql)"
        except Exception as e:  # noqa: BLE001
            took, ok, note = time.time() - start, False, f"{type(e).__name__}: {str(e)[:600]}"
        bad += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {took:.1f}s {note}", flush=True)
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
