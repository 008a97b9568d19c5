"""Registered queries: one per operator, each over whole tables, with its SQL twin."""

from __future__ import annotations

from importlib import import_module

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

MODULES = ["sources", "columns", "profile", "encode", "relate", "metrics", "split", "models", "ensemble"]


def query(name: str, sql: str | None = None):
    """Register ``f(spark, sf_dir) -> DataFrame`` under a name, with SQL giving the same rows."""

    def add(f):
        if name in QUERIES:
            raise ValueError(f"two queries named {name}")
        QUERIES[name] = f
        if sql is not None:
            ORACLES[name] = sql
        return f

    return add


def load() -> tuple[dict, dict[str, str]]:
    for m in MODULES:
        import_module(f"{__name__}.{m}")
    return dict(QUERIES), dict(ORACLES)
