"""Column names beside those that a table happens to have."""

from __future__ import annotations

from collections.abc import Iterable


def others(columns: Iterable[str], added: Iterable[str]) -> list[str]:
    """The columns whose names, without regard to case, are none of ``added``."""
    taken = {a.lower() for a in added}
    return [c for c in columns if c.lower() not in taken]


def unused(columns: Iterable[str], name: str) -> str:
    """``name``, with underscores added until no column is called so."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name
