"""Codebooks and codes against plain Lloyd rounds in Python's own integers."""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from strataforge.llm import vector_codes as module
from strataforge.llm.vector_codes import Parts, _leaf_columns, assign, vector_codes


def by_hand(rows, parts=8, entries=16, rounds=6, scale=4096):
    kept = [(i, label, v) for i, label, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for d in {len(v) for *_, v in kept}:
        width = max(1, -(-d // parts))
        own = [
            (i, label, [math.floor(Fraction(x) * scale) for x in v] + [0] * (width * parts - d)) for i, label, v in kept if len(v) == d
        ]
        first = sorted(own, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
        cut = lambda v, j: v[j * width : (j + 1) * width]
        books = [[cut(v, j) for _, _, v in first] for j in range(parts)]
        off = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
        nearest = lambda v, j: min((off(cut(v, j), e), n) for n, e in enumerate(books[j]))
        for _ in range(rounds):
            new = []
            for j in range(parts):
                members = defaultdict(list)
                for _, _, v in own:
                    members[nearest(v, j)[1]].append(cut(v, j))
                new.append([[sum(c) // len(members[n]) for c in zip(*members[n])] if n in members else e for n, e in enumerate(books[j])])
            books = new
        digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
        for i, label, v in own:
            found = [nearest(v, j) for j in range(parts)]
            error = sum(e for e, _ in found)
            out.append([i, label, "".join(f"{n:02x}" for _, n in found), error, digest])
    total = defaultdict(int)
    for _, label, _, error, _ in out:
        total[label] += error
    top = 2**63 - 1
    return sorted(((i, label, c, min(e, top), min(total[label], top), g) for i, label, c, e, g in out), key=str)


def found(spark, rows, schema="vec_id long, label int, embedding array<double>", **options):
    df = spark.createDataFrame(rows, schema).repartition(3)
    got = vector_codes(df, **options)
    return sorted(((r["vec_id"], r["label"], r["code"], r["error"], r["label_error"], r["codebooks_sha256"]) for r in got.collect()), key=str)


@pytest.mark.parametrize("d,options", [(16, {}), (8, {"parts": 4, "entries": 5, "rounds": 3}), (11, {"parts": 3, "entries": 40, "scale": 64})])
def test_plain_rounds(spark, monkeypatch, d, options):
    monkeypatch.setattr(module, "BLOCK_ROWS", 64)
    monkeypatch.setattr(module, "LEAF", 4)
    rnd = np.random.default_rng(d)
    centres = rnd.standard_normal((9, d))
    x = centres[rnd.integers(0, 9, 400)] + rnd.standard_normal((400, d)) * rnd.choice([0.0, 0.01, 0.3], (400, 1))
    rows = [(int(i) * 3 % 397, int(rnd.integers(0, 4)) or None, v.tolist()) for i, v in enumerate(x)]
    assert found(spark, rows, **options) == by_hand(rows, **options)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, 1, None), (2, 1, [nan] * 8), (3, 1, [inf, 1.0]), (4, None, [None, 1.0]), (5, 2, []), (6, 2, [0.0] * 8), (7, None, [1.0] * 8),
        (7, None, [-1.0] * 8), (7, None, [-1.0] * 8), (None, 2, [0.5] * 8), (8, None, [1e300] * 8), (9, 3, [-1e-320] * 8), (10, 3, [1.5, -2.5]),
        (11, 3, [3e7] * 8), (12, 3, [1e15] * 16),
    ]
    assert found(spark, rows) == by_hand(rows)
    assert found(spark, []) == []
    assert found(spark, rows[:4]) == []
    clash = [(i, la, v, "x", 7) for i, la, v in rows]
    schema = "vec_id long, label int, embedding array<double>, code string, d int"
    assert found(spark, clash, schema) == by_hand(rows)


def test_whole_nodes_take_part():
    """Tight groups come in whole nodes, and a walk over the trees equals all distances."""
    rnd = np.random.default_rng(5)
    centres = rnd.integers(-4000, 4000, (16, 8))
    points = centres[rnd.integers(0, 16, 5000)] + rnd.integers(-20, 20, (5000, 8))
    tree = Parts.read(_leaf_columns(points), 8)
    got = assign(tree, centres)
    assert got.whole > 4000
    d = ((tree.points[:, None, :] - centres[None]) ** 2).sum(axis=2)
    assert (got.codes == d.argmin(axis=1)).all()
    assert (got.sums == [tree.points[got.codes == e].sum(axis=0) for e in range(16)]).all()
    assert (got.counts == np.bincount(got.codes, minlength=16)).all()
    wild = rnd.integers(-50, 50, (3000, 8))
    book = np.vstack([wild[:8], wild[:8]])  # equal entries: the lower index
    tree = Parts.read(_leaf_columns(wild), 8)
    assert (assign(tree, book).codes == ((tree.points[:, None, :] - book[None]) ** 2).sum(axis=2).argmin(axis=1)).all()


def test_bad_options(spark):
    df = spark.createDataFrame([(1, 1, [1.0])], "vec_id long, label int, embedding array<double>")
    for options in ({"entries": 300}, {"scale": 1000}):
        with pytest.raises(ValueError):
            vector_codes(df, **options)
