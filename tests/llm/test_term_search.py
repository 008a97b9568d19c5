"""Top-k search against all inner products."""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pytest

from strataforge.llm import term_search as module
from strataforge.llm.term_search import top_k


def by_hand(rows, queries, k, scale=1024):
    whole = lambda v: [math.floor(Fraction(x) * scale) for x in v]
    fit = lambda r: r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])
    rows = [(i, whole(v)) for i, v in filter(fit, rows)]
    asked = {}
    for i, v in sorted(filter(fit, queries), reverse=True):
        asked[i] = whole(v)
    out = []
    for q, v in asked.items():
        scores = [(max(-(2**63), min(2**63 - 1, sum(a * b for a, b in zip(v, w)))), i) for i, w in rows if i != q]
        out += [(q, rank, i, s) for rank, (s, i) in enumerate(sorted(scores, key=lambda x: (-x[0], x[1]))[:k], 1)]
    return sorted(out)


def found(spark, rows, queries, schema="vec_id long, embedding array<double>", **options):
    vectors, asked = spark.createDataFrame(rows, schema).repartition(5), spark.createDataFrame(queries, schema)
    return sorted(map(tuple, top_k(vectors, asked, **options).collect()))


@pytest.mark.parametrize("dense", [1.0, 0.2])
@pytest.mark.parametrize("k", [1, 10, 500])
def test_all_products(spark, monkeypatch, dense, k):
    monkeypatch.setattr(module, "BLOCK_ROWS", 32)
    monkeypatch.setattr(module, "QUERY_ROWS", 7)
    monkeypatch.setattr(module, "STRIP_ROWS", 60)
    rnd = np.random.default_rng(k)
    x = np.round(rnd.standard_normal((300, 12)), 1) * (rnd.random((300, 12)) < dense)
    rows = [(int(i) % 280 * 5, [float(v) for v in r]) for i, r in enumerate(x)]  # some ids twice, many ties
    queries = [r for r in rows if r[0] % 100 == 0]
    assert found(spark, rows, queries, k=k) == by_hand(rows, queries, k)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 2.0]), (2, None), (3, [nan, 1.0]), (4, [inf, 1.0]), (5, [None, 1.0]), (6, []), (7, [0.0, 0.0]), (8, [1.0, 2.0, 3.0]),
        (9, [1.0]), (None, [9.0, 9.0]), (10, [1e300, -1e300]), (11, [5e8, -5e8]), (12, [-1e-300, 0.25]), (1, [1.0, 2.0]), (1, [-1.0, 2.0]),
    ]
    assert found(spark, rows, rows, k=4) == by_hand(rows, rows, 4)
    assert found(spark, rows, [], k=4) == [] and found(spark, [], rows, k=4) == []
    assert found(spark, rows[:1], rows[:1], k=4) == []
    clash = [(*r, 1, "s") for r in rows]
    assert found(spark, clash, clash, "vec_id long, embedding array<double>, score int, strip string", k=4) == by_hand(rows, rows, 4)


def test_equal_vectors(spark):
    """A third of the rows being one vector: ties go to the smallest ids."""
    rows = [(i, [1.0, 0.5] if i % 3 else [0.1, 0.1]) for i in range(3000)]
    queries = [(0, [1.0, 0.5]), (1, [1.0, 0.5])]
    got = found(spark, rows, queries, k=3)
    assert [(q, r, i) for q, r, i, _ in got] == [(0, 1, 1), (0, 2, 2), (0, 3, 4), (1, 1, 2), (1, 2, 4), (1, 3, 5)]
