from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from strataforge.functions.moments import elastic_net_fit, elastic_net_path, grouped_moments, path_end, standardised
from strataforge.operators import correlation as R
from strataforge.operators import lincomb as L
from strataforge.operators.stacking import path_scores


def _table(n=900, seed=1):
    rng = np.random.default_rng(seed)
    a, b, c = rng.normal(size=(3, n))
    return pd.DataFrame(
        {"id": np.arange(n), "a": a, "b": b, "ab": a - 2 * b, "c": c, "k": 1.0, "zero": 0.0, "all": a + c - 3, "y": (a + rng.normal(size=n) > 0) * 1.0}
    )


COLS = ["a", "b", "ab", "c", "k", "zero", "all"]


@pytest.mark.parametrize("parts", [1, 5, 40])
def test_dependent_columns_for_any_number_of_tasks(spark, parts):
    df = spark.createDataFrame(_table()).repartition(parts)
    assert L.linear_combinations(df, COLS) == ["ab", "zero", "all"]
    factor = L.triangular_factor(df, COLS)
    x = _table()[COLS].to_numpy()
    assert np.allclose(factor.T @ factor, x.T @ x)


def test_windows_miss_what_lies_across_them(spark):
    df = spark.createDataFrame(_table()).repartition(3)
    assert L.windowed_linear_combinations(df, COLS, (2,), 2) == ["zero"]
    assert L.windowed_linear_combinations(df, COLS, (2, 7), 7) == ["ab", "zero", "all"]


def test_large_values_next_to_small_ones(spark):
    pdf = _table()
    pdf["p"] = 1e4 * np.exp(pdf["a"])
    pdf["n2"], pdf["n3"] = pdf["p"] * 2 + 1, -pdf["p"]
    df = spark.createDataFrame(pdf).repartition(4)
    # n3 alone is not a multiple of n2; with both, the constant is.
    assert L.linear_combinations(df, ["n2", "n3", "k"]) == ["k"]


def test_moments_and_fits(spark):
    pdf = _table()
    pdf["g"], pdf["w"] = pdf["id"] % 3, 0.5 + (pdf["id"] % 5)
    df = spark.createDataFrame(pdf).repartition(40)
    cols = ["a", "b", "c", "y"]
    got = grouped_moments(df, cols, "g", "w")
    for g, part in pdf.groupby("g"):
        x = np.column_stack([np.ones(len(part)), part[cols].to_numpy()])
        assert np.allclose(got[g].raw(), (x * part["w"].to_numpy()[:, None]).T @ x)
    total = sum(got.values())
    for alpha, lam in ((0.0, 0.05), (0.5, 0.05), (1.0, 0.02)):
        mine = elastic_net_fit(total, 4, alpha, lam)
        ready = VectorAssembler(inputCols=cols[:3], outputCol="x").transform(df)
        # Spark scales the target as well, which divides the L2 part by its deviation.
        fitted = LinearRegression(
            featuresCol="x", labelCol="y", weightCol="w", elasticNetParam=alpha, regParam=lam, tol=1e-12, maxIter=500
        ).fit(ready)
        if alpha == 1.0:
            assert np.allclose(mine[1:], fitted.coefficients.toArray(), atol=1e-3)
        assert np.sign(mine[1]) == np.sign(fitted.coefficients[0])
    assert np.allclose(elastic_net_fit(total, 4, 1.0, path_end(total, 4, 1.0, share=1.0) * 1.0001)[1:], 0, atol=1e-9)


def test_ridge_has_its_closed_form(spark):
    pdf = _table()
    pdf["one"] = 1
    m = grouped_moments(spark.createDataFrame(pdf), ["a", "b", "y"], "one")[1]
    lam = 0.3
    x = pdf[["a", "b"]].to_numpy()
    z = (x - x.mean(0)) / x.std(0)
    beta = np.linalg.solve(z.T @ z / len(z) + lam * np.eye(2), z.T @ (pdf["y"] - pdf["y"].mean()) / len(z))
    assert np.allclose(elastic_net_fit(m, 3, 0.0, lam)[1:], beta / x.std(0), atol=1e-8)


@pytest.mark.parametrize("alpha", [0.0, 0.3, 1.0])
def test_every_fit_of_a_path_is_optimal(spark, alpha):
    """Karush-Kuhn-Tucker: the pull on a column equals its penalty where it is used, and is within it elsewhere."""
    pdf = _table()
    pdf["one"] = 1
    m = grouped_moments(spark.createDataFrame(pdf), ["a", "b", "c", "y"], "one")[1]
    _, _, sd, corr, target = standardised(m, 4)
    path = elastic_net_path(m, 4, alpha)
    assert len(path) == 100 and path[-1][0] == pytest.approx(path_end(m, 4, alpha))
    assert all(a > b for (a, _), (b, _) in zip(path, path[1:]))
    for lam, fit in path[::11] + path[-1:]:
        beta = fit[1:] * sd
        pull = target - corr @ beta - lam * (1 - alpha) * beta
        assert np.allclose(pull[beta != 0], lam * alpha * np.sign(beta[beta != 0]), atol=1e-7)
        assert (np.abs(pull[beta == 0]) <= lam * alpha + 1e-7).all()


def test_scores_at_the_end_of_the_path(spark):
    """Ridge on weighted ranks by its closed form; repeated scores share ranks, an incomplete row is left out."""
    rnd = np.random.default_rng(4)
    pdf = pd.DataFrame({"id": range(90), "y": rnd.integers(0, 2, 90)})
    for k, name in enumerate(("p", "q", "r")):
        pdf[name] = np.round(pdf["y"] * (0.2 + 0.1 * k) + rnd.random(90), 2)
    long = pdf.melt(["id", "y"], var_name="model", value_name="score")
    df = spark.createDataFrame(long).unionByName(spark.createDataFrame([(999, 1, "p", 0.5)], "id long, y long, model string, score double"))
    got = path_scores(df, ["p", "q", "r"], [0.0, 1.0])
    ranks = pdf[["p", "q", "r"]].rank().to_numpy()
    w = np.sqrt(ranks.std(1, ddof=1))
    mean, mean_y = np.average(ranks, 0, w), np.average(pdf["y"], weights=w)
    sd = np.sqrt(np.average((ranks - mean) ** 2, 0, w))
    z, t = (ranks - mean) / sd, pdf["y"] - mean_y
    pull = (z * w[:, None]).T @ t / w.sum()
    lam = 1e-4 * np.abs(pull).max() / 1e-3
    beta = np.linalg.solve((z * w[:, None]).T @ z / w.sum() + lam * np.eye(3), pull)
    mine = {r["id"]: r["score"] for r in got.where("alpha = 0").collect()}
    assert sorted(mine) == list(range(90))
    assert np.allclose([mine[i] for i in range(90)], z @ beta + mean_y, atol=1e-8)
    assert got.where("alpha = 1").count() == 90


def test_correlated_pairs_and_information(spark):
    pdf = _table()
    pdf["a2"] = pdf["a"] * 2 + 0.01 * pdf["c"]
    pdf["fold"] = pdf["id"] % 5 + 1
    df = spark.createDataFrame(pdf)
    pairs = R.correlated_pairs(df, ["a", "b", "a2", "k"])
    assert [(r["ref_name"], r["dep_name"]) for r in pairs.collect()] == [("a2", "a")]
    worth = R.pair_information(df, pairs, "y", "fold").first()
    assert worth["xsum"] > 0.53 and worth["xdiff"] > 0.53
    out = R.add_informative_pairs(df, spark.createDataFrame([("a2", "a", 0.6, 0.4)], "ref_name string, dep_name string, xsum double, xdiff double"))
    assert "sumaa2" in out.columns and "diffaa2" not in out.columns
    nothing = R.correlated_pairs(df, ["a", "b"])
    assert nothing.count() == 0 and R.pair_information is not None
    negative = R.correlated_pairs(df.withColumn("m", -F.col("a")), ["a", "m"])
    assert R.columns_to_drop(negative) == ["m"] and R.columns_to_drop(negative, signed=True) == []
