from __future__ import annotations

import dataclasses
import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strataforge.functions.metrics import auc
from strataforge.functions.moments import grouped_moments
from strataforge.operators import blend as B
from strataforge.operators import ftrl
from strataforge.operators import models as M
from strataforge.operators import selection as S
from strataforge.operators import stacking as K
from strataforge.operators import stumps
from strataforge.operators.split import with_samples
from strataforge.operators.stumps import bagged_stumps
from strataforge.plans import named_runs, tuning
from strataforge.streaming import progressive


def _auc(y, s):
    r = pd.Series(np.asarray(s)).rank().to_numpy()
    y = np.asarray(y)
    pos = y.sum()
    return (r[y == 1].sum() - pos * (pos + 1) / 2) / (pos * (len(y) - pos))


def _table(n=1200, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4))
    p = 1 / (1 + np.exp(-(1.5 * x[:, 0] - x[:, 1])))
    pdf = pd.DataFrame(x, columns=["a", "b", "c", "d"]).assign(id=np.arange(n), y=(rng.random(n) < p).astype(int))
    return pdf.assign(fold=pdf["id"] % 3 + 1)


FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data(spark):
    df = spark.createDataFrame(_table()).cache()
    return df.where("id < 900"), df.where("id >= 900")


def _holdout_auc(model, test):
    return auc(model.score_column(test), "y", "score").first()["auc"]


def test_models_find_the_planted_signal(data):
    train, test = data
    fits = [
        M.fit(M.gbm(10, 0.1, 3), train, FEATURES),
        M.fit(M.forest(20, 12, 5), train, FEATURES),
        M.extra_trees(train, FEATURES, 20),
        M.fit(M.neural_net(4, (6,), max_iter=40), train, FEATURES),
        M.adaboost(train, FEATURES, rounds=10, rate=0.5),
        M.adaboost(train, FEATURES, rounds=10, rate=0.5, algorithm="SAMME"),
        M.bagged(train, FEATURES, lambda r, c: M.adaboost(r, c, rounds=4, rate=0.5), bags=3, col_share=0.75),
    ]
    for model in fits:
        assert _holdout_auc(model, test) > 0.7


def test_same_seed_same_scores(data):
    train, test = data
    a, b = (M.fit(M.forest(5, 12, 4), train, FEATURES).score(test).orderBy("id").collect() for _ in range(2))
    assert a == b


def test_boosting_weights_follow_the_definition(spark):
    """SAMME on one column against the textbook update: pick the purest split, weigh by its error."""
    pdf = pd.DataFrame({"id": range(8), "x": [1.0, 2, 3, 4, 5, 6, 7, 8], "y": [0, 0, 1, 0, 1, 1, 0, 1]})
    model = M.adaboost(spark.createDataFrame(pdf), ["x"], rounds=3, rate=1.0, algorithm="SAMME")
    w, total = np.ones(8), np.zeros(8)
    for _, _, vote in model.history:
        best = None
        for cut_at in pdf["x"][:-1]:
            left = (pdf["x"] <= cut_at).to_numpy()
            sides = [(w[s].sum(), (w * pdf["y"])[s].sum()) for s in (left, ~left)]
            gini = round(sum(2 * p * (n - p) / n for n, p in sides) / w.sum(), 9)
            if best is None or gini < best[0]:
                best = (gini, np.where(left, *[1.0 if p / n > 0.5 else -1.0 for n, p in sides]))
        said = best[1]
        wrong = said != 2 * pdf["y"] - 1
        alpha = np.log((1 - (w * wrong).sum() / w.sum()) / ((w * wrong).sum() / w.sum()))
        assert vote == pytest.approx(alpha)
        w, total = w * np.exp(alpha * wrong), total + alpha * said
    votes = sum(v for _, _, v in model.history)
    want = 1 / (1 + np.exp(-2 * total / votes))
    got = model.score(spark.createDataFrame(pdf)).orderBy("id").toPandas()["score"]
    assert np.allclose(got, want)


def test_boosted_plan_does_not_grow(spark):
    pdf = _table(400)
    df = spark.createDataFrame(pdf)
    sizes = [
        len(M.adaboost(df, FEATURES, rounds=n, rate=0.3).score_column(df)._jdf.queryExecution().optimizedPlan().toString())
        for n in (5, 60)
    ]
    assert sizes[1] < 3 * sizes[0]


def test_missing_values_have_a_bin(spark):
    rows = [(i, None if i % 3 == 0 else float(i % 7), int(i % 3 == 0)) for i in range(90)]
    df = spark.createDataFrame(rows, "id int, x double, y int")
    got = M.adaboost(df, ["x"], rounds=3).score(df).toPandas()
    assert (got["score"][got["id"] % 3 == 0] > 0.5).all() and (got["score"][got["id"] % 3 > 0] < 0.5).all()


def test_bags_in_lockstep_equal_single_models(spark):
    """One job for all bags gives each bag what it would get alone."""
    df = spark.createDataFrame(_table(500))
    bag = bagged_stumps(df, FEATURES, bags=3, col_share=0.7, rounds=6, rate=0.4, seed=5)
    marked = with_samples(df.select("id", "y", *FEATURES), "id", 3, 0.9, None, "bag5_")
    for b, member in enumerate(bag.members, 1):
        names = [FEATURES[f] for f, _, _ in member.history]
        counts = [F.coalesce(F.array_contains("samples", b).cast("int"), F.lit(0))]
        rng = random.Random(5)
        subsets = [sorted(rng.sample(range(len(FEATURES)), max(1, round(len(FEATURES) * 0.7)))) for _ in range(3)]
        alone = stumps._lockstep(marked, FEATURES, "y", counts, [subsets[b - 1]], 6, 0.4, "SAMME.R", stumps.BINS)[0]
        assert alone.history == member.history and names
        assert all(np.allclose(x, y) for x, y in zip(alone.scores, member.scores))


def test_stacking_uses_complete_rows(spark):
    """A row that lacks a model's score is left out, and changes nothing for the others."""
    valid, full = _scores(), _scores()
    with_gap = _long(spark, valid).where(F.concat_ws("|", "id", "model") != f"3|{MODELS[0]}")
    without = _long(spark, valid).where("id <> 3")
    tests = _long(spark, full).drop("y")
    got, want = (sorted(map(tuple, K.stack_final(v, tests, MODELS).collect())) for v in (with_gap, without))
    assert got == want and len({t for _, t in got}) > 10
    with pytest.raises(ValueError, match="missing"):
        grouped_moments(spark.createDataFrame([(1, None, 1.0), (1, 2.0, 0.0)], "g int, x double, y double"), ["x", "y"], "g")


def test_ridge_on_offset_columns_and_a_fold_called_f(spark):
    pdf = _table(400)
    pdf["f"] = pdf["id"] % 4 + 1
    pdf["when"] = 1.7e12 + 1e3 * pdf["a"]
    got = S.ridge_cv(spark.createDataFrame(pdf), ["a", "when"], "y", "f").toPandas()
    a, when = (got[got["var"] == v].sort_values("f")["auc"].to_numpy() for v in ("a", "when"))
    assert len(a) == 4 and np.allclose(a, when, atol=1e-3)


def test_named_runs_keep_their_limits():
    boosting = M.boosting_of(M.BOOST_CONFIGS["run13"])
    assert (boosting.growth.max_depth, boosting.growth.step, boosting.growth.gamma) == (48, 0.5794087931, 0.882)
    assert (boosting.rounds, boosting.patience, boosting.colsample) == (5000, 50, 0.84567)


def test_deep_run_with_a_step_limit(data):
    train, test = data
    config = dataclasses.replace(M.BOOST_CONFIGS["run13"], eta=0.3, rounds=6)
    model = M.fit_run(config, train, test, FEATURES)
    assert _holdout_auc(model, test) == pytest.approx(max(v for _, v in model.history))
    assert abs(model.value).max() <= 0.3 * 0.5794087931 + 1e-12


def test_importances_of_all_samples(spark, data):
    train, _ = data
    for found in (
        S.forest_importance(train, FEATURES, times=4, share=0.4, trees=10),
        S.boosted_importance(train, FEATURES, times=4, share=0.4, rounds=5, depth=4),
    ):
        mean = {r["var"]: r["m"] for r in found.groupBy("var").agg(F.avg("importance").alias("m")).collect()}
        assert found.count() == 16 and found.select("rep").distinct().count() == 4
        assert max(mean, key=mean.get) in ("a", "b") and min(mean.values()) >= 0


def test_search_points_and_best_trial(spark):
    points = M.draw_params({"depth": (8, 3), "rate": (0.8, 0.1)}, 20, 4)
    assert all(3 <= p["depth"] <= 8 and isinstance(p["depth"], int) and 0.1 <= p["rate"] <= 0.8 for p in points)
    with pytest.raises(ValueError):
        M.draw_params({"x": (1, 1)}, 1)
    trials = M.search(spark, lambda x: -abs(x - 2), [{"x": 1}, {"x": 2}, {"x": 3}, {"x": 2}])
    assert M.best_trial(trials).first()["trial"] == 2


@pytest.mark.parametrize("name, trials", [("m15_forest_search", 30), ("m15_boost_search", 37)])
def test_searches_run_all_their_trials(spark, monkeypatch, name, trials):
    """A search visits every point of its box's plan, those to start with and those to add."""
    from strataforge.plans import tuning
    from strataforge.plans.registry import load, models

    rows = spark.createDataFrame([(i, i % 2) for i in range(20)], "id long, y int")
    monkeypatch.setattr(models, "_rows", lambda spark, sf: (rows, rows, rows))
    for maker in ("forest_objective", "boost_objective"):
        monkeypatch.setattr(tuning, maker, lambda *a: lambda **point: sum(point.values()))
    found = load()[0][name](spark, "none").collect()
    assert [r["trial"] for r in found] == list(range(1, trials + 1))
    assert len({r["params"] for r in found}) == trials


def test_points_boosted_beside_each_other_have_the_values_of_each_alone(spark):
    from strataforge.plans import tuning

    rows = [(i, int(i * 7919 % 100 < 20 + i % 50), float(i % 50), float(i * 31 % 17)) for i in range(300)]
    objective = tuning.boost_objective(spark.createDataFrame(rows, "id long, y int, a double, b double"), ["a", "b"])
    drawn = M.draw_params(M.SEARCH_BOXES["boost"][0], 2, 1)
    points = [p | {"n_estimators": 2, "max_depth": 1 + 4 * i, "min_child_weight": 1, "gamma": 0.0} for i, p in enumerate(drawn)]
    found = [r["value"] for r in M.search(spark, objective, points).collect()]
    assert found == [objective(**p) for p in points] and len(set(found)) == 2


def test_score_and_stack_keeps_no_forest_on_the_driver(spark, monkeypatch, tmp_path):
    from strataforge.operators import trees as T
    from strataforge.plans.registry import ensemble, load
    from strataforge.plans.score_and_stack import train_and_score

    rows = [(i, int(i * 7919 % 100 < 20 + i % 50), float(i % 50), float(i * 31 % 17), float(i % 7), float(i % 3)) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, y int, a double, n2 double, n4 double, zip double")
    parts = df.where("id % 3 = 0"), df.where("id % 3 = 1"), df.where("id % 3 = 2").drop("y")
    small = lambda t, v: T.GrownForest(t, ["a", "n2"], 4, T.random_forest(["a", "n2"]))
    want = {p: {r["id"]: r["score"] for r in T.fit_forest(parts[0], ["a", "n2"], 4, T.random_forest(["a", "n2"])).score(parts[k]).collect()} for k, p in ((1, "Valid"), (2, "Full"))}
    only = type("Only", (), {"score": lambda self, df, row_id: df.selectExpr(row_id, "a / 50 as score")})

    def none(*a):
        raise AssertionError("trees on the driver")

    monkeypatch.setattr(T.TreeEnsemble, "of", none)
    train_and_score(*parts, str(tmp_path), {"small": small, "only": lambda t, v: only()})
    read = lambda name: {int(r["ID"]): float(r["target"]) for r in spark.read.csv(f"{tmp_path}/{name}.csv", header=True).collect()}
    for p, scores in want.items():
        assert read(f"pred{p}_small") == pytest.approx(scores)
        assert read(f"pred{p}_only") == {i: rows[i][2] / 50 for i in scores}
    monkeypatch.setattr(ensemble, "_rows", lambda spark, sf: parts)
    monkeypatch.setattr(ensemble, "boosted_run", lambda config, features: small)
    assert load()[0]["score_and_stack"](spark, "none").count() == 100


def test_greedy_selection_against_numpy(spark):
    pdf = _table(300)
    got = S.greedy_forward(spark.createDataFrame(pdf).repartition(5), FEATURES, "y", "fold", 3, 0.1).collect()
    chosen = []
    for step in range(3):
        scores = {}
        for c in (c for c in FEATURES if c not in chosen):
            cols, aucs = [*chosen, c], []
            for f in (1, 2, 3):
                fit, held = pdf[pdf["fold"] != f], pdf[pdf["fold"] == f]
                x = fit[cols].to_numpy()
                z = (x - x.mean(0)) / x.std(0)
                beta = np.linalg.solve(z.T @ z / len(z) + 0.1 * np.eye(len(cols)), z.T @ (fit["y"] - fit["y"].mean()) / len(z))
                aucs.append(_auc(held["y"], held[cols].to_numpy() @ (beta / x.std(0))))
            scores[c] = np.mean(aucs)
        best = max(sorted(scores), key=lambda c: round(scores[c], 9))
        chosen.append(best)
        assert got[step]["var"] == best
        assert got[step]["mean_auc"] == pytest.approx(scores[best], abs=1e-8)


def _scores(n=700, seed=8):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.4).astype(int)
    out = {"id": np.arange(n), "y": y}
    for m, strength in {"m1": 0.2, "m2": 0.5, "m3": 0.35, "m4": 0.0}.items():
        out[m] = np.round(strength * y + rng.random(n), 2)
    return pd.DataFrame(out)


MODELS = ["m1", "m2", "m3", "m4"]


def test_hill_climb_against_numpy(spark):
    pdf = _scores()
    bags = [["m1", "m2", "m3"], ["m2", "m3", "m4"], ["m1", "m4", "m3"]]
    got = {r["model"]: r["picks"] for r in B.hill_climb(spark.createDataFrame(pdf), "y", MODELS, 2, 6, bags).collect()}
    want = dict.fromkeys(MODELS, 0)
    for bag in bags:
        single = {m: _auc(pdf["y"], pdf[m]) for m in bag}
        held = sorted(bag, key=lambda m: -single[m])[:2]
        for _ in range(6):
            tried = {m: _auc(pdf["y"], np.rint(1e12 * pdf[[*held, m]].mean(axis=1))) for m in bag}
            held.append(max(bag, key=lambda m: round(tried[m], 12)))
        for m in held:
            want[m] += 1
    assert got == want


def test_aucs_of_vectors_in_slices(spark, monkeypatch):
    """Values meet in slices as packed arrays; ties within and across blocks, missing cells and heavy values count as before."""
    monkeypatch.setattr(B, "BLOCK_ROWS", 170)
    pdf = _scores()
    pdf.loc[pdf["id"] % 50 == 3, "m2"] = None
    pdf["y"] = pdf["y"].astype("Int64")
    pdf.loc[pdf["id"] % 40 == 7, "y"] = None
    rows = [[None if pd.isna(v) else int(v) if i == 0 else float(v) for i, v in enumerate(r)] for r in pdf[["y", *MODELS]].itertuples(index=False)]
    wide = spark.createDataFrame(rows, "y long, m1 double, m2 double, m3 double, m4 double").repartition(3).cache()
    vectors = {3: [1.0, 0.0, 0.0, 0.0], 5: [0.3, 0.3, 0.2, 0.2], 9: [0.0, 0.0, 0.0, 0.0], 11: [1 / 3, 1 / 3, 0.0, 1 / 3]}
    got = B.auc_of_vectors(wide, "y", MODELS, vectors, slice_rows=60)
    whole = wide.where("m2 is not null")
    for v, w in vectors.items():
        score = sum((F.lit(x) * F.col(m) for x, m in zip(w, MODELS)), F.lit(0.0))
        want = auc(whole.select("y", B.rank_value(score).alias("s")), "y", "s").first()[0]
        assert got[v] == round(want, 12)
    assert B.auc_of_vectors(wide.where("y = 1"), "y", MODELS, {0: [1.0, 0.0, 0.0, 0.0]}) == {0: None}
    assert B.auc_of_vectors(wide.limit(0), "y", MODELS, {0: [1.0, 0.0, 0.0, 0.0]}) == {}


def test_simplex_weights(spark):
    pdf = _scores()
    rows = B.simplex_weights(spark.createDataFrame(pdf), "y", MODELS, restarts=3, rounds=4).collect()
    weights = {r["model"]: r["weight"] for r in rows}
    assert sum(weights.values()) == pytest.approx(1) and min(weights.values()) >= 0
    best = rows[0]["auc"]
    assert best >= _auc(pdf["y"], pdf[MODELS].mean(axis=1)) and best >= _auc(pdf["y"], pdf["m2"]) - 0.005
    assert weights["m4"] < weights["m2"]
    mixed = B.weighted_auc(spark.createDataFrame(pdf), "y", MODELS, [weights[m] for m in MODELS]).first()["auc"]
    assert mixed == pytest.approx(best, abs=1e-9)
    with pytest.raises(ValueError):
        B.weighted_score(MODELS, [1.0])


def _long(spark, pdf):
    return spark.createDataFrame(pdf.melt(["id", "y"], MODELS, "model", "score"))


def test_final_stack_against_numpy(spark):
    pdf = _scores()
    valid, full = pdf[pdf["id"] % 4 > 0], pdf[pdf["id"] % 4 == 0]
    got = K.stack_final(_long(spark, valid), _long(spark, full).drop("y"), MODELS).toPandas().sort_values("id")
    r, rf = valid[MODELS].rank(), full[MODELS].rank()
    w = np.sqrt(r.std(axis=1)).to_numpy()
    x, y = r.to_numpy(), valid["y"].to_numpy(float)
    mean, my = np.average(x, axis=0, weights=w), np.average(y, weights=w)
    sd = np.sqrt(np.average((x - mean) ** 2, axis=0, weights=w))
    z = (x - mean) / sd
    cov_y = (z * w[:, None]).T @ (y - my) / w.sum()
    lam = 1e-4 * np.abs(cov_y).max() / 1e-3
    beta = np.linalg.solve((z * w[:, None]).T @ z / w.sum() + lam * np.eye(4), cov_y) / sd
    want = pd.Series(rf.to_numpy() @ beta).rank() / len(rf)
    assert np.allclose(got["target"], want, atol=2 / len(rf))
    assert np.corrcoef(got["target"], want)[0, 1] > 0.9999


def test_stack_eval_layout(spark):
    rows = K.stack_eval(_long(spark, _scores()), MODELS, times=2, alphas=[0.0, 1.0]).collect()
    assert {(r["rep"], r["method"]) for r in rows} == {
        (rep, m) for rep in (1, 2) for m in ("alpha_0.00", "alpha_1.00", "mean", "mean_rank")
    }
    assert all(r["auc"] > 0.7 for r in rows)


# ---- the online learner ---------------------------------------------------------------------------


def _hashed(spark, n=40, slots=12, seed=4):
    rng = np.random.default_rng(seed)
    rows = [(i, [int(v) for v in rng.integers(1, slots, 3)], float(rng.random() < 0.4)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "id long, indices array<long>, y double")


def _per_row(rows, p, state=None):
    """One row at a time, as the method is defined."""
    z, n = state or ({}, {})
    losses = []

    def w(i):
        zi, ni = z.get(i, 0.0), n.get(i, 0.0)
        s = -1.0 if zi < 0 else 1.0
        return 0.0 if s * zi <= p.l1 else (s * p.l1 - zi) / ((p.beta + np.sqrt(ni)) / p.alpha + p.l2)

    for _, idx, y in rows:
        slots = [0, *idx]
        weights = {i: w(i) for i in slots}
        q = 1 / (1 + np.exp(-max(min(sum(weights[i] for i in slots), 35), -35)))
        losses.append(-np.log(q) if y == 1 else -np.log(1 - q))
        g = q - y
        for i in slots:
            old = n.get(i, 0.0)
            z[i] = z.get(i, 0.0) + g - (np.sqrt(old + g * g) - np.sqrt(old)) / p.alpha * weights[i]
            n[i] = old + g * g
    return z, n, losses


def test_single_row_batches_are_the_per_row_method(spark):
    rows, df = _hashed(spark, 4)
    rows = [(i, sorted(set(x)), y) for i, x, y in rows]
    p = ftrl.FtrlParams(0.1, 1.0, 0.01, 1.0)
    model = ftrl.empty_model(spark, p)
    total = 0.0
    for row in rows:
        one = spark.createDataFrame([row], "id long, indices array<long>, y double")
        model, loss, n = ftrl.update(one, model)
        total += loss
        assert n == 1
    z, n, losses = _per_row(rows, p)
    assert total == pytest.approx(sum(losses))
    assert model.bias == pytest.approx((z[0], n[0]))
    for r in model.table.collect():
        assert (r["z"], r["n"]) == pytest.approx((z[r["slot"]], n[r["slot"]]))


def test_learning_lowers_the_loss(spark):
    pdf = _table(600)
    df = spark.createDataFrame(pdf).select(
        "id", F.col("y").cast("double").alias("y"),
        F.array(F.when(F.col("a") > 0, 1).otherwise(2), F.when(F.col("b") > 0, 3).otherwise(4)).cast("array<long>").alias("indices"),
    )
    model, history = ftrl.train(df, ftrl.FtrlParams(alpha=0.1), epochs=2, batch_rows=-(-df.count() // 4))
    assert history[-1][2] < history[0][2] and history[-1][2] < 0.65
    scored = ftrl.score_rows(df, model, keep=["y"])
    assert scored.count() == 600 and auc(scored, "y", "p").first()["auc"] > 0.75


def test_rows_without_slots_get_the_intercept(spark):
    df = spark.createDataFrame([(1, [], 1.0), (2, [5], 0.0)], "id long, indices array<long>, y double")
    got = {r["id"]: r["p"] for r in ftrl.score_rows(df, ftrl.empty_model(spark)).collect()}
    assert got == {1: 0.5, 2: 0.5}


def test_replayed_stream_batch_changes_nothing(spark, tmp_path):
    _, df = _hashed(spark, 30)
    learner = progressive.ProgressiveLearner(spark, str(tmp_path / "state"))
    learner.step(df.where("id < 15"), 0, "id", "y", "indices")
    learner.step(df.where("id >= 15"), 1, "id", "y", "indices")
    first = [tuple(r) for r in learner.progress().orderBy("batch_id").collect()]
    weights = sorted(map(tuple, learner.model_after(1).table.collect()))
    learner.step(df.where("id >= 15"), 1, "id", "y", "indices")
    assert [tuple(r) for r in learner.progress().orderBy("batch_id").collect()] == first
    assert sorted(map(tuple, learner.model_after(1).table.collect())) == weights
    assert first[1][3] == pytest.approx((first[0][2] * 15 + first[1][2] * 15) / 30)


def test_stream_state_follows_the_batch(spark, tmp_path):
    """Changes hold the batch's slots only; whole tables in between and clean-up don't change the model."""
    _, df = _hashed(spark, 60)
    batches = [df.where(F.floor(F.col("id") / 10) == i) for i in range(6)]
    tables = []
    for compact in (2, 100):
        learner = progressive.ProgressiveLearner(spark, f"{tmp_path}/{compact}", compact=compact)
        for i, b in enumerate(batches):
            learner.step(b, i, "id", "y", "indices")
            if compact == 2 and i == 3:
                learner.step(b, i, "id", "y", "indices")
        tables.append(sorted(map(tuple, learner.model_after(5).table.collect())))
        written = {r["slot"] for r in spark.read.parquet(f"{tmp_path}/{compact}/changes/5").collect()}
        assert written == {s for r in batches[5].collect() for s in r["indices"]} | {0}
    assert tables[0] == tables[1]
    model = ftrl.empty_model(spark)
    for b in batches:
        model, _, _ = ftrl.update(b, model)
    assert sorted(map(tuple, model.table.collect())) == tables[0]
    assert sorted(os.listdir(f"{tmp_path}/2/changes")) == ["4", "5"]
    assert sorted(os.listdir(f"{tmp_path}/2/whole")) == ["3", "5"]


def test_stream_equals_batches(spark, tmp_path):
    _, df = _hashed(spark, 30)
    for i in range(3):
        df.where(F.floor(F.col("id") / 10) == i).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    learner = progressive.ProgressiveLearner(spark, f"{tmp_path}/state")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    progressive.start(stream, learner, lambda b: b).awaitTermination()
    assert [r["n_rows"] for r in learner.progress().orderBy("batch_id").collect()] == [10, 10, 10]
    assert learner.totals_after(2)[0] == 30


def test_rare_slots(spark):
    df = spark.createDataFrame([(1, [1, 2]), (2, [1]), (3, [3]), (4, [])], "id long, indices array<long>")
    got = {r["id"]: r["indices"] for r in M.drop_rare_slots(df, "indices", 2).collect()}
    assert got == {1: [1], 2: [1], 3: [], 4: []}


def test_named_runs_and_selected_versions(spark, data, tmp_path):
    train, test = data
    small = dataclasses.replace(M.BOOST_CONFIGS["base"], rounds=4, depth=3, eta=0.3, colsample=1.0, patience=2)
    model = named_runs.boosted_run(small, FEATURES)(train, test)
    assert 1 <= len(model.root) <= 4 and model.score(test).count() == test.count()
    assert set(named_runs.named_runs(["base", "run3"], {"v9_r5": FEATURES})) == {"base", "run3"}
    picks = spark.createDataFrame([("r1", "a"), ("r1", "b"), ("r2", "c"), ("r2", "gone")], "version string, var string")
    paths = named_runs.write_selected({"train": train, "test": test.drop("y")}, picks, str(tmp_path), ["id", "y"])
    assert len(paths) == 4
    assert spark.read.parquet(f"{tmp_path}/v10_r1/train").columns == ["id", "y", "a", "b"]
    assert spark.read.parquet(f"{tmp_path}/v10_r2/test").columns == ["id", "c"]


def test_best_point_is_fitted_for_every_seed(spark, data):
    train, test = data
    trials = M.search(spark, lambda trees: -abs(trees - 3), [{"trees": 2}, {"trees": 3}])
    made = []

    def make(seed, trees):
        made.append((seed, trees))
        return M.forest(trees, seed, 3)

    got = tuning.refit_best(trials, make, train, test, FEATURES, seeds=(1, 2))
    assert made == [(1, 3), (2, 3)] and got.count() == 2 * test.count()


def test_boosted_extra_trees_objective(spark, data):
    value = tuning.boosted_extra_objective(data[0], FEATURES, rounds=2)(n_estimators=3, min_samples_split=2)
    assert value > 0.7


def test_ties_do_not_depend_on_the_size_of_scores(spark):
    for scale in (1e-12, 1.0, 1e6):
        rows = [(0, 0.1 * scale), (1, 0.2 * scale), (0, 0.3 * scale), (1, (0.1 + 0.2) * scale)]
        df = spark.createDataFrame(rows, "y int, m double")
        assert B.weighted_auc(df, "y", ["m"], [1.0]).first()["auc"] == pytest.approx(0.625)


def test_a_round_of_stumps_works_on_blocks_of_cells(spark):
    from strataforge.operators import stumps

    rows = spark.range(3000).select((F.col("id") % 7).cast("double").alias("a"), (F.col("id") % 11).cast("double").alias("b"), (F.col("id") % 3 == 0).cast("int").alias("y"))
    edges = stumps.bin_edges(rows, ["a", "b"])
    cells = stumps._cells(rows, ["a", "b"], edges, "y", [F.lit(1), (F.col("a") > 3).cast("int")])
    assert cells.count() == 1  # 154 cells, before one row each
    state = np.random.default_rng(2).normal(size=(2, 2, max(map(len, edges)) + 2))
    found, table = stumps._weight_sums(cells, state), rows.toPandas()
    wanted = np.zeros_like(found)
    for m, counted in enumerate((np.ones(len(table)), table["a"] > 3)):
        places = [np.searchsorted(e, table[c], side="left") for c, e in zip("ab", edges)]
        weight = counted * np.exp(-(2 * table["y"] - 1) * (state[m, 0, places[0]] + state[m, 1, places[1]]))
        for f, p in enumerate(places):
            np.add.at(wanted[m, f], (p, table["y"]), weight)
    assert np.allclose(found, wanted, rtol=1e-12)


def test_stack_eval_ranks_a_split_in_one_place_as_in_slices(spark, monkeypatch):
    """Few values are ranked by a table, a split's fits in one group; both give what moving all rows gives."""
    rng = np.random.default_rng(8)
    rows = []
    for i in range(240):
        y = int(rng.random() < 0.4)
        # An id twice with both labels, one without an id, one without a score.
        for key, label in [(i, y), (i, 1 - y)] if i == 7 else [(None if i == 9 else i, y)]:
            rows += [(key, m, float(rng.integers(0, 6) + label), label) for m in MODELS if i != 11 or m != MODELS[0]]
    long = spark.createDataFrame(rows, "id long, model string, score double, y int")
    ask = lambda: {(r["rep"], r["method"]): r["auc"] for r in K.stack_eval(long, MODELS, times=2, alphas=[0.0, 0.5, 1.0]).collect()}
    moved = []
    ranks = K.average_rank
    monkeypatch.setattr(K, "average_rank", lambda *a, **k: moved.append(1) or ranks(*a, **k))
    monkeypatch.setattr(K, "ROWS_A_VALUE", 1)
    short = ask()
    assert not moved
    monkeypatch.setattr(K, "VALUE_ROWS", 0)
    monkeypatch.setattr(K, "HELD_ROWS", 0)
    whole = ask()
    assert len(moved) == 2 and len(short) == 10 and short == whole
