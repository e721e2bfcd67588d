"""Cross-validation from cross products against fits on the rows, and metrics of any kind of target."""

from dataclasses import replace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assayer.operators import linear, tuning
from assayer.operators.tuning import Recipe

COLS = ("a", "b", "c", "d")


def rows(n=240, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)) * [1, 10, 0.1, 3] + [0, 1e5, -3, 0]
    x[:, 3] = x[:, 0] + 0.05 * x[:, 3]
    y = 2 * x[:, 0] - 0.1 * x[:, 1] + 5 * x[:, 2] + rng.normal(size=n)
    return pd.DataFrame({"row_id": range(n), **dict(zip(COLS, x.T)), "y": y, "fold": rng.integers(0, 4, n)})


def scaled(train, test, how):
    low, spread = {"standard": (train.mean(), train.std(ddof=0)), "minmax": (train.min(), train.max() - train.min()), "maxabs": (0, train.abs().max()), None: (0, 1)}[how]
    return ((train - low) / spread).to_numpy(), ((test - low) / spread).to_numpy()


def plain(x, y, model, alpha, share=0.5):
    xc, yc, n = x - x.mean(axis=0), y - y.mean(), len(y)
    if model in ("ols", "ridge"):
        return np.linalg.solve(xc.T @ xc + (alpha if model == "ridge" else 0) * np.eye(x.shape[1]), xc.T @ yc)
    share = 1.0 if model == "lasso" else share
    w = np.zeros(x.shape[1])
    for _ in range(20_000):
        for j in range(len(w)):
            pull = xc[:, j] @ (yc - xc @ w + xc[:, j] * w[j]) / n
            w[j] = np.sign(pull) * max(abs(pull) - alpha * share, 0) / (xc[:, j] @ xc[:, j] / n + alpha * (1 - share))
    return w


@pytest.mark.parametrize("model", linear.MODELS)
def test_runs_equal_fits_on_the_rows(spark, model):
    pdf = rows()
    recipes = {f"{how}|{a}": Recipe(model, COLS, {} if model == "ols" else {"alpha": a}, scaler=how) for how in ("standard", "minmax") for a in (0.05, 0.4)}
    df = spark.createDataFrame(pdf).repartition(5)
    got = tuning.linear_runs(df, recipes, "y", 4)
    for name, r in recipes.items():
        for f in range(4):
            train, test = pdf[pdf.fold != f], pdf[pdf.fold == f]
            a, b = scaled(train[list(COLS)], test[list(COLS)], r.scaler)
            w = plain(a, train.y.to_numpy(), model, r.params.get("alpha", 0.0))
            error = test.y.to_numpy() - (train.y.mean() + (b - a.mean(axis=0)) @ w)
            run = got[name][f]
            assert run["n"] == len(test) and run["mse"] == pytest.approx(np.mean(error**2), rel=1e-5) and run["mae"] == pytest.approx(np.abs(error).mean(), rel=1e-5)
            assert "accuracy" not in run  # the target is no class


def test_errors_from_cross_products_and_one_scan(spark):
    pdf = rows(seed=1)
    found = linear.grams(spark.createDataFrame(pdf), list(COLS), "y", "fold")
    for f in range(4):
        (intercept, w), = linear.path(found.without(f), "ridge", [0.3], scaler="standard").values()
        test = pdf[pdf.fold == f]
        error = test.y - intercept - test[list(COLS)].to_numpy() @ w
        got = linear.errors(found.part([f]), intercept, w)
        assert got["mse"] == pytest.approx(float((error**2).mean()), rel=1e-6)
        assert got["r2"] == pytest.approx(1 - float((error**2).mean()) / test.y.var(ddof=0), rel=1e-6)


def test_compare_mixes_both_ways_and_matches_a_fit(spark):
    pdf = rows(120, 2)
    pdf["q"] = np.clip(pdf.y.rank(pct=True) * 5, 0, 4).astype(int)
    df = spark.createDataFrame(pdf)
    ridge = Recipe("ridge", COLS, {"alpha": 2.0}, scaler="standard")
    both = tuning.compare(df, {"fast": ridge, "rows": replace(ridge, fill="median")}, "q", k=4)
    assert set(both["fast"]) == set(both["rows"])
    for metric in both["fast"]:
        assert both["fast"][metric] == pytest.approx(both["rows"][metric], abs=2e-3), metric


def test_holes_constants_and_lone_folds(spark):
    pdf = rows(60, 3)
    pdf["k"] = 7.0
    df = spark.createDataFrame(pdf).withColumn("a", F.when(F.col("row_id") == 5, None).otherwise(F.col("a"))).withColumn("b", F.when(F.col("row_id") == 6, float("nan")).otherwise(F.col("b")))
    found = linear.grams(df, ["a", "b", "k"], "y")
    assert found.whole().n == 58
    for model in linear.MODELS:
        (_, w), = linear.path(found.whole(), model, [0.1], scaler="standard").values()
        assert w[2] == 0.0 and np.isfinite(w).all()
    none = linear.grams(df.limit(0), ["a"], "y")
    assert none.folds == []


def test_lasso_path_picks_and_shrinks(spark):
    pdf = rows(200, 4).drop(columns="fold")
    alpha, weights, summaries = tuning.lasso_path(spark.createDataFrame(pdf), list(COLS), "y", [10.0, 1.0, 0.1, 0.01, 0.001], k=4)
    assert alpha == min(summaries, key=lambda a: summaries[a]["mse"][0]) and set(weights) == set(COLS)
    assert summaries[10.0]["r2"][0] < 0.1 < summaries[alpha]["r2"][0]


def test_scores_of_whole_and_other_targets(spark):
    rng = np.random.default_rng(5)
    y, p = rng.integers(0, 100_000, 3000), rng.normal(size=3000)
    many = tuning.score(spark.createDataFrame(pd.DataFrame({"y": y, "prediction": y + p})), "y")
    i = {v: k for k, v in enumerate(np.unique(np.concatenate([y, np.clip(np.rint(y + p), y.min(), y.max())])))}
    a, b = np.array([i[v] for v in y]), np.array([i[v] for v in np.clip(np.rint(y + p), y.min(), y.max())])
    assert many["mse"] == pytest.approx((p**2).mean()) and many["accuracy"] == pytest.approx((a == b).mean())
    expected = ((a[:, None] - b[None, :]) ** 2.0).mean()
    assert many["qwk"] == pytest.approx(1 - ((a - b) ** 2.0).mean() / expected)
    real = tuning.score(spark.createDataFrame(pd.DataFrame({"y": y + 0.5, "prediction": y + p})), "y")
    assert set(real) == {"n", "mse", "rmse", "mae", "r2"}
    assert tuning.score(spark.createDataFrame([], "y double, prediction double"), "y")["n"] == 0
