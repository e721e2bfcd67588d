import json
import threading
import time
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assayer.operators import explain, iforest, models, neighbors, resample, tuning
from assayer.operators.tuning import Recipe
from assayer.plans import workflows
from assayer.sources import ledger, tables, views


def _brute(ids, x, k):
    order = np.argsort(ids)
    ids, x = ids[order], x[order]
    out = {}
    for i in range(len(ids)):
        d = np.zeros(len(ids))
        for j in range(x.shape[1]):
            d += (x[i, j] - x[:, j]) ** 2
        d[i] = np.inf
        out[ids[i]] = ids[np.argsort(d, kind="stable")[:k]].tolist()
    return out


@pytest.fixture(scope="module")
def crowd(spark):
    """A third of the rows are copies of one point, the rest a cloud with ties."""
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=(900, 3)), 1)
    x[:300] = x[0]
    pdf = pd.DataFrame(x, columns=["a", "b", "c"])
    pdf["row_id"] = rng.permutation(900)
    pdf["y"] = rng.choice([0, 1, 2], 900, p=[0.8, 0.15, 0.05])
    return pdf, spark.createDataFrame(pdf).cache()


@pytest.mark.parametrize("leaf_rows,block,bundle", [(10_000, 4096, 128), (60, 4096, 4), (60, 25, 128)])
def test_knn_join_is_exact_whatever_the_boxes(crowd, monkeypatch, leaf_rows, block, bundle):
    monkeypatch.setattr(neighbors, "BLOCK", block)
    monkeypatch.setattr(neighbors, "BUNDLE", bundle)
    pdf, df = crowd
    got = neighbors.knn_join(df, df, ["a", "b", "c"], 4, exclude_self=True, leaf_rows=leaf_rows).toPandas()
    near = got.sort_values(["row_id", "rank"]).groupby("row_id")["neighbor"].apply(list).to_dict()
    assert near == _brute(pdf["row_id"].to_numpy(), pdf[["a", "b", "c"]].to_numpy(), 4)


def test_knn_join_with_fewer_points_than_k(spark):
    df = spark.createDataFrame([(1, 0.0, "g"), (2, 1.0, "g"), (3, 5.0, "h")], "row_id int, x double, g string")
    got = neighbors.knn_join(df, df, ["x"], 5, by="g", exclude_self=True).collect()
    assert {(r["row_id"], r["neighbor"]) for r in got} == {(1, 2), (2, 1)}


def test_smote_balances_and_stays_on_segments(crowd):
    pdf, df = crowd
    made = resample.smote(df, "row_id", ["a", "b", "c"], "y", k=3).toPandas()
    assert made.groupby("y").size().nunique() == 1
    x, y = pdf.set_index("row_id")[["a", "b", "c"]], pdf.set_index("row_id")["y"]
    new = made[made["synthetic"]]
    base, other = x.loc[new["row_id"]].to_numpy(), x.loc[new["neighbor"].astype(int)].to_numpy()
    assert np.allclose(new[["a", "b", "c"]].to_numpy(), base + new[["gap"]].to_numpy() * (other - base))
    assert (y.loc[new["row_id"]].to_numpy() == new["y"].to_numpy()).all() and (y.loc[new["neighbor"].astype(int)].to_numpy() == new["y"].to_numpy()).all()
    assert new["gap"].between(0, 1).all()


def test_tomek_links_equal_brute_force(crowd):
    pdf, df = crowd
    near = {a: b[0] for a, b in _brute(pdf["row_id"].to_numpy(), pdf[["a", "b", "c"]].to_numpy(), 1).items()}
    y = dict(zip(pdf["row_id"], pdf["y"]))
    expected = {a for a, b in near.items() if near[b] == a and y[a] != y[b]}
    got = {r["row_id"] for r in resample.tomek_links(df, "row_id", ["a", "b", "c"], "y").collect()}
    assert got == expected and expected


def test_smote_tomek_falls_back_for_a_class_of_one(spark):
    df = spark.createDataFrame([(1, 0.0, 0), (2, 1.0, 0), (3, 5.0, 1)], "row_id int, x double, y int")
    out = resample.smote_tomek(df, "row_id", ["x"], "y")
    assert out.count() == 3 and out.filter("synthetic").count() == 0
    with pytest.raises(ValueError):
        resample.smote(df, "row_id", ["x"], "y")


def test_class_weights_sum_to_the_rows(crowd):
    _, df = crowd
    assert resample.with_class_weights(df, "y").agg(F.sum("weight")).first()[0] == pytest.approx(900)


def test_forest_ranks_planted_outliers_first(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 2))
    x[:6] = 12 + rng.normal(size=(6, 2))
    df = spark.createDataFrame(pd.DataFrame({"row_id": range(600), "a": x[:, 0], "b": x[:, 1]}))
    forest = iforest.iforest_fit(df, ["a", "b"], "row_id", trees=50, psi=64)
    scored = iforest.iforest_flag(df, forest, 0.01).toPandas()
    assert set(scored.nlargest(6, "score")["row_id"]) == set(range(6))
    assert scored["is_outlier"].sum() == 6
    assert len(forest["trees"]) == 50
    # Small samples per tree give a usable forest as well.
    small = iforest.iforest_fit(df, ["a", "b"], "row_id", trees=100, psi=16)
    again = iforest.iforest_score(df, small).toPandas()
    assert set(range(6)) <= set(again.nlargest(10, "score")["row_id"])


def test_weights_reach_every_classifier_and_unknown_parameters_raise(spark):
    for name in ("boost_classifier", "linear_svc", "rbf_svc", "logistic", "forest_classifier"):
        stage = models.estimator(name, weight="w")
        assert stage.getOrDefault("weightCol") == "w"
    assert json.loads(models.estimator("boost_regressor", {"min_samples_leaf": 7}).getOrDefault("settings"))["leaf_rows"] == 7
    with pytest.raises(ValueError, match="min_samples_splitt"):
        models.estimator("forest_regressor", {"min_samples_splitt": 2})


def test_classes_of_a_kernel_machine_are_fitted_by_turns_where_their_rows_are_many(spark):
    wanted = {"n_components": 50, "parallelism": 3}
    assert [models.estimator("rbf_svc", wanted, n).getParallelism() for n in (None, 1000, 1_000_000, 50_000_000)] == [3, 3, 1, 1]
    assert models.estimator("linear_svc", {"parallelism": 3}, 50_000_000).getParallelism() == 3


@pytest.mark.parametrize("held,most", [(1, 1), (2 * 60 * 1000, 2), (1 << 29, 6)])
def test_compared_fits_run_by_turns_where_their_rows_are_many(spark, monkeypatch, held, most):
    seen, now, lock = [], [0], threading.Lock()

    def fit(train, recipe, label, row_id, learned=None):
        with lock:
            now[0] += 1
            seen.append(now[0])
        time.sleep(0.2)
        with lock:
            now[0] -= 1
        return SimpleNamespace(transform=lambda df: df.withColumn("prediction", F.lit(1.0)))

    monkeypatch.setattr(tuning, "fit", fit)
    monkeypatch.setattr(models, "HELD", held)
    df = spark.createDataFrame([(i, float(i), i % 2) for i in range(60)], "row_id int, a double, y int")
    recipes = {str(t): Recipe("forest_classifier", ("a",), {"n_estimators": t}) for t in (220, 222)}
    found = tuning.compare(df, recipes, "y", k=3)
    assert set(found) == set(recipes) and len(seen) == 6 and max(seen) <= most


def test_index_column_is_found_by_its_order(spark):
    df = spark.createDataFrame([(i * 3, 10 - i, i) for i in range(10)], "number int, falling int, place int")
    assert tables.drop_index(df, order="place").columns == ["falling", "place"]
    assert tables.drop_index(df.select("falling", "place"), order="place").columns == ["falling", "place"]


def test_principal_axes_are_orthonormal(spark, sf):
    df = views.order_features(spark, sf)
    axes = models.principal_axes(df, views.ORDER_COLS, 3)
    assert axes["axes"].T @ axes["axes"] == pytest.approx(np.eye(3), abs=1e-9)
    flat = models.project(df, axes).agg(F.var_pop("pca_1").alias("v1"), F.corr("pca_1", "pca_2").alias("c")).first()
    assert flat["v1"] == pytest.approx(axes["explained"][0] * len(views.ORDER_COLS)) and abs(flat["c"]) < 1e-9


def test_scores_agree_with_direct_formulas(spark):
    rng = np.random.default_rng(9)
    y = rng.integers(1, 5, 200)
    p = np.clip(y + rng.normal(size=200), 1, 4)
    got = tuning.score(spark.createDataFrame(pd.DataFrame({"y": y, "prediction": p})), "y")
    c = np.rint(p)
    assert got["accuracy"] == pytest.approx((c == y).mean()) and got["mae"] == pytest.approx(np.abs(y - p).mean())
    o = np.zeros((4, 4))
    np.add.at(o, (y - 1, c.astype(int) - 1), 1)
    w = (np.arange(4)[:, None] - np.arange(4)[None, :]) ** 2
    assert got["qwk"] == pytest.approx(1 - (w * o).sum() / ((w * np.outer(o.sum(1), o.sum(0))).sum() / 200))


@pytest.fixture(scope="module")
def orders(spark, sf):
    return views.order_features(spark, sf).cache()


def test_cross_validation_uses_every_row_once(orders):
    runs = tuning.cross_validate(orders, Recipe("ols", ("sum_qty", "avg_disc")), "quality", k=3)
    assert sum(r["n"] for r in runs) == orders.count()
    assert all(r["r2"] > 0.5 for r in runs)


def test_classifier_predicts_original_labels(orders):
    model = tuning.fit(orders, Recipe("logistic", ("sum_qty", "min_qty"), {"max_iter": 5}, scaler="standard"), "quality")
    seen = {r[0] for r in model.transform(orders).select("prediction").distinct().collect()}
    assert seen <= set(float(c) for c in model.classes)


def test_elastic_net_minimises_the_usual_objective(spark):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(400, 3)) * [1.0, 2.0, 0.5]
    y = 4 * x[:, 0] - x[:, 1] + rng.normal(size=400) * 2
    df = spark.createDataFrame(pd.DataFrame({"row_id": range(400), "a": x[:, 0], "b": x[:, 1], "c": x[:, 2], "y": y}))
    got = tuning.fit(df, Recipe("elastic_net", ("a", "b", "c"), {"alpha": 0.7, "l1_ratio": 0.3}), "y").model.coefficients.toArray()
    xc, yc, w = x - x.mean(0), y - y.mean(), np.zeros(3)
    for _ in range(500):
        for j in range(3):
            rest = xc[:, j] @ (yc - xc @ w + xc[:, j] * w[j]) / 400
            w[j] = np.sign(rest) * max(abs(rest) - 0.7 * 0.3, 0) / (xc[:, j] @ xc[:, j] / 400 + 0.7 * 0.7)
    assert got == pytest.approx(w, abs=1e-4)


def test_search_is_seeded_and_elimination_is_a_permutation(orders):
    space = {"alpha": ("log", 0.1, 10.0), "scaler": ["standard", "minmax"], "n": ("int", 1, 3), "f": ("float", 0.0, 1.0)}
    assert tuning.draw(space, 5, 1) == tuning.draw(space, 5, 1) != tuning.draw(space, 5, 2)
    assert len(tuning.grid({"a": [1, 2], "b": [3, 4, 5]})) == 6
    ranks = tuning.rfe(orders, Recipe("ols", ("sum_qty", "avg_disc", "max_tax"), scaler="standard"), "quality")
    assert sorted(ranks.values()) == [1, 2, 3] and ranks["sum_qty"] == 1


def test_permutation_and_shapley_find_the_only_cause(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame({"row_id": range(300), "a": rng.normal(size=300), "b": rng.normal(size=300)})
    pdf["y"] = 3 * pdf["a"]
    df = spark.createDataFrame(pdf)

    def predict(d):
        return d.withColumn("prediction", 3 * F.col("a"))

    got = {r["feature"]: r["importance"] for r in explain.permutation_importance(predict, df, ["a", "b"], "y", repeats=2).collect()}
    assert got["b"] == pytest.approx(0.0, abs=1e-9) and got["a"] > 1
    shap = {r["feature"]: r["mean_abs_shap"] for r in explain.sampled_shapley(predict, df, ["a", "b"], permutations=2).collect()}
    assert shap["b"] == pytest.approx(0.0, abs=1e-9) and shap["a"] > 1


def test_fourier_features_approximate_the_kernel(spark):
    x = np.random.default_rng(0).normal(size=(30, 2))
    df = spark.createDataFrame(pd.DataFrame(x, columns=["a", "b"]))
    z = np.stack([r["features"].toArray() for r in models.fourier_features(df, ["a", "b"], 0.5, 4000).collect()])
    exact = np.exp(-0.5 * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - exact).max() < 0.15


def test_auto_optimize_returns_a_model(orders):
    found = workflows.auto_optimize(orders, ["sum_qty", "avg_disc", "min_qty"], "quality", {"ridge": {"alpha": [0.1, 1.0]}}, sizes=(2,), draws=1, folds=2, trees=3)
    assert len(found["features"]) == 2 and "prediction" in found["model"].transform(orders).columns


def test_pipeline_round_trip_and_ledger(spark, orders, tmp_path):
    train = orders.withColumn("label", F.col("quality").cast("double"))
    model = models.pipeline(["sum_qty", "avg_disc"], "ols").fit(train)
    models.save_pipeline(model, str(tmp_path / "m"))
    a, b = (m.transform(train).agg(F.sum("prediction")).first()[0] for m in (model, models.load_pipeline(str(tmp_path / "m"))))
    assert a == pytest.approx(b)
    path = str(tmp_path / "runs")
    ledger.log_run(spark, path, "exp", "first", {"k": 3}, {"rmse": 0.5}, {"sum_qty": 1.0})
    ledger.log_run(spark, path, "exp", "second", {"k": 4}, {"rmse": 0.4})
    board = ledger.leaderboard(ledger.run_metrics(ledger.read_runs(spark, path), ["rmse"]), "rmse").orderBy("rank").collect()
    assert [r["run_name"] for r in board] == ["second", "first"] and board[0]["gap_pct"] == pytest.approx(20.0)


def test_csv_sniffing_index_and_names(spark, tmp_path):
    (tmp_path / "t.csv").write_text('Unnamed: 0;"fixed, acidity";pH \n0;1.5;3.1\n1;2.5;3.2\n')
    path = str(tmp_path / "t.csv")
    assert tables.sniff_delimiter(spark, path) == ";"
    df = tables.normalise_names(tables.drop_index(tables.read_sniffed(spark, path)))
    assert df.columns == ["fixed,_acidity", "ph"] and df.count() == 2
    made = tables.synthetic_table(spark, 100)
    assert made.count() == 100 and made.filter("quality not between 3 and 9").count() == 0
    assert made.schema.names == tables.WINE_SCHEMA.names
    ordered = spark.range(1000).select("id", F.col("id").alias("i"), (F.col("id") % 10).alias("j"))
    assert tables.is_monotonic(ordered, "i", "id") and not tables.is_monotonic(ordered, "j", "id")


def test_rows_with_missing_coordinates_stay_without_neighbours(spark):
    rows = [(i, None if i % 10 == 0 else float("nan") if i % 10 == 1 else float(i), float(i)) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id int, x double, y double")
    got = {r["row_id"]: r["prediction"] for r in neighbors.knn_regress(df, df, ["x"], "y", 1).collect()}
    assert len(got) == 200
    assert all((v is None) == (i % 10 < 2) and v in (None, float(i)) for i, v in got.items())


def test_smote_reaches_the_size_with_missing_values_and_chunks(spark, monkeypatch):
    rows = [(i, float(i), "big") for i in range(60)] + [(100, 1.0, "few"), (101, 2.0, "few"), (102, None, "few")]
    df = spark.createDataFrame(rows, "row_id int, x double, y string")
    whole = resample.smote(df, "row_id", ["x"], "y").toPandas()
    assert (whole["y"] == "few").sum() == 60
    made = whole[whole["synthetic"]]
    assert made["x"].between(1, 2).all() and not made.duplicated(["row_id", "copy"]).any()
    repeated = resample.random_oversample(df, "row_id", "y").toPandas()
    monkeypatch.setattr(resample, "COPIES", 4)
    again = resample.smote(df, "row_id", ["x"], "y").toPandas()
    key = ["row_id", "copy"]
    pd.testing.assert_frame_equal(whole.sort_values(key).reset_index(drop=True), again.sort_values(key).reset_index(drop=True))
    chunked = resample.random_oversample(df, "row_id", "y").toPandas()
    pd.testing.assert_frame_equal(repeated.sort_values(key).reset_index(drop=True), chunked.sort_values(key).reset_index(drop=True))


def _clustered(rows, dims, inner, seed):
    """Vectors near a plane of ``inner`` dimensions, turned at random, with copies and a little noise."""
    rng = np.random.default_rng(seed)
    turn, _ = np.linalg.qr(rng.normal(size=(dims, dims)))
    x = np.zeros((rows, dims))
    x[:, :inner] = rng.normal(size=(rows, inner)) * 5 + rng.integers(0, 4, (rows, 1)) * 20
    x = (x + rng.normal(size=x.shape) * 0.01) @ turn
    x[rows // 2 : rows // 2 + 40] = x[0]
    return x


@pytest.mark.parametrize("inner", [3, 24])
def test_knn_join_in_many_dimensions_equals_brute_force(spark, monkeypatch, inner):
    monkeypatch.setattr(neighbors, "BLOCK", 300)
    x = _clustered(900, 24, inner, inner)
    cols = [f"d{i}" for i in range(24)]
    df = spark.createDataFrame(pd.DataFrame(x, columns=cols).assign(row_id=np.arange(900)))
    got = neighbors.knn_join(df, df, cols, 3, exclude_self=True, leaf_rows=100, carry=F.array("d0")).toPandas().sort_values(["row_id", "rank"])
    d2 = neighbors._distances(x, x)
    np.fill_diagonal(d2, np.inf)
    want = np.lexsort((np.broadcast_to(np.arange(900), d2.shape), d2), axis=1)[:, :3]
    assert (got["neighbor"].to_numpy().reshape(-1, 3) == want).all()
    assert np.allclose([c[0] for c in got["carry"]], x[got["neighbor"], 0])


def test_images_rule_out_most_pairs_and_lose_none():
    x = _clustered(2000, 64, 4, 1)
    image = neighbors.Image(x[::4])
    w = image.of(x)
    low, d2 = neighbors._distances(w, w), neighbors._distances(x, x)
    assert w.shape[1] == neighbors.AXES + 1 and (np.sqrt(low) <= np.sqrt(d2) + 1e-9).all()
    r, c = neighbors._candidates(x, w, np.full(2000, np.inf), x, w, 5, np.eye(2000, dtype=bool))
    assert len(r) < 0.05 * d2.size
    np.fill_diagonal(d2, np.inf)
    fifth = np.partition(d2, 4, axis=1)[:, 4]
    open_pairs = np.zeros(d2.shape, bool)
    open_pairs[r, c] = True
    assert open_pairs[d2 <= fifth[:, None]].all()


def test_knn_regress_with_a_pile_of_copies_and_missing_labels(spark):
    rows = [(i, 1.0, float(i) if i != 2 else None) for i in range(50)] + [(50, 9.0, 7.0)]
    df = spark.createDataFrame(rows, "row_id long, x double, y double")
    got = {r["row_id"]: r["prediction"] for r in neighbors.knn_regress(df, df, ["x"], "y", 3).collect()}
    assert got[0] == got[49] == 0.5  # ids 0, 1 and 2, the last without a label


def test_class_weights_do_not_gather_a_class_in_one_task(spark):
    rows = [(i, "a" if i % 10 else None) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id long, label string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = resample.with_class_weights(df, "label")
        plan = out._jdf.queryExecution().executedPlan().toString()
        found = {(r["label"], r["weight"]) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan
    assert out.count() == 200 and found == {("a", 200 / (2 * 180)), (None, 200 / (2 * 20))}


def test_few_pairs_of_unstructured_vectors_stay_open():
    """Images rule out next to nothing there; a matrix product leaves the nearest, and equal vectors and far limits lose none."""
    x = np.random.default_rng(3).normal(size=(1500, 40)) * 1e3 + 1e4
    x[700:720] = x[0]
    image = neighbors.Image(x[::2])
    d2 = neighbors._distances(x, x)
    far = np.where(np.arange(1500) % 2 == 0, np.inf, np.sort(d2, axis=1)[:, 3])
    r, c = neighbors._candidates(x, image.of(x), far, x, image.of(x), 5, np.eye(1500, dtype=bool))
    assert len(r) < 0.05 * 1500**2
    np.fill_diagonal(d2, np.inf)
    limit = np.minimum(np.partition(d2, 4, axis=1)[:, 4], far)
    assert set(zip(*np.nonzero(d2 <= limit[:, None]))) <= set(zip(r, c))


def test_flagged_rows_are_scored_once(spark):
    df = spark.createDataFrame([(i, float(i % 37), float(i % 11)) for i in range(400)], "row_id long, a double, b double")
    flagged = iforest.iforest_flag(df, iforest.iforest_fit(df, ["a", "b"], "row_id", trees=10, psi=64), 0.1)
    assert "EvalPython" not in flagged._jdf.queryExecution().optimizedPlan().toString()  # a reader does not score again
    assert flagged.count() == 400 and 0 < flagged.filter("is_outlier").count() <= 40


def test_recipes_of_one_table_share_fills_and_scalers(spark, monkeypatch):
    rng = np.random.default_rng(1)
    rows = [(i, float(rng.normal()), None if i % 7 == 0 else float(rng.normal()), float(i % 5)) for i in range(120)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, y double")
    recipes = {c: Recipe("ridge", ("a", "b"), {"alpha": c}, scaler="robust", fill="median") for c in (0.1, 10.0)}
    folded = tuning.with_folds(df, "row_id", "y", 3).cache()
    apart = {c: tuning.summarise(tuning.cross_validate(folded, r, "y", k=3)) for c, r in recipes.items()}
    fills, scalers = [], []
    fill, scaler = tuning.impute.impute_fit, tuning.scale.scale_fit
    monkeypatch.setattr(tuning.impute, "impute_fit", lambda df, cols, *a, **k: fills.append(list(cols)) or fill(df, cols, *a, **k))
    monkeypatch.setattr(tuning.scale, "scale_fit", lambda df, cols, *a, **k: scalers.append(list(cols)) or scaler(df, cols, *a, **k))
    together = tuning.compare(folded, recipes, "y", k=3)
    assert fills == [["b"]] * 3 and scalers == [["a", "b"]] * 3  # a column without gaps needs no median
    for c in recipes:
        assert together[c].keys() == apart[c].keys() and all(np.allclose(together[c][m], apart[c][m], atol=1e-9) for m in apart[c])
    with pytest.raises(ValueError, match="unknown fill"):
        tuning.compare(folded, {"x": Recipe("ridge", ("a",), fill="mode")}, "y", k=3)


def test_search_deals_folds_once_and_fits_equal_draws_once(orders, monkeypatch):
    cols = ("sum_qty", "min_qty")
    spaces = {"ridge": {"alpha": [0.1, 10.0]}, "boost_regressor": {"n_estimators": [2], "max_depth": [1, 2]}}
    recipes = {n: Recipe(n, cols, scaler="standard") for n in spaces}
    first, second = tuning.draw(spaces["boost_regressor"], 2)
    assert first == second  # the seeded draws repeat here
    apart = {n: tuning.random_search(orders, r, spaces[n], "quality", n=2, k=2, refit=False).summaries for n, r in recipes.items()}
    dealt, fitted = [], []
    folds, fit = tuning.splits.folds, tuning.fit
    monkeypatch.setattr(tuning.splits, "folds", lambda *a, **k: dealt.append(1) or folds(*a, **k))
    monkeypatch.setattr(tuning, "fit", lambda df, recipe, *a, **k: fitted.append(recipe.model) or fit(df, recipe, *a, **k))
    top, model, found = workflows.tune_and_refit(orders, recipes, spaces, "quality", draws=2, folds=2)
    assert len(dealt) == 1 and fitted.count("boost_regressor") == 2 + (top == "boost_regressor")
    for n in recipes:
        assert found[n].summaries.keys() == apart[n].keys() == {"candidate_000", "candidate_001"}
        for run, numbers in found[n].summaries.items():
            assert all(np.allclose(numbers[m], apart[n][run][m], atol=1e-9) for m in numbers)
    assert model.transform(orders).filter("prediction is null").count() == 0


def _product(x):
    return x.withColumn("prediction", F.col("a") * F.col("b") + 2 * F.col("c"))


def test_shapley_scores_each_point_of_a_path_once(spark):
    df = spark.createDataFrame([(i, float(i % 5), float(i % 3), float(i % 7), 1.0) for i in range(60)], "row_id long, a double, b double, c double, d double")
    sizes = []

    def predict(x):
        sizes.append(x.count())
        return _product(x)

    cols = ["a", "b", "c", "d"]
    found = {r["feature"]: r["mean_abs_shap"] for r in explain.sampled_shapley(predict, df, cols, permutations=3).collect()}
    assert sizes == [60 * 3 * 5]
    pairs = explain._with_partner(df.select("row_id", *cols), "row_id", cols, "background-42").collect()
    assert found["c"] == pytest.approx(np.mean([abs(2 * (r["c"] - r["__z2"])) for r in pairs])) and found["d"] == 0.0
    one = explain.sampled_shapley(lambda x: x.withColumn("prediction", F.col("c")), df, ["c"], permutations=2).collect()
    assert [r["feature"] for r in one] == ["c"]


def test_permutation_importance_reads_its_rows_once(spark):
    read = spark.sparkContext.accumulator(0)

    def note(v: float) -> float:
        read.add(1)
        return v

    df = spark.createDataFrame([(i, float(i % 5), float(i % 3), float(i % 7)) for i in range(50)], "row_id long, a double, b double, c double")
    noted = df.withColumn("a", F.udf(note, "double")("a")).withColumn("y", F.col("c").cast("int"))
    explain.permutation_importance(_product, noted, ["a", "b", "c"], "y", repeats=3)
    assert read.value == 50
