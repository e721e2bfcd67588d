"""Boosting against a plain version, and its handling of missing values, weights, sampling and odd tables."""

import json

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array

from assayer.operators import boosting, models, tuning
from assayer.operators.boosting import Boost, BoostModel
from assayer.operators.tuning import Recipe


def plain(x, y, classes, rounds, rate, depth, l2=0.0, leaf=1, weight=None):
    """Margins after every round, splits tried at every value and for both sides of missing values."""
    n, weight = len(y), np.ones(len(y)) if weight is None else weight
    if classes:
        mass = np.array([weight[y == k].sum() for k in range(classes)])
        margins = np.repeat(np.log(np.maximum(mass, 1e-12) / weight.sum())[None], n, axis=0)
    else:
        margins = np.full((n, 1), np.average(y, weights=weight))
    out = [margins]
    for _ in range(rounds):
        if classes:
            p = np.exp(margins - margins.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            g, h = p - (y[:, None] == np.arange(classes)), p * (1 - p)
        else:
            g, h = margins - y[:, None], np.ones((n, 1))
        g, h = g * weight[:, None], h * weight[:, None]
        step = np.zeros_like(margins)

        def grow(rows, k, level, value):
            def worth(a):
                return g[a, k].sum() ** 2 / (h[a, k].sum() + l2)

            best = (1e-9, None)
            if level < depth and len(rows) >= 2:
                for side in (0, 1):
                    for c in range(x.shape[1]):
                        v = x[rows, c]
                        for cut in np.unique(v[~np.isnan(v)]):
                            left = (v <= cut) | (np.isnan(v) & (side == 1))
                            a, b = rows[left], rows[~left]
                            if min(len(a), len(b)) >= leaf:
                                gain = worth(a) + worth(b) - worth(rows)
                                if gain > best[0] + 1e-7:
                                    best = (gain, (a, b))
            if best[1] is None:
                step[rows, k] = value
                return
            for part in best[1]:
                grow(part, k, level + 1, -rate * g[part, k].sum() / (h[part, k].sum() + l2))

        for k in range(margins.shape[1]):
            grow(np.arange(n), k, 0, 0.0)
        margins = margins + step
        out.append(margins)
    return out


def table(spark, x, y, weight=None):
    cols = [f"x{i}" for i in range(x.shape[1])]
    rows = [(*[None if np.isnan(v) else float(v) for v in r], None if t is None else float(t), 1.0 if weight is None else float(weight[i])) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in cols) + ", label double, w double")
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep").transform(df)


def fit(df, classes=False, weight="", **settings):
    return Boost(classes=classes, weightCol=weight, settings=json.dumps(settings)).fit(df)


def data(n=160, seed=0, holes=True):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 12, (n, 3)).astype(float)
    y = np.where(x[:, 0] > 5, 2, 0) + (x[:, 1] > 7) + 0.0
    noise = rng.normal(size=n) * 0.3
    if holes:
        x[rng.random((n, 3)) < 0.15] = np.nan
    return x, y, noise


@pytest.mark.parametrize("cells", [1 << 20, 100])
def test_regression_equals_the_plain_version(spark, monkeypatch, cells):
    monkeypatch.setattr(boosting, "CELLS", cells)  # one part, or many
    x, y, noise = data()
    want = plain(x, y + noise, 0, 12, 0.3, 2)
    model = fit(table(spark, x, y + noise).repartition(5), rounds=12, rate=0.3, depth=2, bins=64)
    got = [r[0] for r in model.transform(table(spark, x, y + noise)).select("prediction").collect()]
    assert np.allclose(got, want[-1][:, 0], atol=1e-6)
    assert np.allclose(model.losses, [np.mean((y + noise - m[:, 0]) ** 2) for m in want], atol=1e-5)


def test_softmax_equals_the_plain_version(spark):
    x, y, _ = data(seed=1)
    want = plain(x, y, 4, 6, 0.3, 2, l2=1.0, leaf=5)
    df = table(spark, x, y)
    model = fit(df, True, rounds=6, rate=0.3, depth=2, l2=1.0, leaf_rows=5, bins=64)
    rows = model.transform(df).select(vector_to_array("probability"), "prediction").collect()
    p = np.exp(want[-1])
    assert np.allclose([r[0] for r in rows], p / p.sum(axis=1, keepdims=True), atol=1e-6)
    assert [r[1] for r in rows] == want[-1].argmax(axis=1).tolist()


def test_trees_do_not_depend_on_partitions(spark, monkeypatch):
    x, y, noise = data(400, 2)
    df = table(spark, x, y + noise)
    whole = fit(df.repartition(1), rounds=15, depth=3, rate=0.2)
    monkeypatch.setattr(boosting, "CELLS", 60)
    parts = fit(df.repartition(7), rounds=15, depth=3, rate=0.2)
    assert whole.trees == parts.trees and np.allclose(whole.losses, parts.losses)


def test_weights_count_as_copies(spark):
    x, y, noise = data(120, 3)
    weight = np.random.default_rng(0).integers(0, 4, 120)
    copies = np.repeat(np.arange(120), weight)
    a = fit(table(spark, x, y + noise, weight), weight="w", rounds=5, depth=2, bins=64)
    b = fit(table(spark, x[copies], (y + noise)[copies]), rounds=5, depth=2, bins=64)
    df = table(spark, x, y)
    assert np.allclose(*([r[0] for r in m.transform(df).select("prediction").collect()] for m in (a, b)), atol=1e-6)


def test_loss_never_rises_even_with_wild_steps(spark):
    x, y, noise = data(200, 4)
    for classes, label in ((True, y), (False, y + noise)):
        losses = fit(table(spark, x, label), classes, rounds=25, rate=3.5, depth=3).losses
        assert all(b <= a + 1e-6 for a, b in zip(losses, losses[1:])) and losses[-1] < losses[0]


def test_sampling_is_seeded_and_learns(spark):
    x, y, noise = data(500, 5)
    df = table(spark, x, y + noise)
    one, same, other = (fit(df, rounds=20, depth=3, rows=0.6, columns=0.67, l2=1.0, seed=s) for s in (1, 1, 2))
    assert one.trees == same.trees != other.trees
    assert one.losses[-1] < 0.5 * one.losses[0]
    assert {len({t.column[i] for t in trees for i in range(len(t.column))} - {-1}) for trees in one.trees} <= {1, 2}


def test_limits_on_splits(spark):
    x, y, noise = data(200, 6)
    df = table(spark, x, y + noise)
    assert fit(df, rounds=3, depth=3, split_rows=1000).trees == []
    assert fit(df, rounds=3, depth=3, gain=1e9).trees == []
    few = fit(df, rounds=3, depth=6, leaf_rows=40)
    assert all(t.column.count(-1) <= 5 for trees in few.trees for t in trees)


def test_odd_tables(spark):
    nothing = table(spark, np.zeros((0, 2)), [])
    assert fit(nothing, rounds=3).transform(nothing).count() == 0
    same = table(spark, np.ones((20, 2)), np.full(20, 3.0))
    assert {r[0] for r in fit(same, rounds=5).transform(same).select("prediction").collect()} == {3.0}
    single = table(spark, np.arange(20.0)[:, None], np.zeros(20))
    assert {r[0] for r in fit(single, True, rounds=5).transform(single).select("prediction").collect()} == {0.0}
    empty_column = np.column_stack([np.full(40, np.nan), np.arange(40.0)])
    df = table(spark, empty_column, [None if i == 7 else float(i > 20) for i in range(40)])
    model = fit(df, True, rounds=10, depth=2, rate=0.5)
    assert [r[0] for r in model.transform(df).select("prediction").collect()] == [float(i > 20) for i in range(40)]
    assert model.featureImportances.toArray().tolist() == [0.0, 1.0]


def test_saving_and_recipes(spark, tmp_path):
    x, y, noise = data(150, 7)
    df = table(spark, x, y).drop("features")
    made = Pipeline(stages=[VectorAssembler(inputCols=["x0", "x1", "x2"], outputCol="features", handleInvalid="keep"), models.estimator("boost_classifier", {"n_estimators": 4})]).fit(df)
    made.write().overwrite().save(str(tmp_path / "model"))
    again = PipelineModel.load(str(tmp_path / "model"))
    assert isinstance(again.stages[-1], BoostModel)
    assert again.transform(df).select("prediction").collect() == made.transform(df).select("prediction").collect()
    rows = df.selectExpr("monotonically_increasing_id() AS row_id", "x0", "x1", "x2", "cast(label as int) + 3 AS quality")
    recipe = Recipe("boost_classifier", ("x0", "x1", "x2"), {"n_estimators": 10, "max_depth": 3, "colsample_bytree": 0.7, "subsample": 0.8, "reg_lambda": 1.0, "min_samples_split": 4})
    model = tuning.fit(rows, recipe, "quality")
    assert {r[0] for r in model.transform(rows).select("prediction").distinct().collect()} <= {3.0, 4.0, 5.0, 6.0}
    assert tuning.score(model.transform(rows), "quality")["accuracy"] > 0.7


def test_stored_blocks_keep_a_task_each(spark, monkeypatch):
    """Files read back were packed by size, so that a large table's passes left cores without work."""
    monkeypatch.setattr(boosting, "CELLS", 60)
    x, y, noise = data(400, 5)
    rows = spark.createDataFrame([(r.tolist(), float(t), 1.0) for r, t in zip(np.nan_to_num(x), y + noise)], "features array<double>, label double, weight double")
    booster = boosting.Booster(rows.repartition(9), 0, boosting.Settings(rounds=12, depth=2, bins=64))
    booster.run()
    assert booster.applied and booster.parts == booster.blocks.rdd.getNumPartitions() == min(400 * 3 // 60, spark.sparkContext.defaultParallelism)


@pytest.mark.parametrize("splits", [0, 1, 3, 7, 9])
def test_leaf_tables_equal_the_walk(splits):
    rng = np.random.default_rng(splits)
    bins, tree, leaves = rng.integers(0, 256, (3, 500)).astype(np.uint8), boosting.Tree(depth=splits), [0]
    for i in range(splits):
        leaves += tree.split(leaves.pop(0), int(rng.integers(3)), int(rng.integers(20, 200)), bool(i % 2), i + 0.25, -i - 0.5)
    assert (tree.lookup()(bins, tree.value) == np.array(tree.value)[tree.walk(bins)]).all()
