"""Shapley values of trees against the definition, over all sets of columns."""

from itertools import combinations
from math import factorial

import numpy as np
import pandas as pd
import pytest

from assayer.operators import tree_shap, tuning
from assayer.operators.tuning import Recipe

COLS = ["a", "b", "c"]


def table(n=150, seed=0, holes=False):
    rng = np.random.default_rng(seed)
    x = rng.integers(0, 9, (n, 3)).astype(float)
    y = x[:, 0] * (x[:, 1] > 4) + 2.0 * (x[:, 2] > 6)
    pdf = pd.DataFrame({"row_id": range(n), **dict(zip(COLS, x.T)), "y": y})
    return [(int(r.row_id), *(None if holes and (r.row_id + j) % 9 == 0 else float(r[c]) for j, c in enumerate(COLS)), float(r.y)) for _, r in pdf.iterrows()]


def expected(tree, x, known, node=0):
    """The tree's value when only some columns are known."""
    c = tree.column[node]
    if c < 0:
        return tree.value[node]
    left, right = tree.left[node], tree.right[node]
    if c in known:
        side = tree.missing_left[node] if np.isnan(x[c]) else x[c] <= tree.threshold[node]
        return expected(tree, x, known, left if side else right)
    n = tree.cover[node]
    return sum(tree.cover[k] / n * expected(tree, x, known, k) for k in (left, right)) if n else 0.0


@pytest.mark.parametrize("model", ["forest_regressor", "boost_regressor", "boost_classifier"])
def test_values_equal_the_definition(spark, model):
    rows = table(holes=model != "forest_regressor")
    df = spark.createDataFrame(rows, "row_id long, a double, b double, c double, y double").withColumn("q", (tuning.F.col("y") / 4).cast("int"))
    label, output = ("q", 1) if model == "boost_classifier" else ("y", 0)
    fitted = tuning.fit(df, Recipe(model, tuple(COLS), {"n_estimators": 5, "max_depth": 4}), label)
    trees, base = tree_shap.flat_trees(fitted.model, output)
    tree_shap.covered(trees, df, COLS)
    assert all(t.cover[0] == len(rows) and t.column.max() >= 0 for t in trees)
    got = {r["row_id"]: r for r in tree_shap.tree_shap(fitted.model, fitted.transform(df).drop("features"), COLS, df, output).collect()}
    for row in rows[:12]:
        x = np.array([np.nan if v is None else v for v in row[1:4]])
        value = lambda known: sum(expected(t, x, known) for t in trees)
        for j, c in enumerate(COLS):
            others = [k for k in range(3) if k != j]
            want = sum(factorial(s) * factorial(2 - s) / 6 * (value({*some, j}) - value(set(some))) for s in range(3) for some in combinations(others, s))
            assert got[row[0]][f"shap_{c}"] == pytest.approx(want, abs=1e-9)
        assert got[row[0]]["shap_base"] == pytest.approx(base + value(set()), abs=1e-9)
    if model != "boost_classifier":
        for r in got.values():
            assert r["shap_base"] + sum(r[f"shap_{c}"] for c in COLS) == pytest.approx(r["prediction"], abs=1e-9)
    summary = {r["feature"]: r for r in tree_shap.shap_summary(spark.createDataFrame(list(got.values())), COLS).collect()}
    for c in COLS:
        values = np.array([r[f"shap_{c}"] for r in got.values()])
        assert (summary[c]["mean_shap"], summary[c]["mean_abs_shap"]) == pytest.approx((values.mean(), np.abs(values).mean()))


def test_no_rows_and_no_trees(spark):
    df = spark.createDataFrame(table(30), "row_id long, a double, b double, c double, y double").withColumn("y", tuning.F.lit(2.0))
    fitted = tuning.fit(df, Recipe("boost_regressor", tuple(COLS), {"n_estimators": 3}), "y")
    rows = tree_shap.tree_shap(fitted.model, df, COLS).collect()
    assert {(r["shap_base"], r["shap_a"]) for r in rows} == {(2.0, 0.0)}
    assert tree_shap.tree_shap(fitted.model, df.limit(0), COLS).count() == 0


def grown(rng, depth, width, cuts):
    """A random tree with a leaf at every end of full depth."""
    rows = []

    def node(level):
        at = len(rows)
        rows.append([-1, 0.0, False, 0, 0, float(rng.normal())])
        if level < depth:
            rows[at] = [int(rng.integers(width)), float(rng.choice(cuts)), bool(rng.integers(2)), node(level + 1), node(level + 1), 0.0]
        return at

    node(0)
    return tree_shap.FlatTree(*(np.array(x) for x in zip(*rows, strict=True)))


@pytest.mark.parametrize(("depth", "width"), [(0, 2), (5, 6), (8, 30)])
def test_tables_of_states_give_each_leafs_values(depth, width):
    rng = np.random.default_rng(depth)
    cuts = np.sort(rng.normal(size=9))
    tree = grown(rng, depth, width, cuts)
    x = rng.normal(size=(400, width))
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:40, 0] = cuts[4]  # on a threshold: left
    edges = tree_shap.edges_of([tree], width)
    bins = tree_shap.bins_of(list(x.T), edges)

    def reached(row, node=0):
        c = tree.column[node]
        left = tree.missing_left[node] if np.isnan(row[c]) else row[c] <= tree.threshold[node]
        return [node] if c < 0 else [node, *reached(row, tree.left[node] if left else tree.right[node])]

    tree.set_cover(tree.counter(edges)(bins).astype(float))
    assert tree.cover.tolist() == np.bincount([n for row in x for n in reached(row)], minlength=len(tree.column)).tolist()

    def values(room):
        parts, base, used = tree_shap.parts_of(tree, edges, room)
        out = np.zeros((width, len(x)))
        for part in parts:
            part.add(bins, out)
        assert used <= room
        return len(parts), base, out

    (few, base, tables), (leaves, same_base, direct) = values(tree_shap.CELLS), values(0)
    assert tables == pytest.approx(direct, abs=1e-12) and base == same_base
    assert few * 2 <= leaves or not depth  # a row looks up groups of leaves, not every leaf
    assert tables.sum(axis=0) + base == pytest.approx(np.array([tree.value[reached(row)[-1]] for row in x]), abs=1e-9)
