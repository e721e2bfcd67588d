import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from assayer.functions import quantiles
from assayer.functions.quantiles import column_quantiles
from assayer.functions import ranks
from assayer.functions.ranks import hash_rank, running_total
from assayer.functions.stats import corr_values, gram
from assayer.operators.iforest import mean_path
from assayer.sources import views


def _pandas_quantiles(pdf, cols, probs):
    return {c: [float(pdf[c].quantile(p)) for p in probs] for c in cols}


@pytest.mark.parametrize("cell_rows", [400, 100_000])
def test_selected_quantiles_equal_the_direct_ones(spark, sf, cell_rows, monkeypatch):
    monkeypatch.setattr(quantiles, "CELL_ROWS", cell_rows)
    df = views.line_features(spark, sf)
    probs = [0.0, 0.1, 0.25, 0.5, 0.777, 1.0]
    direct = column_quantiles(df, views.LINE_COLS, probs)
    assert column_quantiles(df, views.LINE_COLS, probs, cell_limit=0) == direct
    expected = _pandas_quantiles(df.toPandas(), views.LINE_COLS, probs)
    for c in views.LINE_COLS:
        assert direct[None][c] == pytest.approx(expected[c])


@pytest.mark.parametrize("limit", [0, 2 * 700])
def test_a_thousand_quantiles_of_huge_and_tiny_groups(spark, monkeypatch, limit):
    # A coarse sketch, a value of a third of all rows, null groups, null and NaN values, groups of one row.
    monkeypatch.setattr(quantiles, "ACCURACY", 20)
    monkeypatch.setattr(quantiles, "CELL_ROWS", 150)
    rng = np.random.default_rng(1)
    groups = rng.choice(["a", "b", "c", None], 4000, p=[0.7, 0.15, 0.1, 0.05]).tolist()
    groups[:2] = ["one", "none"]
    x = rng.lognormal(size=4000)
    x[2:1400] = 1.0
    rows = [(g, None if i % 11 == 0 or g == "none" else float("nan") if i % 97 == 0 else float(v), None if g == "b" else float(i % 5)) for i, (g, v) in enumerate(zip(groups, x))]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    probs = [i / 999 for i in range(1000)]
    direct = column_quantiles(df, ["x", "y"], probs, by="g")
    found = column_quantiles(df, ["x", "y"], probs, by="g", cell_limit=limit)
    assert set(direct) == {"a", "b", "c", None, "one", "none"} and direct["b"]["y"] == [None] * 1000
    for g in direct:
        for c in ("x", "y"):
            assert np.array_equal(np.array(direct[g][c], float), np.array(found[g][c], float), equal_nan=True), (g, c)
    assert column_quantiles(df.repartition(9), ["y"], probs, cell_limit=limit) == column_quantiles(df, ["y"], probs)


def test_quantile_table_has_a_row_a_group_and_column(spark, monkeypatch):
    df = spark.range(3000).selectExpr("id % 300 AS g", "CAST(id AS DOUBLE) AS x", "CAST(NULL AS DOUBLE) AS y")
    monkeypatch.setattr(quantiles, "GROUP_LIMIT", 100)
    got = {(r["group"], r["feature"]): r["quantiles"] for r in quantiles.quantile_table(df, ["x", "y"], [0.0, 1.0], by="g", cell_limit=2).collect()}
    assert all(got[g, "x"] == [float(g), float(g + 2700)] and got.get((g, "y")) is None for g in range(300))
    with pytest.raises(ValueError, match="more than 100 groups"):
        column_quantiles(df, ["x"], [0.5], by="g")


def test_quantiles_of_nothing(spark):
    df = spark.createDataFrame([], "x double")
    assert column_quantiles(df, ["x"], [0.5]) == {None: {"x": [None]}}
    assert column_quantiles(df, ["x"], [0.5], cell_limit=-1) == {None: {"x": [None]}}
    one = spark.createDataFrame([(None,), (3.0,)], "x double")
    assert column_quantiles(one, ["x"], [0.0, 0.5, 1.0], cell_limit=-1) == {None: {"x": [3.0, 3.0, 3.0]}}


def test_hash_rank_is_a_permutation_per_label_even_with_null_labels(spark):
    df = spark.range(500).withColumn("y", F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, 1).otherwise(2))
    got = hash_rank(df, ["id"], 7, by="y").toPandas()
    for _, part in got.groupby("y", dropna=False):
        assert sorted(part["rank"]) == list(range(1, len(part) + 1))
    again = hash_rank(df.repartition(7), ["id"], 7, by="y").toPandas()
    assert dict(zip(got["id"], got["rank"])) == dict(zip(again["id"], again["rank"]))


def test_running_total_does_not_depend_on_the_cuts(spark):
    pdf = pd.DataFrame({"k": np.arange(200) / 10.0, "w": np.arange(200)})
    df = spark.createDataFrame(pdf)
    expected = (pdf["w"].cumsum() - pdf["w"]).tolist()
    for bounds in ([], [3.3], [0.0, 5.0, 5.05, 19.9, 40.0]):
        got = running_total(df, "k", "w", bounds).orderBy("k").toPandas()
        assert got["before"].tolist() == expected


def test_wide_correlation_equals_numpy_with_missing_values(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 20)) + 1e4
    x[:, 1] = x[:, 0] * 2 + rng.normal(size=400) * 1e-3
    pdf = pd.DataFrame(x, columns=[f"c{i}" for i in range(20)])
    pdf.loc[::7, "c3"] = np.nan
    df = spark.createDataFrame(pdf).withColumn("c3", F.nanvl("c3", F.lit(None)))
    pairs = [(f"c{i}", f"c{j}") for i in range(20) for j in range(i + 1, 20)]
    got, expected = corr_values(df, pairs), pdf.corr()
    for a, b in pairs:
        assert got[a, b] == pytest.approx(expected.loc[a, b], abs=1e-9)


def test_gram_paths_agree(spark, monkeypatch):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 4))
    df = spark.createDataFrame(pd.DataFrame(x, columns=list("abcd")))
    assert gram(df, list("abcd")) == pytest.approx(x.T @ x)
    monkeypatch.setattr("assayer.functions.stats.CHUNK", 3)
    assert gram(df, list("abcd")) == pytest.approx(x.T @ x)


def test_mean_path_grows():
    assert mean_path(1) == 0 and mean_path(2) == 1.0 and 10 < mean_path(256) < 11


def test_running_total_by_group_with_cuts_of_its_own(spark):
    rng = np.random.default_rng(8)
    data = pd.DataFrame([(g, float(k), int(rng.integers(0, 5))) for g in ("a", "b") for k in range(40)], columns=["g", "k", "w"])
    df = spark.createDataFrame(data).unionByName(spark.createDataFrame([("a", None, 3), ("a", float("nan"), 1)], "g string, k double, w long"))
    plain = running_total(df, "k", "w", [], by="g").toPandas()
    sliced = running_total(df, "k", "w", {"a": [3.0, 30.5], "b": []}, by="g").toPandas()
    order = ["g", "before", "w"]
    assert plain.sort_values(order)[order].values.tolist() == sliced.sort_values(order)[order].values.tolist()
    assert sliced[sliced["k"].isna() & (sliced["w"] == 3)]["before"].tolist() == [0]


def test_cut_points_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(ranks, "SLICE_ROWS", 100)
    cuts = ranks.cut_points(spark.range(1000).withColumn("half", F.expr("if(id < 150, id, null)")), {"x": F.col("id"), "y": F.col("half")})
    assert len(cuts["x"]) == 10 and len(cuts["y"]) == 1 and abs(cuts["y"][0] - 75) < 3


def test_dense_positions_across_blocks(spark):
    values = [-5000, -1, 0, 4095, 4096, 9000, 2**31 - 1]
    got = {r["v"]: r["p"] for r in ranks.dense_positions(spark.createDataFrame([(v,) for v in values], "v int"), "v", "p").collect()}
    assert got == {v: float(i) for i, v in enumerate(values)}
