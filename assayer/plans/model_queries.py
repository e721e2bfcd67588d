"""Model, resampling, tuning and explanation queries.

Fits are iterative or seeded, so most have no SQL; the closed-form ones do.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import correlation, derive, evaluate, explain, iforest, impute, models, neighbors, outliers, resample, scale, select, splits, tree_shap, tuning
from ..operators.tuning import Recipe
from ..session import cut_lineage, scratch_path
from ..sources import ledger, tables, views
from ..sources.views import ORDER_COLS, with_views
from . import workflows
from .profile_queries import iqr_ctes
from .registry import query, rnd, rounded, sql_rnd as r

LABEL = "quality"
FEW = ("sum_qty", "avg_disc", "min_qty")
COLS = tuple(ORDER_COLS)


def _order(spark, sf) -> DataFrame:
    """The order features, read several times by every fit, as a written table."""
    return cut_lineage(views.order_features(spark, sf))


def _parts(df, share=0.2):
    parts = cut_lineage(splits.stratified_split(df, "row_id", LABEL, share))
    return parts.filter("split = 'train'").drop("split"), parts.filter("split = 'test'").drop("split")


# ---- sources -------------------------------------------------------------


@query("s01_csv_scan", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s01(spark, sf):
    df = views.table(spark, sf, "customer")
    path = scratch_path(spark, "customer-csv")
    df.write.option("header", True).csv(path)
    return tables.read_csv(spark, path, df.schema)


@query("s02_csv_sniffed", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def s02(spark, sf):
    df = views.table(spark, sf, "customer")
    path = scratch_path(spark, "customer-psv")
    df.write.option("header", True).option("sep", "|").csv(path)
    return tables.read_sniffed(spark, path, df.schema)


@query("s06_run_ledger", with_views("scored", "SELECT 'class_' || label AS run_name, ROUND(AVG(ABS(label - prediction)), 6) + 0.0 AS mae FROM scored GROUP BY label"))
def s06(spark, sf):
    path = scratch_path(spark, "runs")
    errors = evaluate.mae_by_class(views.scored(spark, sf), "label", "prediction").collect()  # one row per class
    rows = [ledger.run_row("per_class", f"class_{e['label']}", {"label": e["label"]}, {"mae": e["mae"]}) for e in errors]
    ledger.log_runs(spark, path, rows)
    return ledger.run_metrics(ledger.read_runs(spark, path), ["mae"]).select("run_name", rnd("mae").alias("mae"))


_TEST_ROWS = """CASE WHEN ROW_NUMBER() OVER (PARTITION BY quality ORDER BY md5(concat('42:', row_id)), row_id)
  <= FLOOR(0.2 * COUNT(*) OVER (PARTITION BY quality) + 0.5) THEN 'test' ELSE 'train' END"""


def ols_ctes(view: str, ridge: str = "0") -> str:
    """CTEs ``cv`` and ``w``: the two-column least-squares fit of quality, with a penalty added to the variances."""
    return f"""cv AS (SELECT AVG(sum_qty) AS m1, AVG(avg_disc) AS m2, AVG(quality) AS my, VAR_POP(sum_qty) + {ridge} AS s11, VAR_POP(avg_disc) + {ridge} AS s22,
    COVAR_POP(sum_qty, avg_disc) AS s12, COVAR_POP(sum_qty, quality) AS s1, COVAR_POP(avg_disc, quality) AS s2 FROM {view}),
  w AS (SELECT *, (s22 * s1 - s12 * s2) / (s11 * s22 - s12 * s12) AS w1, (s11 * s2 - s12 * s1) / (s11 * s22 - s12 * s12) AS w2 FROM cv)"""


_OLS = ols_ctes("order_features")
_TWO = ["sum_qty", "avg_disc"]
_LINE = "my + w1 * (sum_qty - m1) + w2 * (avg_disc - m2)"


@query("s07_saved_model", with_views("order_features", f"""THEN p AS (SELECT *, {_TEST_ROWS} AS split FROM order_features), train AS (SELECT * FROM p WHERE split = 'train'),
  {ols_ctes('train')} SELECT row_id, quality, {r(_LINE, 5)} AS prediction FROM p, w WHERE split = 'test'"""))
def s07(spark, sf):
    train, test = _parts(_order(spark, sf))
    path = scratch_path(spark, "pipeline")
    models.save_pipeline(models.pipeline(_TWO, "ols").fit(train.withColumn("label", F.col(LABEL).cast("double"))), path)
    return rounded(models.load_pipeline(path).transform(test).select("row_id", LABEL, "prediction"), ["prediction"], 5)


@query("s09_write_table", with_views("order_features", "SELECT row_id, quality, sum_qty FROM order_features"))
def s09(spark, sf):
    path = scratch_path(spark, "clean")
    tables.write_table(views.order_features(spark, sf), path, partition_by=[LABEL])
    return tables.read_parquet(spark, path, ["row_id", LABEL, "sum_qty"])


# ---- outliers with learned structure -------------------------------------


@query("o08_isolation_forest")
def o08(spark, sf):
    df = _order(spark, sf)
    forest = iforest.iforest_fit(df, ORDER_COLS, "row_id")
    return iforest.iforest_flag(df, forest, 0.05).select("row_id", "score", "is_outlier")


@query("o09_pca_iqr")
def o09(spark, sf):
    df = _order(spark, sf)
    flat = models.project(df, models.principal_axes(df, ORDER_COLS, 2))
    return outliers.iqr_filter(flat, outliers.iqr_fit(flat, ["pca_1", "pca_2"])).select("row_id", LABEL, "pca_1", "pca_2")


_PAIR = ["sum_qty", "sum_price"]
# Two standardised columns with a positive correlation have the axes (1, 1) and (1, -1).
_PAIR_AXES = """z AS (SELECT row_id, quality, (sum_qty - AVG(sum_qty) OVER ()) / STDDEV_POP(sum_qty) OVER () AS a, (sum_price - AVG(sum_price) OVER ()) / STDDEV_POP(sum_price) OVER () AS b FROM order_features),
  pc AS (SELECT row_id, quality, (a + b) / SQRT(2) AS pca_1, (a - b) / SQRT(2) AS pca_2 FROM z)"""


@query("o09_pca_iqr_pair", with_views("order_features", f"THEN {_PAIR_AXES}, " + iqr_ctes("pc", ["pca_1", "pca_2"])[5:] + f"""
SELECT row_id, quality, {r('pca_1', 5)} AS pca_1, {r('pca_2', 5)} AS pca_2 FROM kept"""))
def o09_pair(spark, sf):
    df = _order(spark, sf)
    flat = models.project(df, models.principal_axes(df, _PAIR, 2))
    kept = outliers.iqr_filter(flat, outliers.iqr_fit(flat, ["pca_1", "pca_2"]))
    return rounded(kept.select("row_id", LABEL, "pca_1", "pca_2"), ["pca_1", "pca_2"], 5)


@query("o10_outlier_overlap")
def o10(spark, sf):
    df = _order(spark, sf)
    flagged = iforest.iforest_flag(df, iforest.iforest_fit(df, ORDER_COLS, "row_id"), 0.05)
    flat = models.project(flagged, models.principal_axes(df, ORDER_COLS, 2))
    iqr = outliers.votes(outliers.iqr_fit(df, ORDER_COLS)) > 0
    return flat.select("row_id", "pca_1", "pca_2", outliers.overlap_code(iqr, F.col("is_outlier")))


@query("o12_outlier_bakeoff")
def o12(spark, sf):
    df = _order(spark, sf)
    recipe = Recipe("forest_classifier", FEW, _TREES, scaler="standard", fill="median")
    _, summaries = workflows.outlier_bakeoff(df, recipe, ORDER_COLS, LABEL, folds=3)
    return tuning.summary_table(df, summaries, "method")


# ---- derived and scaled --------------------------------------------------


@query("c15_pca_features")
def c15(spark, sf):
    df = _order(spark, sf)
    filled = impute.impute_apply(df, impute.impute_fit(df, ORDER_COLS, "median"))
    return models.project(filled, models.principal_axes(filled, ORDER_COLS, 5)).select("row_id", *[f"pca_{i}" for i in range(1, 6)])


@query("c15_pca_pair", with_views("order_features", f"THEN {_PAIR_AXES} SELECT row_id, {r('pca_1', 5)} AS pca_1, {r('pca_2', 5)} AS pca_2 FROM pc"))
def c15_pair(spark, sf):
    df = _order(spark, sf)
    return rounded(models.project(df, models.principal_axes(df, _PAIR, 2)).select("row_id", "pca_1", "pca_2"), ["pca_1", "pca_2"], 5)


@query("f08_scaler_bakeoff")
def f08(spark, sf):
    df = _order(spark, sf)
    recipes = {f"{how}|ridge": Recipe("ridge", COLS, scaler=how) for how in (*scale.LINEAR, "yeo_johnson", "quantile_normal")}
    table = tuning.summary_table(df, tuning.compare(df, recipes, LABEL), "run")
    parts = F.split("run", r"\|")
    return table.select(parts[0].alias("scaler"), parts[1].alias("model"), "metric", "mean", "std")


@query("f08_best_scaler_knn")
def f08_knn(spark, sf):
    df = cut_lineage(views.user_features(spark, sf).withColumnRenamed("user_id", "row_id").withColumn("quality", F.col("n_errors").cast("int")))
    cols = ("n_events", "sum_value", "avg_value", "max_value")
    _, summaries = workflows.best_scaler(df, cols, LABEL, "knn", folds=3)
    return tuning.summary_table(df, summaries, "scaler")


# ---- resampling ----------------------------------------------------------


_D3 = " + ".join(f"POW(a.{c} - b.{c}, 2)" for c in FEW)
_DIGEST = "md5(concat('smote-42:', row_id, ':', copy))"
_SHARE = "('0x' || SUBSTR({d}, {i}, 12))::BIGINT / 281474976710656.0"


@query("t07_smote", with_views("order_features", f"""THEN n AS (SELECT quality AS y, COUNT(*) AS n, (MAX(COUNT(*)) OVER ()) - COUNT(*) AS need, LEAST(5, (MIN(COUNT(*)) OVER ()) - 1) AS k FROM order_features GROUP BY 1),
  small AS (SELECT o.*, need, n, k FROM order_features o JOIN n ON y = quality WHERE need > 0),
  near AS (SELECT a.row_id AS base, b.row_id AS other, ROW_NUMBER() OVER (PARTITION BY a.row_id ORDER BY {_D3}, b.row_id) AS rk
    FROM small a JOIN small b ON a.quality = b.quality AND a.row_id <> b.row_id QUALIFY rk <= 5),
  turn AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY quality ORDER BY md5(concat('42:', row_id)), row_id) AS place FROM small),
  drawn AS (SELECT *, UNNEST(RANGE(1, CAST(need // n + CASE WHEN place <= need % n THEN 1 ELSE 0 END + 1 AS BIGINT))) AS copy FROM turn),
  spot AS (SELECT *, {_SHARE.format(d=_DIGEST, i=1)} AS gap, CAST(FLOOR({_SHARE.format(d=_DIGEST, i=13)} * k) + 1 AS BIGINT) AS pick FROM drawn)
SELECT row_id, 0 AS copy, FALSE AS synthetic, CAST(NULL AS BIGINT) AS neighbor, {", ".join(f"{r(c)} AS {c}" for c in FEW)}, quality FROM order_features
UNION ALL SELECT a.row_id, CAST(copy AS INT), TRUE, other, {", ".join(r(f"a.{c} + gap * (b.{c} - a.{c})") for c in FEW)}, a.quality
FROM spot a JOIN near ON base = a.row_id AND rk = pick JOIN order_features b ON b.row_id = other"""))
def t07(spark, sf):
    return rounded(resample.smote(_order(spark, sf), "row_id", list(FEW), LABEL).drop("gap").withColumn("copy", F.col("copy").cast("int")), list(FEW))


_DIMS = [f"e{i}" for i in range(1, 65)]
_DIST = "LIST_SUM(LIST_TRANSFORM(RANGE(1, 65), lambda i: POW(CAST(a.embedding[i] AS DOUBLE) - CAST(b.embedding[i] AS DOUBLE), 2)))"


@query("t08_tomek_links", f"""WITH d AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label AS ya, b.label AS yb, {_DIST} AS d FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
nn AS (SELECT * FROM d QUALIFY ROW_NUMBER() OVER (PARTITION BY a ORDER BY d, b) = 1)
SELECT x.a AS vec_id FROM nn x JOIN nn y ON x.b = y.a AND y.b = x.a WHERE x.ya <> x.yb""")
def t08(spark, sf):
    return resample.tomek_links(views.emb_features(spark, sf), "vec_id", _DIMS, "label")


@query("t09_smote_tomek")
def t09(spark, sf):
    return resample.smote_tomek(_order(spark, sf), "row_id", list(FEW), LABEL)


@query("a10_knn_regressor", f"""WITH parts AS (SELECT *, CASE WHEN ROW_NUMBER() OVER (ORDER BY md5(concat('42:', vec_id)), vec_id) <= CEIL(0.2 * COUNT(*) OVER ()) THEN 'test' ELSE 'train' END AS split FROM embeddings),
d AS (SELECT a.vec_id, b.vec_id AS other, b.label AS y, {_DIST} AS d FROM parts a JOIN parts b ON a.split = 'test' AND b.split = 'train')
SELECT vec_id, {r('AVG(y)')} AS prediction FROM (SELECT * FROM d QUALIFY ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY d, other) <= 5) GROUP BY vec_id""")
def a10(spark, sf):
    parts = cut_lineage(splits.split(views.emb_features(spark, sf), "vec_id", 0.2))
    train, test = parts.filter("split = 'train'"), parts.filter("split = 'test'")
    return rounded(neighbors.knn_regress(train, test, _DIMS, "label", 5, "vec_id").select("vec_id", "prediction"), ["prediction"])


# ---- estimators ----------------------------------------------------------

@query("a01_linear_regression", with_views("order_features", f"""THEN {_OLS} SELECT 'sum_qty' AS feature, {r('w1', 5)} AS weight FROM w
UNION ALL SELECT 'avg_disc', {r('w2', 5)} FROM w UNION ALL SELECT 'intercept', {r('my - w1 * m1 - w2 * m2', 5)} FROM w"""))
def a01(spark, sf):
    return _weights(spark, models.estimator("ols").fit(models.assembled(_order(spark, sf), _TWO, LABEL)))


def _weights(spark, model):
    rows = [*zip(_TWO, map(float, model.coefficients)), ("intercept", float(model.intercept))]
    return rounded(spark.createDataFrame(rows, "feature string, weight double"), ["weight"], 5)


@query("a01_ridge_weights", with_views("order_features", f"""THEN {ols_ctes('order_features', '50.0 / COUNT(*)')} SELECT 'sum_qty' AS feature, {r('w1', 5)} AS weight FROM w
UNION ALL SELECT 'avg_disc', {r('w2', 5)} FROM w UNION ALL SELECT 'intercept', {r('my - w1 * m1 - w2 * m2', 5)} FROM w"""))
def a01_ridge_weights(spark, sf):
    df = _order(spark, sf)
    size = df.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(LABEL).alias("std")).first()
    return _weights(spark, models.estimator("ridge", {"alpha": 50.0}, size["n"], label_std=size["std"]).fit(models.assembled(df, _TWO, LABEL)))


def _predict_query(name: str, recipe: Recipe):
    @query(name)
    def run(spark, sf):
        train, test = _parts(_order(spark, sf))
        return tuning.fit(train, recipe, LABEL).transform(test).select("row_id", LABEL, "prediction")


_TREES = {"n_estimators": 100, "max_depth": 5}
_predict_query("a01_ridge", Recipe("ridge", COLS, {"alpha": 1.0}, scaler="standard"))
_predict_query("a02_elastic_net", Recipe("elastic_net", COLS, {"alpha": 0.05, "l1_ratio": 0.5}, scaler="standard"))
_predict_query("a02_lasso", Recipe("lasso", COLS, {"alpha": 0.05}, scaler="standard"))
_predict_query("a03_logistic", Recipe("logistic", COLS, {"C": 1.0, "max_iter": 30}, scaler="standard"))
_predict_query("a03_logistic_elastic_net", Recipe("logistic", COLS, {"C": 1.0, "l1_ratio": 0.5, "max_iter": 20}, scaler="standard"))
_predict_query("a04_forest_regressor", Recipe("forest_regressor", COLS, _TREES))
_predict_query("a05_forest_classifier", Recipe("forest_classifier", COLS, _TREES))
_predict_query("a05_forest_classifier_balanced", Recipe("forest_classifier", COLS, _TREES, resampling="weights"))
_predict_query("a06_boost_regressor", Recipe("boost_regressor", COLS, {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3}))
_predict_query("a07_boost_classifier", Recipe("boost_classifier", COLS, {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 3}))
_predict_query("a08_linear_svc", Recipe("linear_svc", COLS, {"C": 1.0, "max_iter": 10}, scaler="standard"))
_predict_query("a08_rbf_svc", Recipe("rbf_svc", COLS, {"C": 1.0, "max_iter": 10, "n_components": 50}, scaler="standard"))
_predict_query("a08_svr_rbf", Recipe("svr", COLS, {"C": 1.0, "n_components": 50}, scaler="standard"))


_STUMP_COLS, _STUMPS = ("tens", "max_tax"), {"n_estimators": 4, "learning_rate": 0.5, "max_depth": 1}


def _stump_rounds() -> str:
    """Each round as SQL: sums below every value of both columns, the cut of highest gain, and the margins after it."""
    steps = ["f0 AS (SELECT row_id, quality, CAST(FLOOR(min_qty / 10) AS DOUBLE) AS tens, max_tax, AVG(quality) OVER () AS f FROM order_features)"]
    for i in range(_STUMPS["n_estimators"]):
        values = " UNION ALL ".join(f"SELECT {k} AS k, {c} AS v, SUM(quality - f) AS s, COUNT(*) AS n FROM f{i} GROUP BY 2" for k, c in enumerate(_STUMP_COLS))
        steps.append(f"""b{i} AS (SELECT k, v, s / n AS below, (total - s) / (rows - n) AS above
      FROM (SELECT k, v, SUM(s) OVER (PARTITION BY k ORDER BY v) AS s, SUM(n) OVER (PARTITION BY k ORDER BY v) AS n, SUM(s) OVER (PARTITION BY k) AS total,
            SUM(n) OVER (PARTITION BY k) AS rows FROM ({values}))
      WHERE n < rows ORDER BY s * s / n + (total - s) * (total - s) / (rows - n) DESC, k, v LIMIT 1)""")
        steps.append(f"""f{i + 1} AS (SELECT row_id, quality, tens, max_tax,
      f + {_STUMPS["learning_rate"]} * CASE WHEN (CASE k WHEN 0 THEN tens ELSE max_tax END) <= v THEN below ELSE above END AS f FROM f{i}, b{i})""")
    return ",\n  ".join(steps)


@query("a06_boost_stumps", with_views("order_features", f"""THEN {_stump_rounds()}
SELECT row_id, quality, {r('f', 5)} AS prediction FROM f{_STUMPS["n_estimators"]}"""))
def a06_stumps(spark, sf):
    df = _order(spark, sf).withColumn("tens", F.floor(F.col("min_qty") / 10).cast("double"))
    model = tuning.fit(df, Recipe("boost_regressor", _STUMP_COLS, _STUMPS), LABEL)
    return rounded(model.transform(df).select("row_id", LABEL, "prediction"), ["prediction"], 5)


_ROUNDS = "SELECT UNNEST(RANGE(0, 101))::INT AS round, FALSE AS rose"


def _losses(spark, model, first):
    """A row a round: whether the training loss rose, and the loss before the first."""
    rows = [(i, bool(i) and x > model.losses[i - 1] * (1 + 1e-9) + 1e-6) for i, x in enumerate(model.losses)]
    return rounded(spark.createDataFrame(rows, "round int, rose boolean").withColumns({"loss_before": F.lit(float(model.losses[0])), **first}), ["loss_before", *first], 5)


@query("a06_boost_invariants", with_views("order_features", f"""THEN n AS (SELECT VAR_POP(quality) AS loss, AVG(quality) AS mean FROM order_features)
SELECT round, rose, {r('loss', 5)} AS loss_before, {r('mean', 5)} AS mean_prediction FROM ({_ROUNDS}), n"""))
def a06_invariants(spark, sf):
    """The loss starts at the variance and never rises; without a penalty the mean prediction stays the mean label."""
    df = _order(spark, sf)
    model = tuning.fit(df, Recipe("boost_regressor", COLS, {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 2}), LABEL)
    mean = model.transform(df).agg(F.avg("prediction")).first()[0]
    return _losses(spark, model.model, {"mean_prediction": F.lit(mean)})


@query("a07_boost_invariants", with_views("order_features", f"""THEN n AS (SELECT COUNT(*) AS n FROM order_features GROUP BY quality),
  e AS (SELECT -SUM(n * LN(n / t)) / MAX(t) AS loss FROM (SELECT n, SUM(n) OVER () AS t FROM n))
SELECT round, rose, {r('loss', 5)} AS loss_before, 1.0::DOUBLE AS mean_total FROM ({_ROUNDS}), e"""))
def a07_invariants(spark, sf):
    """The loss starts at the entropy of the classes and never rises; probabilities add up to 1."""
    df = _order(spark, sf)
    model = tuning.fit(df, Recipe("boost_classifier", COLS, {"n_estimators": 100, "learning_rate": 0.1, "max_depth": 2}), LABEL)
    total = F.aggregate(vector_to_array("probability"), F.lit(0.0), lambda a, x: a + x)
    return _losses(spark, model.model, {"mean_total": F.lit(model.transform(df).agg(F.avg(total)).first()[0])})


# ---- selection with models -----------------------------------------------


def _forest_scores(df, cols=ORDER_COLS):
    recipe = Recipe("forest_regressor", tuple(cols), _TREES)
    return models.importances(tuning.fit(df, recipe, LABEL).model, list(cols))


@query("l07_forest_importance")
def l07(spark, sf):
    df = _order(spark, sf)
    return models.importance_table(df, _forest_scores(df)).orderBy(F.desc("importance")).limit(4)


@query("l08_select_from_model")
def l08(spark, sf):
    df = _order(spark, sf)
    return workflows.select_from_model(models.importance_table(df, _forest_scores(df)))


_ALPHAS = [0.5 * 0.6**i for i in range(16)]
_P = len(ORDER_COLS)


def _fold_cov(folds: int) -> str:
    """``sys``: covariances of the columns standardised on the training rows of each fold (-1: all rows); column ``_P`` is the label."""
    names = [*ORDER_COLS, "quality"]
    value = "CASE i " + " ".join(f"WHEN {i} THEN {c}::DOUBLE" for i, c in enumerate(names)) + " END"
    return f"""f AS (SELECT *, CAST((ROW_NUMBER() OVER (PARTITION BY quality ORDER BY md5(concat('42:', row_id)), row_id) - 1) % {folds} AS INT) AS fold FROM order_features),
  g AS (SELECT UNNEST(RANGE(-1, {folds})) AS g), cells AS MATERIALIZED (SELECT row_id, fold, i, {value} AS x FROM f, (SELECT UNNEST(RANGE({_P + 1})) AS i)),
  mid AS MATERIALIZED (SELECT g, i, AVG(x) AS m, STDDEV_POP(x) AS s, COUNT(*) AS n FROM g, cells WHERE fold <> g GROUP BY g, i),
  pairs AS MATERIALIZED (SELECT a.fold, a.i, b.i AS j, SUM((a.x - ma.m) * (b.x - mb.m)) AS s, SUM(a.x - ma.m) AS da, SUM(b.x - mb.m) AS db, COUNT(*) AS n
    FROM cells a JOIN cells b USING (row_id) JOIN mid ma ON ma.g = -1 AND ma.i = a.i JOIN mid mb ON mb.g = -1 AND mb.i = b.i GROUP BY ALL),
  sys AS MATERIALIZED (SELECT g, p.i, p.j, (SUM(p.s) - SUM(da) * SUM(db) / SUM(p.n)) / SUM(p.n) / CASE p.i WHEN {_P} THEN 1 ELSE ANY_VALUE(mi.s) END / CASE p.j WHEN {_P} THEN 1 ELSE ANY_VALUE(mj.s) END AS v
    FROM g JOIN pairs p ON p.fold <> g JOIN mid mi USING (g) JOIN mid mj USING (g) WHERE mi.i = p.i AND mj.i = p.j GROUP BY g, p.i, p.j)"""


def _held_out(weights: str) -> str:
    """``e``: error of every held-out row under the weights (g, run, i, w) of standardised columns."""
    return f"""e AS (SELECT run, fold, row_id, ANY_VALUE(y.x) AS quality, ANY_VALUE(y.x) - ANY_VALUE(my.m) - SUM(w * (c.x - mc.m) / mc.s) AS err
    FROM cells c JOIN {weights} ON g = c.fold AND {weights}.i = c.i JOIN mid mc ON mc.g = c.fold AND mc.i = c.i JOIN mid my ON my.g = c.fold AND my.i = {_P}
    JOIN (SELECT row_id, x FROM cells WHERE i = {_P}) y USING (row_id) GROUP BY run, fold, row_id)"""


def _descent(sweeps: int = 60) -> str:
    """``lasso``: coordinate descent from zero as a recursive query; a step sets one weight, ``sweeps`` rounds of them for every fold and penalty."""
    a = ", ".join(repr(x) for x in _ALPHAS)
    return f"""cov AS MATERIALIZED (SELECT g, list(row ORDER BY i) AS a FROM (SELECT g, i, list(v ORDER BY j) AS row FROM sys GROUP BY g, i) GROUP BY g),
  walk AS (SELECT g, al AS run, a, 0 AS step, list_transform(RANGE({_P}), lambda x: 0.0::DOUBLE) AS b FROM cov, (SELECT UNNEST([{a}]::DOUBLE[]) AS al)
    UNION ALL SELECT g, run, a, step + 1, list_transform(RANGE(1, {_P + 1}), lambda k: CASE WHEN k <> c THEN b[k] ELSE SIGN(pull) * GREATEST(ABS(pull) - run, 0) / a[c][c] END)
    FROM (SELECT *, a[c][{_P + 1}] - list_dot_product(a[c][1:{_P}], b) + a[c][c] * b[c] AS pull FROM (SELECT *, step % {_P} + 1 AS c FROM walk WHERE step < {_P * sweeps}))),
  lasso AS MATERIALIZED (SELECT g, run, UNNEST(b) AS w, UNNEST(RANGE({_P})) AS i FROM walk WHERE step = {_P * sweeps})"""


@query("l09_lasso_cv", with_views("order_features", f"""THEN {_fold_cov(3)}, {_descent(400)}, {_held_out('lasso')},
  best AS (SELECT run FROM (SELECT run, fold, AVG(err * err) AS mse FROM e GROUP BY run, fold) GROUP BY run ORDER BY AVG(mse), run DESC LIMIT 1)
SELECT {"[" + ", ".join(repr(c) for c in ORDER_COLS) + "]"}[i + 1] AS feature, {r('w', 5)} AS weight, ABS(w) > 1e-7 AS selected, run AS alpha FROM lasso JOIN best USING (run) WHERE g = -1""").replace("WITH ", "WITH RECURSIVE ", 1))
def l09(spark, sf):
    df = _order(spark, sf)
    alpha, weights, _ = tuning.lasso_path(df, ORDER_COLS, LABEL, _ALPHAS, k=3)
    rows = [(c, w, abs(w) > 1e-7, alpha) for c, w in weights.items()]
    return rounded(spark.createDataFrame(rows, "feature string, weight double, selected boolean, alpha double"), ["weight"], 5)


@query("l10_permutation_importance")
def l10(spark, sf):
    train, test = _parts(_order(spark, sf))
    model = tuning.fit(train, Recipe("forest_regressor", COLS, _TREES), LABEL)
    return explain.permutation_importance(model.transform, test, ORDER_COLS, LABEL, repeats=10)


def _shuffled_sql(repeat: int) -> str:
    rank = f"ROW_NUMBER() OVER (ORDER BY md5(concat('permute-42-{repeat}:', row_id)), row_id)"
    r2 = "1 - AVG(POW(x.quality - ({p}), 2)) / VAR_POP(x.quality)"
    own, other = "(x.{c} - {m})", "(z.{c} - {m})"

    def fall(swap):
        parts = [f"{w} * " + (other if c == swap else own).format(c=c, m=m) for c, w, m in (("sum_qty", "w1", "m1"), ("avg_disc", "w2", "m2"))]
        base = "my + w1 * (x.sum_qty - m1) + w2 * (x.avg_disc - m2)"
        return f"({r2.format(p=base)}) - ({r2.format(p='my + ' + ' + '.join(parts))})"

    return f"""SELECT {repeat} AS rep, {fall('sum_qty')} AS f1, {fall('avg_disc')} AS f2 FROM (SELECT *, {rank} AS rk FROM order_features) x
      JOIN (SELECT *, {rank} AS rk, COUNT(*) OVER () AS n FROM order_features) z ON x.rk = z.rk % z.n + 1, w"""


@query("l10_permutation_importance_ols", with_views("order_features", f"""THEN {_OLS}, falls AS ({_shuffled_sql(0)} UNION ALL {_shuffled_sql(1)})
SELECT 'sum_qty' AS feature, {r('AVG(f1)', 5)} AS importance, {r('STDDEV_POP(f1)', 5)} AS std FROM falls
UNION ALL SELECT 'avg_disc', {r('AVG(f2)', 5)}, {r('STDDEV_POP(f2)', 5)} FROM falls"""))
def l10_ols(spark, sf):
    df = _order(spark, sf)
    model = tuning.fit(df, Recipe("ols", tuple(_TWO)), LABEL)
    return rounded(explain.permutation_importance(model.transform, df, _TWO, LABEL, repeats=2), ["importance", "std"], 5)


@query("l11_rfe")
def l11(spark, sf):
    df = _order(spark, sf)
    ranks = tuning.rfe(df, Recipe("ridge", COLS, scaler="standard"), LABEL, keep=2)
    return spark.createDataFrame(list(ranks.items()), "feature string, ranking int")


@query("l12_rfecv")
def l12(spark, sf):
    df = _order(spark, sf)
    size, _, ranks = tuning.rfecv(df, Recipe("ridge", COLS, scaler="standard"), LABEL, k=3)
    return spark.createDataFrame([(c, k, k == 1, size) for c, k in ranks.items()], "feature string, ranking int, selected boolean, n_features int")


@query("l17_weighted_rank")
def l17(spark, sf):
    df = _order(spark, sf)
    ranks = tuning.rfe(df, Recipe("ridge", COLS, scaler="standard"), LABEL)
    scores = {
        "vif": correlation.vif(df, ORDER_COLS, standardise=True),
        "corr": correlation.target_corr(df, ORDER_COLS, LABEL).select("feature", F.col("corr_abs").alias("corr")),
        "f_score": select.f_classif(df, ORDER_COLS, LABEL), "mi": select.binned_mutual_information(df, ORDER_COLS, LABEL),
        "forest": models.importance_table(df, _forest_scores(df)).withColumnRenamed("importance", "forest"),
        "rfe": spark.createDataFrame(list(ranks.items()), "feature string, rfe int"),
    }
    return select.weighted_rank(scores, k=4)


@query("l19_selection_bakeoff")
def l19(spark, sf):
    df = _order(spark, sf)
    recipe = Recipe("forest_classifier", FEW, _TREES, scaler="standard", fill="median")
    _, summaries, _ = workflows.selection_bakeoff(df, recipe, ORDER_COLS, LABEL, folds=3, top_n=3)
    return tuning.summary_table(df, summaries, "method")


@query("l20_subset_sweep")
def l20(spark, sf):
    df = _order(spark, sf)
    scores = _forest_scores(df)
    ordered = sorted(scores, key=lambda c: (-scores[c], c))
    recipes = {"ridge": Recipe("ridge", COLS, scaler="standard"), "boost": Recipe("boost_regressor", COLS, {"n_estimators": 5, "max_depth": 3})}
    return tuning.summary_table(df, tuning.subset_sweep(df, ordered, recipes, LABEL, sizes=(2, 4, 9999)))


@query("l21_nonzero_coefficients")
def l21(spark, sf):
    df = _order(spark, sf)
    counts = [(a, models.nonzero_coefficients(tuning.fit(df, Recipe("elastic_net", COLS, {"alpha": a}, scaler="standard"), LABEL).model)) for a in (0.01, 0.1, 1.0)]
    return spark.createDataFrame(counts, "alpha double, n_nonzero int")


# ---- cross-validation and search -----------------------------------------


def _ridge(alpha: float) -> str:
    """``ridge``: the standardised system solved by elimination, a column a step."""
    steps = [f"""s0 AS MATERIALIZED (SELECT g, i, j, v + CASE WHEN i = j THEN {alpha} / n ELSE 0 END AS v
      FROM sys JOIN (SELECT g, n FROM mid WHERE i = {_P}) USING (g) WHERE i < {_P})"""]
    for k in range(_P):
        steps.append(f"""s{k + 1} AS MATERIALIZED (SELECT x.g, x.i, x.j, CASE WHEN x.i = {k} THEN x.v / pp.v ELSE x.v - ik.v * kj.v / pp.v END AS v
      FROM s{k} x JOIN s{k} pp ON pp.g = x.g AND pp.i = {k} AND pp.j = {k} JOIN s{k} ik ON ik.g = x.g AND ik.i = x.i AND ik.j = {k} JOIN s{k} kj ON kj.g = x.g AND kj.i = {k} AND kj.j = x.j)""")
    return ",\n  ".join(steps) + f", ridge AS (SELECT g, 0 AS run, i, v AS w FROM s{_P} WHERE j = {_P})"


_CV_METRICS = ("n", "mse", "rmse", "mae", "r2")


@query("t06_cross_validate", with_views("order_features", f"""THEN {_fold_cov(5)}, {_ridge(1.0)}, {_held_out('ridge')},
  m AS (SELECT fold, COUNT(*)::DOUBLE AS n, AVG(err * err) AS mse, SQRT(AVG(err * err)) AS rmse, AVG(ABS(err)) AS mae, 1 - AVG(err * err) / VAR_POP(quality) AS r2 FROM e GROUP BY fold)
""" + " UNION ALL ".join(f"SELECT fold, '{m}' AS metric, {r(m, 5)} AS value FROM m" for m in _CV_METRICS)))
def t06(spark, sf):
    df = _order(spark, sf)
    runs = tuning.cross_validate(df, Recipe("ridge", COLS, scaler="standard"), LABEL, k=5)
    return rounded(spark.createDataFrame([(x["fold"], m, float(x[m])) for x in runs for m in _CV_METRICS], "fold int, metric string, value double"), ["value"], 5)


_FOLD_FIT = """cv AS (SELECT g.fold, AVG(sum_qty) AS m1, AVG(avg_disc) AS m2, AVG(quality) AS my, VAR_POP(sum_qty) AS s11, VAR_POP(avg_disc) AS s22,
    COVAR_POP(sum_qty, avg_disc) AS s12, COVAR_POP(sum_qty, quality) AS s1, COVAR_POP(avg_disc, quality) AS s2 FROM f JOIN (SELECT DISTINCT fold FROM f) g ON f.fold <> g.fold GROUP BY g.fold),
  w AS (SELECT *, (s22 * s1 - s12 * s2) / (s11 * s22 - s12 * s12) AS w1, (s11 * s2 - s12 * s1) / (s11 * s22 - s12 * s12) AS w2 FROM cv),
  e AS (SELECT f.fold, quality, quality - (my + w1 * (sum_qty - m1) + w2 * (avg_disc - m2)) AS err FROM f JOIN w ON w.fold = f.fold)"""


@query("t06_cross_validate_ols", with_views("order_features", f"""THEN f AS (SELECT *, CAST((ROW_NUMBER() OVER (PARTITION BY quality ORDER BY md5(concat('42:', row_id)), row_id) - 1) % 5 AS INT) AS fold FROM order_features),
  {_FOLD_FIT} SELECT fold, COUNT(*) AS n, {r('SQRT(AVG(err * err))', 5)} AS rmse, {r('AVG(ABS(err))', 5)} AS mae, {r('1 - AVG(err * err) / VAR_POP(quality)', 5)} AS r2 FROM e GROUP BY fold"""))
def t06_ols(spark, sf):
    runs = tuning.cross_validate(_order(spark, sf), Recipe("ols", tuple(_TWO)), LABEL, k=5)
    table = spark.createDataFrame([(x["fold"], int(x["n"]), float(x["rmse"]), float(x["mae"]), float(x["r2"])) for x in runs], "fold int, n bigint, rmse double, mae double, r2 double")
    return rounded(table, ["rmse", "mae", "r2"], 5)


def _search_table(df, found: tuning.Search):
    table = tuning.summary_table(df, found.summaries, "candidate")
    params = df.sparkSession.createDataFrame([(n, str(sorted(p.items())), p == found.best_params) for n, p in found.tried.items()], "candidate string, params string, is_best boolean")
    return table.join(params, "candidate")


@query("g01_grid_search")
def g01(spark, sf):
    df = _order(spark, sf)
    space = {"alpha": [0.1, 1.0], "scaler": ["standard", "minmax"]}
    return _search_table(df, tuning.grid_search(df, Recipe("ridge", COLS), space, LABEL, metric="rmse"))


@query("g02_random_search")
def g02(spark, sf):
    df = _order(spark, sf)
    return _search_table(df, tuning.random_search(df, Recipe("elastic_net", COLS), tuning.SPACES["elastic_net"], LABEL, n=10))


@query("g03_space_search")
def g03(spark, sf):
    df = _order(spark, sf)
    base = {"elastic_net": Recipe("elastic_net", COLS, fill="median"), "logistic": Recipe("logistic", COLS, {"max_iter": 10}, fill="median")}
    found = {n: tuning.random_search(df, x, tuning.SPACES[n], LABEL, n=2, refit=False) for n, x in base.items()}
    tables_ = [_search_table(df, s).withColumn("model", F.lit(n)) for n, s in found.items()]
    return reduce(DataFrame.unionByName, tables_)


@query("g04_champion")
def g04(spark, sf):
    train, test = _parts(_order(spark, sf))
    spaces = {"ridge": {"alpha": [0.1, 10.0]}, "boost_regressor": {"n_estimators": [5], "max_depth": [2, 3]}}
    _, model, _ = workflows.tune_and_refit(train, {n: Recipe(n, COLS, scaler="standard") for n in spaces}, spaces, LABEL)
    return model.transform(test).select("row_id", LABEL, "prediction")


@query("g05_auto_optimize")
def g05(spark, sf):
    from .clean_queries import DOMAIN

    df = cut_lineage(views.order_features(spark, sf).select("row_id", LABEL, *[F.expr(e).alias(n) for n, e in DOMAIN.items()]))
    train, test = _parts(df)
    found = workflows.auto_optimize(train, list(DOMAIN), LABEL, {"ridge": {"alpha": [0.1, 1.0, 10.0]}}, bundle="ratios_and_logs", sizes=(5, 10), draws=2, folds=3, trees=100)
    ready = derive.bundle(test, "ratios_and_logs")
    return found["model"].transform(ready).select("row_id", LABEL, "prediction")


@query("g07_regression_vs_classification")
def g07(spark, sf):
    train, test = _parts(_order(spark, sf))
    recipes = {
        "regression": Recipe("forest_regressor", FEW, _TREES), "regression_resampled": Recipe("forest_regressor", FEW, _TREES, resampling="smote_tomek"),
        "classification": Recipe("forest_classifier", FEW, _TREES), "classification_balanced": Recipe("forest_classifier", FEW, _TREES, resampling="weights"),
    }
    return workflows.experiment(train, test, recipes, LABEL)


# ---- explanations and final scoring --------------------------------------


@query("e11_importance_table")
def e11(spark, sf):
    df = _order(spark, sf)
    return models.importance_table(df, _forest_scores(df))


@query("e12_linear_shap", with_views("order_features", f"""THEN {_OLS} SELECT 'sum_qty' AS feature, {r('AVG(ABS(w1 * (sum_qty - m1)))', 5)} AS mean_abs_shap FROM order_features, w
UNION ALL SELECT 'avg_disc', {r('AVG(ABS(w2 * (avg_disc - m2)))', 5)} FROM order_features, w"""))
def e12(spark, sf):
    df, cols = _order(spark, sf), ["sum_qty", "avg_disc"]
    model = models.estimator("ols").fit(models.assembled(df, cols, LABEL))
    return rounded(models.linear_shap(df, cols, dict(zip(cols, model.coefficients))), ["mean_abs_shap"], 5)


@query("e12_sampled_shapley")
def e12_tree(spark, sf):
    train, test = _parts(_order(spark, sf))
    model = tuning.fit(train, Recipe("forest_regressor", COLS, _TREES), LABEL)
    return explain.sampled_shapley(model.transform, test, ORDER_COLS, permutations=4)


@query("e12_tree_shap")
def e12_forest(spark, sf):
    train, test = _parts(_order(spark, sf))
    model = tuning.fit(train, Recipe("forest_regressor", COLS, _TREES), LABEL)
    return tree_shap.shap_summary(tree_shap.tree_shap(model.model, test, ORDER_COLS, train), ORDER_COLS)


@query("e12_tree_shap_adds_up", with_views("order_features", f"""SELECT row_id, 0.0::DOUBLE AS gap FROM (SELECT row_id, {_TEST_ROWS} AS split FROM order_features) WHERE split = 'test'"""))
def e12_adds_up(spark, sf):
    """For every test row, base value and Shapley values less the prediction."""
    train, test = _parts(_order(spark, sf))
    model = tuning.fit(train, Recipe("forest_regressor", COLS, _TREES), LABEL)
    shapped = tree_shap.tree_shap(model.model, model.transform(test).drop("features"), ORDER_COLS, train)
    total = sum((F.col(f"shap_{c}") for c in ORDER_COLS), F.col("shap_base"))
    return rounded(shapped.select("row_id", (total - F.col("prediction")).alias("gap")), ["gap"])


_STUMP_STEPS = " UNION ALL ".join(f"SELECT a.row_id, k, b.f - a.f AS g, AVG(b.f - a.f) OVER () AS m FROM f{i} a JOIN f{i + 1} b USING (row_id), b{i}" for i in range(_STUMPS["n_estimators"]))


@query("e12_tree_shap_stumps", with_views("order_features", f"""THEN {_stump_rounds()}
SELECT row_id, {r('SUM(CASE WHEN k = 0 THEN g - m ELSE 0 END)', 5)} AS shap_tens, {r('SUM(CASE WHEN k = 1 THEN g - m ELSE 0 END)', 5)} AS shap_max_tax FROM ({_STUMP_STEPS}) GROUP BY row_id"""))
def e12_stumps(spark, sf):
    """Trees of one split are additive, so their Shapley values have a closed form."""
    df = _order(spark, sf).withColumn("tens", F.floor(F.col("min_qty") / 10).cast("double"))
    model = tuning.fit(df, Recipe("boost_regressor", _STUMP_COLS, _STUMPS), LABEL)
    names = [f"shap_{c}" for c in _STUMP_COLS]
    return rounded(tree_shap.tree_shap(model.model, df, list(_STUMP_COLS)).select("row_id", *names), names, 5)


@query("e13_hidden_set")
def e13(spark, sf):
    df = _order(spark, sf)
    hidden = tables.holdout(df, "row_id", 4001, 4897)
    seen = df.join(hidden.select("row_id"), "row_id", "left_anti")
    made = [derive.pair_products(x, ["sum_qty", "min_qty"]) for x in (seen, hidden)]
    cols = (*COLS, "sum_qty_mul_min_qty", "sum_qty_div_min_qty")
    predicted = tuning.fit(made[0], Recipe("forest_regressor", cols, _TREES, scaler="standard"), LABEL).transform(made[1])
    errors = evaluate.regression_metrics(predicted, LABEL, "prediction").drop("n")
    return errors.join(evaluate.accuracy(predicted, LABEL, "prediction"), how="cross")  # one row each


@query("w01_rank_and_fit")
def w01(spark, sf):
    return workflows.rank_and_fit(_order(spark, sf), ORDER_COLS, LABEL, n_features=4, trees=100)["metrics"]
