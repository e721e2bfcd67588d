"""Metric queries over a closed-form prediction, split and ledger queries, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import derive, evaluate, resample, splits
from ..sources import ledger, views
from ..sources.views import with_views
from .profile_queries import _union
from .registry import query, rnd, rounded, sql_rnd as r

_REG = """COUNT(*) AS n, AVG(POW(label - prediction, 2)) AS mse, SQRT(AVG(POW(label - prediction, 2))) AS rmse,
  AVG(ABS(label - prediction)) AS mae, 1 - AVG(POW(label - prediction, 2)) / VAR_POP(label) AS r2"""
_REG_ROUND = f"n, {r('mse')} AS mse, {r('rmse')} AS rmse, {r('mae')} AS mae, {r('r2')} AS r2"


def _scored(spark, sf):
    return views.scored(spark, sf)


@query("e01_regression_metrics", with_views("scored", f"SELECT {_REG_ROUND} FROM (SELECT {_REG} FROM scored)"))
def e01(spark, sf):
    return rounded(evaluate.regression_metrics(_scored(spark, sf), "label", "prediction"), ["mse", "rmse", "mae", "r2"])


@query("e02_accuracy", with_views("scored", f"""SELECT COUNT(*) AS n, COUNT(*) FILTER (ROUND_EVEN(prediction, 0) = label) AS n_correct,
  COUNT(*) FILTER (ROUND_EVEN(prediction, 0) <> label) AS n_wrong, {r('AVG(CASE WHEN ROUND_EVEN(prediction, 0) = label THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM scored"""))
def e02(spark, sf):
    return rounded(evaluate.accuracy(_scored(spark, sf), "label", "prediction"), ["accuracy"])


_CONF = """cls AS (SELECT label AS c FROM scored UNION SELECT pred_class FROM scored),
  conf AS (SELECT a.c AS label, b.c AS prediction, COUNT(s.row_id) AS n FROM cls a CROSS JOIN cls b
    LEFT JOIN scored s ON s.label = a.c AND s.pred_class = b.c GROUP BY 1, 2)"""
_REPORT = """rep AS (SELECT l.label, COALESCE(hits / NULLIF(predicted, 0), 0) AS precision, COALESCE(hits / NULLIF(support, 0), 0) AS recall,
    COALESCE(2 * hits / NULLIF(support + predicted, 0), 0) AS f1, support
  FROM (SELECT label, CAST(SUM(n) AS DOUBLE) AS support, CAST(SUM(CASE WHEN label = prediction THEN n ELSE 0 END) AS DOUBLE) AS hits FROM conf GROUP BY label) l
  JOIN (SELECT prediction, CAST(SUM(n) AS DOUBLE) AS predicted FROM conf GROUP BY prediction) p ON p.prediction = l.label)"""


@query("e03_confusion", with_views("scored", f"THEN {_CONF} SELECT label, prediction, n, {r('COALESCE(n / NULLIF(SUM(n) OVER (PARTITION BY label), 0), 0)')} AS share FROM conf"))
def e03(spark, sf):
    return rounded(evaluate.confusion(_scored(spark, sf), "label", "pred_class"), ["share"])


@query("e03_confusion_matrix", with_views("scored", "SELECT label, " + ", ".join(
    f"COUNT(*) FILTER (pred_class = {c}) AS pred_{c}" for c in range(1, 10)) + " FROM scored GROUP BY label"))
def e03_matrix(spark, sf):
    return evaluate.confusion_matrix(_scored(spark, sf), "label", "pred_class", list(range(1, 10)))


@query("e04_class_report", with_views("scored", f"""THEN {_CONF}, {_REPORT} SELECT label, {r('precision')} AS precision, {r('recall')} AS recall,
  {r('f1')} AS f1, CAST(support AS BIGINT) AS support FROM rep"""))
def e04(spark, sf):
    return rounded(evaluate.class_report(_scored(spark, sf), "label", "pred_class"), ["precision", "recall", "f1"])


@query("e04_report_averages", with_views("scored", f"THEN {_CONF}, {_REPORT} SELECT " + ", ".join(
    f"{r(f'AVG({m})')} AS macro_{m}, {r(f'SUM({m} * support) / SUM(support)')} AS weighted_{m}" for m in ("precision", "recall", "f1")) + " FROM rep"))
def e04_averages(spark, sf):
    out = evaluate.report_averages(evaluate.class_report(_scored(spark, sf), "label", "pred_class"))
    return rounded(out, out.columns)


def _kappa_sql(pred: str) -> str:
    return f"""THEN c AS (SELECT label, {pred} AS p FROM scored),
      cls AS (SELECT v, ROW_NUMBER() OVER (ORDER BY v) AS i FROM (SELECT label AS v FROM c UNION SELECT p FROM c)),
      o AS (SELECT label, p, COUNT(*) AS n FROM c GROUP BY 1, 2), rs AS (SELECT label, COUNT(*) AS n FROM c GROUP BY 1), cs AS (SELECT p, COUNT(*) AS n FROM c GROUP BY 1)
    SELECT {r('1 - seen / expected')} AS qwk FROM
      (SELECT SUM(POW(a.i - b.i, 2) * n) AS seen FROM o JOIN cls a ON a.v = o.label JOIN cls b ON b.v = o.p),
      (SELECT SUM(POW(a.i - b.i, 2) * CAST(rs.n AS DOUBLE) * cs.n) / (SELECT COUNT(*) FROM c) AS expected FROM rs CROSS JOIN cs
        JOIN cls a ON a.v = rs.label JOIN cls b ON b.v = cs.p)"""


@query("e05_qwk", with_views("scored", _kappa_sql("pred_class")))
def e05(spark, sf):
    return rounded(evaluate.qwk(_scored(spark, sf), "label", "pred_class"), ["qwk"])


_CLIPPED = "CAST(LEAST(GREATEST(ROUND_EVEN(prediction, 0), (SELECT MIN(label) FROM scored)), (SELECT MAX(label) FROM scored)) AS INT)"


@query("e05_qwk_regression", with_views("scored", _kappa_sql(_CLIPPED)))
def e05_reg(spark, sf):
    return rounded(evaluate.qwk_regression(_scored(spark, sf), "label", "prediction"), ["qwk"])


@query("e05_qwk_fixed_range", with_views("scored", _kappa_sql("CAST(LEAST(GREATEST(ROUND_EVEN(prediction, 0), 0), 10) AS INT)")))
def e05_fixed(spark, sf):
    return rounded(evaluate.qwk_regression(_scored(spark, sf), "label", "prediction", (0, 10)), ["qwk"])


_K = list(range(1, 10))
_AUC = f"""THEN w AS (SELECT label, prediction, {' + '.join(f'EXP(-2 * POW(prediction - {c}, 2))' for c in _K)} AS total FROM scored),
  s AS ({_union(f"SELECT {c} AS c, label = {c} AS pos, ROUND(EXP(-2 * POW(prediction - {c}, 2)) / total, 9) AS s FROM w" for c in _K)}),
  rk AS (SELECT c, pos, RANK() OVER (PARTITION BY c ORDER BY s) + (COUNT(*) OVER (PARTITION BY c, s) - 1) / 2.0 AS rk FROM s),
  a AS (SELECT c AS label, COUNT(*) FILTER (pos) AS n_pos, COUNT(*) FILTER (NOT pos) AS n_neg,
    (SUM(rk) FILTER (pos) - COUNT(*) FILTER (pos) * (COUNT(*) FILTER (pos) + 1) / 2.0) / (CAST(COUNT(*) FILTER (pos) AS DOUBLE) * COUNT(*) FILTER (NOT pos)) AS auc FROM rk GROUP BY c)"""


def _auc(spark, sf):
    df = derive.regression_to_proba(_scored(spark, sf), "prediction", _K)
    return evaluate.auc_per_class(df, "label", {c: f"p_{c}" for c in _K}, digits=9)


@query("e06_auc_per_class", with_views("scored", f"{_AUC} SELECT label, n_pos, n_neg, {r('auc', 5)} AS auc FROM a"))
def e06(spark, sf):
    return rounded(_auc(spark, sf), ["auc"], 5)


@query("e06_macro_auc", with_views("scored", f"{_AUC} SELECT {r('AVG(auc)', 5)} AS macro_auc FROM a"))
def e06_macro(spark, sf):
    return rounded(evaluate.macro_auc(_auc(spark, sf)), ["macro_auc"], 5)


@query("e07_mae_by_class", with_views("scored", f"SELECT label, COUNT(*) AS n, {r('AVG(ABS(label - prediction))')} AS mae FROM scored GROUP BY label"))
def e07(spark, sf):
    return rounded(evaluate.mae_by_class(_scored(spark, sf), "label", "prediction"), ["mae"])


@query("e07_mae_improvement", with_views("scored", f"""SELECT label, n, {r('b')} AS mae_baseline, {r('v')} AS mae_variant, {r('COALESCE(100.0 * (b - v) / NULLIF(b, 0), 0)')} AS improvement_pct
FROM (SELECT label, COUNT(*) AS n, AVG(ABS(label - prediction)) AS b, AVG(ABS(label - pred_class)) AS v FROM scored GROUP BY label)"""))
def e07_improvement(spark, sf):
    out = evaluate.mae_improvement(_scored(spark, sf), "label", "prediction", "pred_class")
    return rounded(out, ["mae_baseline", "mae_variant", "improvement_pct"])


@query("e08_error_report", with_views("scored", f"""SELECT {r('AVG(ABS(e))')} AS mean_abs, {r('QUANTILE_CONT(ABS(e), 0.5)')} AS median_abs, {r('MAX(ABS(e))')} AS max_abs,
  {r('MIN(ABS(e))')} AS min_abs, {r('STDDEV_SAMP(e)')} AS error_std FROM (SELECT label - prediction AS e FROM scored)"""))
def e08(spark, sf):
    out = evaluate.error_report(_scored(spark, sf), "label", "prediction")
    return rounded(out, out.columns)


@query("e09_class_accuracy", with_views("scored", f"SELECT label, COUNT(*) AS n, {r('AVG(CASE WHEN label = pred_class THEN 1.0 ELSE 0.0 END)')} AS accuracy FROM scored GROUP BY label"))
def e09(spark, sf):
    return rounded(evaluate.class_accuracy(_scored(spark, sf), "label", "pred_class"), ["accuracy"])


_SPLIT_ROWS = """CASE WHEN ROW_NUMBER() OVER (ORDER BY md5(concat('42:', row_id)), row_id) <= CEIL(0.2 * COUNT(*) OVER ()) THEN 'test' ELSE 'train' END"""


@query("e10_train_test_gap", with_views("scored", f"""THEN p AS (SELECT *, {_SPLIT_ROWS} AS split FROM scored),
  m AS (SELECT split, {_REG} FROM p GROUP BY split),
  w AS (SELECT {", ".join(f"MAX(CASE WHEN split = '{s}' THEN {m} END) AS {s}_{m}" for s in ("train", "test") for m in ("rmse", "r2", "mae"))} FROM m)
SELECT {", ".join(f"{r(f'{s}_{m}')} AS {s}_{m}" for s in ("train", "test") for m in ("rmse", "r2", "mae"))},
  {r('test_rmse - train_rmse')} AS rmse_gap, {r('train_r2 - test_r2')} AS r2_gap FROM w"""))
def e10(spark, sf):
    parts = splits.split(_scored(spark, sf), "row_id", 0.2)
    out = evaluate.train_test_gap(parts, "label", "prediction")
    return rounded(out, out.columns)


# ---- splits and class balance -------------------------------------------


@query("t01_random_split", with_views("order_features", f"SELECT row_id, {_SPLIT_ROWS} AS split FROM order_features"))
def t01(spark, sf):
    return splits.split(views.order_features(spark, sf), "row_id", 0.2).select("row_id", "split")


@query("t01_threshold_split", "SELECT event_id, CASE WHEN ('0x' || SUBSTR(md5(concat('42:', event_id)), 1, 12))::BIGINT / 281474976710656.0 < 0.2 THEN 'test' ELSE 'train' END AS split FROM events")
def t01_threshold(spark, sf):
    return splits.threshold_split(views.event_values(spark, sf), "event_id", 0.2).select("event_id", "split")


_PER_LABEL = "ROW_NUMBER() OVER (PARTITION BY quality ORDER BY md5(concat('{seed}:', row_id)), row_id)"


@query("t02_stratified_split", with_views("order_features", f"""SELECT row_id, quality, CASE WHEN {_PER_LABEL.format(seed=42)}
  <= FLOOR(0.25 * COUNT(*) OVER (PARTITION BY quality) + 0.5) THEN 'test' ELSE 'train' END AS split FROM order_features"""))
def t02(spark, sf):
    return splits.stratified_split(views.order_features(spark, sf), "row_id", "quality", 0.25).select("row_id", "quality", "split")


@query("t03_folds", with_views("order_features", "SELECT row_id, CAST((ROW_NUMBER() OVER (ORDER BY md5(concat('42:', row_id)), row_id) - 1) % 5 AS INT) AS fold FROM order_features"))
def t03(spark, sf):
    return splits.folds(views.order_features(spark, sf), "row_id", 5).select("row_id", "fold")


@query("t04_stratified_folds", with_views("order_features", f"SELECT row_id, CAST(({_PER_LABEL.format(seed=42)} - 1) % 5 AS INT) AS fold FROM order_features"))
def t04(spark, sf):
    return splits.folds(views.order_features(spark, sf), "row_id", 5, label="quality").select("row_id", "fold")


@query("t05_repeated_folds", with_views("order_features", _union(
    f"SELECT row_id, {i} AS repeat, CAST((ROW_NUMBER() OVER (ORDER BY md5(concat('42-{i}:', row_id)), row_id) - 1) % 5 AS INT) AS fold FROM order_features" for i in range(2))))
def t05(spark, sf):
    return splits.repeated_folds(views.order_features(spark, sf), "row_id", 5, 2).select("row_id", "repeat", "fold")


@query("t10_class_weights", with_views("order_features", f"""SELECT row_id, quality, {r('t / (k * n)')} AS weight FROM order_features JOIN
  (SELECT quality AS q, COUNT(*) AS n, SUM(COUNT(*)) OVER () AS t, COUNT(*) OVER () AS k FROM order_features GROUP BY 1) ON q = quality"""))
def t10(spark, sf):
    out = resample.with_class_weights(views.order_features(spark, sf), "quality")
    return rounded(out.select("row_id", "quality", "weight"), ["weight"])


@query("t11_random_oversample", with_views("order_features", f"""THEN n AS (SELECT quality AS q, COUNT(*) AS n FROM order_features GROUP BY 1),
  c AS (SELECT row_id, quality, {_PER_LABEL.format(seed=42)} AS rk, n, (SELECT MAX(n) FROM n) AS top FROM order_features JOIN n ON q = quality)
SELECT row_id, quality, CAST(copy AS INT) AS copy FROM (SELECT row_id, quality, UNNEST(RANGE(CAST(top // n + CASE WHEN rk <= top % n THEN 1 ELSE 0 END AS BIGINT))) AS copy FROM c)"""))
def t11(spark, sf):
    return resample.random_oversample(views.order_features(spark, sf), "row_id", "quality").select("row_id", "quality", F.col("copy").cast("int").alias("copy"))


# ---- result tables -------------------------------------------------------

_RESULTS = f"res AS (SELECT CAST(label AS VARCHAR) AS run_name, {_REG} FROM scored GROUP BY label), ok AS (SELECT run_name, rmse, mae, n / 10000.0 AS r2 FROM res)"


def _results(spark, sf):
    """One row of metrics per class, standing in for the rows of a comparison."""
    table = evaluate.regression_metrics(_scored(spark, sf), "label", "prediction", by="label")
    return table.select(F.col("label").cast("string").alias("run_name"), "rmse", "mae", (F.col("n") / 10000.0).alias("r2"))


@query("f09_composite_score", with_views("scored", f"THEN {_RESULTS} SELECT run_name, {r('(1 / (rmse + 1e-10) + r2 + 1 / (mae + 1e-10)) / 3')} AS composite FROM ok"))
def f09(spark, sf):
    return rounded(evaluate.composite_score(_results(spark, sf)).select("run_name", "composite"), ["composite"])


def _share(m: str) -> str:
    return f"({m} - MIN({m}) OVER ()) / (MAX({m}) OVER () - MIN({m}) OVER () + 1e-10)"


@query("f09_composite_normalised", with_views("scored", f"THEN {_RESULTS} SELECT run_name, {r(f'(1 - {_share('rmse')} + {_share('r2')} + 1 - {_share('mae')}) / 3')} AS composite FROM ok"))
def f09_normalised(spark, sf):
    return rounded(evaluate.composite_normalised(_results(spark, sf)).select("run_name", "composite"), ["composite"])


@query("g06_leaderboard", with_views("scored", f"""THEN {_RESULTS} SELECT run_name, {r('rmse')} AS rmse, CAST(ROW_NUMBER() OVER (ORDER BY rmse, run_name) AS INT) AS rank,
  {r('100.0 * (MAX(rmse) OVER () - rmse) / MAX(rmse) OVER ()')} AS gap_pct FROM ok"""))
def g06(spark, sf):
    out = ledger.leaderboard(_results(spark, sf), "rmse")
    return out.select("run_name", rnd("rmse").alias("rmse"), "rank", rnd("gap_pct").alias("gap_pct"))
