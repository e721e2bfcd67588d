"""Correlation, derivation-search and statistical selection queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import correlation as corr
from ..operators import charts, outliers, profile, select
from ..sources import views
from ..sources.views import DOC_COLS, ORDER_COLS, USER_COLS, with_views
from .profile_queries import _union, iqr_ctes
from .registry import query, rnd, rounded, sql_rnd as r

_PAIRS = [(a, b) for i, a in enumerate(ORDER_COLS) for b in ORDER_COLS[i + 1:]]
_TC = _union(f"SELECT '{c}' AS feature, CORR({c}, quality) AS corr, ABS(CORR({c}, quality)) AS corr_abs FROM order_features" for c in ORDER_COLS)


def _order(spark, sf):
    return views.order_features(spark, sf)


@query("c01_corr_long", with_views("order_features", _union(
    f"SELECT '{a}' AS f1, '{b}' AS f2, {'1.0::DOUBLE' if a == b else r(f'CORR({a}, {b})')} AS corr FROM {'(SELECT 1)' if a == b else 'order_features'}"
    for a in ORDER_COLS for b in ORDER_COLS)))
def c01(spark, sf):
    return rounded(corr.corr_long(_order(spark, sf), ORDER_COLS), ["corr"])


@query("c02_high_pairs", with_views("doc_features", f"""SELECT f1, f2, {r('corr')} AS corr FROM (
  SELECT 'n_chars' AS f1, 'spaces' AS f2, CORR(n_chars, spaces) AS corr FROM doc_features
  UNION ALL SELECT 'n_chars', 'quality', CORR(n_chars, quality) FROM doc_features
  UNION ALL SELECT 'spaces', 'quality', CORR(spaces, quality) FROM doc_features) WHERE ABS(corr) > 0.85"""))
def c02(spark, sf):
    return rounded(corr.high_pairs(views.doc_features(spark, sf), DOC_COLS + ["quality"]), ["corr"])


@query("c03_drop_collinear", with_views("doc_features", "SELECT doc_id, n_chars, lang, source, quality FROM doc_features"))
def c03(spark, sf):
    return corr.drop_collinear(views.doc_features(spark, sf), DOC_COLS)


@query("c04_target_corr", with_views("order_features", f"SELECT feature, {r('corr')} AS corr, {r('corr_abs')} AS corr_abs FROM ({_TC})"))
def c04(spark, sf):
    return rounded(corr.target_corr(_order(spark, sf), ORDER_COLS, "quality"), ["corr", "corr_abs"]).orderBy(F.desc("corr_abs"))


@query("c05_corr_tiers", with_views("order_features", f"""SELECT feature, {r('corr_abs')} AS corr_abs,
  CASE WHEN corr_abs > 0.2 THEN 'high' WHEN corr_abs > 0.1 THEN 'medium' ELSE 'low' END AS tier FROM ({_TC})"""))
def c05(spark, sf):
    out = corr.corr_tiers(corr.target_corr(_order(spark, sf), ORDER_COLS, "quality"))
    return rounded(out, ["corr_abs"]).select("feature", "corr_abs", "tier")


@query("c05_tier_selection", with_views("order_features", f"SELECT feature, {r('corr_abs')} AS corr_abs FROM ({_TC}) WHERE corr_abs > 0.1"))
def c05_selection(spark, sf):
    return rounded(corr.tier_selection(corr.target_corr(_order(spark, sf), ORDER_COLS, "quality")), ["corr_abs"])


@query("c06_corr_signs", with_views("order_features", f"""SELECT feature, {r('corr')} AS corr,
  CASE WHEN corr > 0 THEN 'positive' WHEN corr < 0 THEN 'negative' END AS sign, corr_abs < 0.1 AS is_low FROM ({_TC})"""))
def c06(spark, sf):
    out = corr.corr_signs(corr.target_corr(_order(spark, sf), ORDER_COLS, "quality"))
    return rounded(out, ["corr"]).select("feature", "corr", "sign", "is_low")


_V3 = ["sum_qty", "sum_price", "min_qty"]


def vif_cte(std: bool = False) -> str:
    """CTE ``vif`` (feature, vif) of three columns from the closed-form inverse."""
    a, b, c = _V3
    if std:
        pair = "CORR({x}, {y})"
    else:
        pair = "SUM({x} * {y}) / SQRT(SUM({x} * {x})) / SQRT(SUM({y} * {y}))"
    ab, ac, bc = pair.format(x=a, y=b), pair.format(x=a, y=c), pair.format(x=b, y=c)
    return f"""g AS (SELECT {ab} AS ab, {ac} AS ac, {bc} AS bc FROM order_features),
      d AS (SELECT *, 1 + 2 * ab * ac * bc - ab * ab - ac * ac - bc * bc AS det FROM g),
      vif AS (SELECT '{a}' AS feature, (1 - bc * bc) / det AS vif FROM d UNION ALL SELECT '{b}', (1 - ac * ac) / det FROM d
        UNION ALL SELECT '{c}', (1 - ab * ab) / det FROM d)"""


@query("c07_vif", with_views("order_features", "THEN " + vif_cte() + f" SELECT feature, {r('vif', 5)} AS vif FROM vif"))
def c07(spark, sf):
    return rounded(corr.vif(_order(spark, sf), _V3), ["vif"], 5)


@query("c07_vif_standardised", with_views("order_features", "THEN " + vif_cte(True) + f" SELECT feature, {r('vif', 5)} AS vif FROM vif"))
def c07_std(spark, sf):
    return rounded(corr.vif(_order(spark, sf), _V3, standardise=True), ["vif"], 5)


@query("c07_vif_all")
def c07_all(spark, sf):
    return rounded(corr.vif(_order(spark, sf), ORDER_COLS), ["vif"], 5)


@query("c08_vif_split", with_views("order_features", "THEN " + vif_cte() + f" SELECT feature, {r('vif', 5)} AS vif, vif < 10 AS selected FROM vif"))
def c08(spark, sf):
    return rounded(corr.vif_split(corr.vif(_order(spark, sf), _V3)), ["vif"], 5)


# Threshold 3 makes the first round drop a column; the two left have 1 / (1 - r²).
@query("c09_vif_prune", with_views("order_features", "THEN " + vif_cte() + f""",
  worst AS (SELECT feature, vif FROM vif ORDER BY vif DESC LIMIT 1),
  pair AS (SELECT CASE (SELECT feature FROM worst) WHEN '{_V3[0]}' THEN bc WHEN '{_V3[1]}' THEN ac ELSE ab END AS rr FROM g)
SELECT v.feature, CASE WHEN v.feature = (SELECT feature FROM worst) THEN {r('v.vif', 5)} ELSE {r('1 / (1 - rr * rr)', 5)} END AS vif,
  CASE WHEN v.feature = (SELECT feature FROM worst) THEN 1 END AS step FROM vif v, pair"""))
def c09(spark, sf):
    return rounded(corr.vif_prune(_order(spark, sf), _V3, threshold=3.0), ["vif"], 5)


_OPS = {"plus": "{a} + {b}", "minus": "{a} - {b}", "multiply": "{a} * {b}", "divide": "{a} / NULLIF({b}, 0)"}
_CATALOGUE = "cat AS (" + _union(
    f"SELECT '{a}' AS f1, '{b}' AS f2, '{o}' AS operation, '{a}_{o}_{b}' AS new_feature_name, CORR({e.format(a=a, b=b)}, quality) AS corr_raw FROM order_features"
    for a, b in _PAIRS for o, e in _OPS.items()) + ")"
_BEST = "best AS (SELECT * FROM cat QUALIFY ROW_NUMBER() OVER (PARTITION BY f1, f2 ORDER BY ABS(corr_raw) DESC, operation) = 1)"
_CAT_COLS = f"f1, f2, operation, new_feature_name, {r('ABS(corr_raw)')} AS corr_abs, {r('corr_raw')} AS corr_raw"


@query("c10_pair_search", with_views("order_features", f"THEN {_CATALOGUE} SELECT {_CAT_COLS} FROM cat"))
def c10(spark, sf):
    return rounded(corr.pair_search(_order(spark, sf), ORDER_COLS, "quality"), ["corr_abs", "corr_raw"])


@query("c11_best_operations", with_views("order_features", f"THEN {_CATALOGUE}, {_BEST} SELECT {_CAT_COLS} FROM best WHERE ABS(corr_raw) >= 0.3"))
def c11(spark, sf):
    best = corr.best_operations(corr.pair_search(_order(spark, sf), ORDER_COLS, "quality"), 0.3)
    return rounded(best, ["corr_abs", "corr_raw"]).orderBy(F.desc("corr_abs"))


def _by_name(name: str) -> str:
    return f"CASE {name} " + " ".join(f"WHEN '{c}' THEN CAST({c} AS DOUBLE)" for c in ORDER_COLS) + " END"


@query("v08_found_scatter", with_views("order_features", f"""THEN {_CATALOGUE}, {_BEST},
  top AS (SELECT f1, f2 FROM best WHERE corr_raw IS NOT NULL ORDER BY ROUND(ABS(corr_raw), 6) DESC, f1, f2 LIMIT 3)
SELECT row_id, quality AS label, f1 || '|' || f2 AS pair, {_by_name('f1')} AS x, {_by_name('f2')} AS y FROM order_features, top"""))
def v08_found(spark, sf):
    return charts.found_scatter(_order(spark, sf), "row_id", ORDER_COLS, "quality")


_RULES = [
    {"f1": "sum_qty", "f2": "min_qty", "operation": "divide", "new_feature_name": "sum_qty_divide_min_qty"},
    {"f1": "sum_price", "f2": "max_tax", "operation": "divide", "new_feature_name": "sum_price_divide_max_tax"},
    {"f1": "sum_qty", "f2": "sum_price", "operation": "plus", "new_feature_name": "sum_qty_plus_sum_price"},
    {"f1": "sum_qty", "f2": "avg_disc", "operation": "multiply", "new_feature_name": "sum_qty_multiply_avg_disc"},
    {"f1": "sum_price", "f2": "total_price", "operation": "minus", "new_feature_name": "sum_price_minus_total_price"},
    {"f1": "sum_qty", "f2": "not_there", "operation": "plus", "new_feature_name": "sum_qty_plus_not_there"},
]
_RULE_SQL = {
    "sum_qty_divide_min_qty": "COALESCE(sum_qty / NULLIF(min_qty, 0), 0)", "sum_price_divide_max_tax": "COALESCE(sum_price / NULLIF(max_tax, 0), 0)",
    "sum_qty_plus_sum_price": "sum_qty + sum_price", "sum_qty_multiply_avg_disc": "sum_qty * avg_disc",
    "sum_price_minus_total_price": "sum_price - total_price",
}


@query("c12_apply_catalogue", with_views("order_features", "SELECT row_id, " + ", ".join(f"{r(e, 4 if n.startswith('sum_price_divide') else 8)} AS {n}" for n, e in _RULE_SQL.items()) + " FROM order_features"))
def c12(spark, sf):
    out = corr.apply_catalogue(_order(spark, sf), _RULES).select("row_id", *_RULE_SQL)
    return rounded(rounded(out, [n for n in _RULE_SQL if n != "sum_price_divide_max_tax"], 8), ["sum_price_divide_max_tax"], 4)


@query("c13_serve_features", with_views("order_features", f"""SELECT row_id, {r(_RULE_SQL['sum_qty_multiply_avg_disc'], 8)} AS sum_qty_multiply_avg_disc,
  sum_qty, {r(_RULE_SQL['sum_price_divide_max_tax'], 4)} AS sum_price_divide_max_tax FROM order_features"""))
def c13(spark, sf):
    wanted = ["sum_qty_multiply_avg_disc", "sum_qty", "sum_price_divide_max_tax", "sum_qty_plus_not_there"]
    out = corr.serve_features(_order(spark, sf), _RULES, wanted, on_missing="skip", keep=("row_id",))
    return rounded(rounded(out, ["sum_qty_multiply_avg_disc"], 8), ["sum_price_divide_max_tax"], 4)


@query("c14_disjoint_pick", with_views("order_features", f"""THEN {_CATALOGUE}, {_BEST},
  offers AS (SELECT new_feature_name AS name, ROUND(ABS(corr_raw), 9) AS score, [f1, f2] AS parts FROM best
    UNION ALL SELECT feature, ROUND(corr_abs, 9), [feature] FROM ({_TC})),
  ranked AS (SELECT *, ROW_NUMBER() OVER (ORDER BY score DESC, name) AS rn FROM offers),
  walk AS (SELECT CAST(0 AS BIGINT) AS rn, CAST([] AS VARCHAR[]) AS used, CAST(NULL AS VARCHAR) AS name, CAST(NULL AS DOUBLE) AS score, FALSE AS taken
    UNION ALL SELECT k.rn, CASE WHEN LIST_HAS_ANY(w.used, k.parts) THEN w.used ELSE LIST_CONCAT(w.used, k.parts) END, k.name, k.score,
      NOT LIST_HAS_ANY(w.used, k.parts) FROM walk w JOIN ranked k ON k.rn = w.rn + 1)
SELECT name AS feature, {r('score')} AS score FROM walk WHERE taken""").replace("WITH ", "WITH RECURSIVE ", 1))
def c14(spark, sf):
    df = _order(spark, sf)
    best = corr.best_operations(corr.pair_search(df, ORDER_COLS, "quality"))
    base = {x["feature"]: round(x["corr_abs"], 9) for x in corr.target_corr(df, ORDER_COLS, "quality").collect()}
    taken = corr.disjoint_pick(best.withColumn("corr_abs", F.round("corr_abs", 9)), base)
    return rounded(spark.createDataFrame(taken, "feature string, score double"), ["score"])


@query("c16_derived_corr", with_views("order_features", _union(
    f"SELECT '{n}' AS feature, {r(f'CORR({e}, quality)')} AS corr FROM order_features" for n, e in _RULE_SQL.items())))
def c16(spark, sf):
    out = corr.target_corr(corr.apply_catalogue(_order(spark, sf), _RULES), list(_RULE_SQL), "quality")
    return rounded(out, ["corr"]).select("feature", "corr")


@query("c17_pareto", with_views("order_features", f"""THEN p AS ({_union(f"SELECT '{a}' AS f1, '{b}' AS f2, ABS(CORR({a}, {b})) AS a FROM order_features" for a, b in _PAIRS)}),
  red AS (SELECT feature, SUM(a) / {len(ORDER_COLS) - 1}.0 AS redundancy FROM (SELECT f1 AS feature, a FROM p UNION ALL SELECT f2, a FROM p) GROUP BY feature),
  s AS (SELECT t.feature, corr_abs AS relevance, redundancy, corr_abs / (1 + redundancy) AS score FROM ({_TC}) t JOIN red ON red.feature = t.feature)
SELECT feature, {r('relevance')} AS relevance, {r('redundancy')} AS redundancy, {r('score')} AS score FROM s ORDER BY s.score DESC LIMIT 4"""))
def c17(spark, sf):
    return rounded(corr.pareto(_order(spark, sf), ORDER_COLS, "quality", 4), ["relevance", "redundancy", "score"])


@query("c18_check_loop", with_views("order_features", "THEN " + vif_cte() + f"""
SELECT v.feature, {r('vif', 5)} AS vif, {r('corr_abs')} AS corr_abs,
  CASE WHEN corr_abs > 0.2 THEN 'high' WHEN corr_abs > 0.1 THEN 'medium' ELSE 'low' END AS tier
FROM vif v JOIN ({_TC}) t ON t.feature = v.feature WHERE vif < 10"""))
def c18(spark, sf):
    from .workflows import check_loop

    out = check_loop(_order(spark, sf), _V3, "quality")["selection"]
    return out.withColumns({"vif": rnd("vif", 5), "corr_abs": rnd("corr_abs")})


# ---- selection -----------------------------------------------------------


@query("l01_select_by_corr", with_views("order_features", f"SELECT feature, {r('corr_abs')} AS corr_abs FROM ({_TC}) WHERE corr_abs >= 0.1"))
def l01(spark, sf):
    out = select.by_correlation(corr.target_corr(_order(spark, sf), ORDER_COLS, "quality"))
    return rounded(out, ["corr_abs"]).select("feature", "corr_abs")


@query("l02_top_k_corr", with_views("order_features", f"SELECT feature, {r('corr_abs')} AS corr_abs FROM ({_TC}) t ORDER BY t.corr_abs DESC LIMIT 3"))
def l02(spark, sf):
    out = select.top_k(corr.target_corr(_order(spark, sf), ORDER_COLS, "quality"), "corr_abs", 3)
    return rounded(out, ["corr_abs"]).select("feature", "corr_abs")


def f_reg_sql(view: str, cols=ORDER_COLS) -> str:
    return _union(f"SELECT '{c}' AS feature, rr / (1 - rr) * (n - 2) AS f_score FROM (SELECT POW(CORR({c}, quality), 2) AS rr, COUNT(*) AS n FROM {view})" for c in cols)


@query("l03_f_regression", with_views("order_features", iqr_ctes("order_features", ORDER_COLS)
       + f" SELECT feature, {r('f_score', 3)} AS f_score FROM ({f_reg_sql('kept')}) t ORDER BY t.f_score DESC LIMIT 4"))
def l03(spark, sf):
    df = _order(spark, sf)
    kept = outliers.iqr_filter(df, outliers.iqr_fit(df, ORDER_COLS))
    return rounded(select.top_k(select.f_regression(kept, ORDER_COLS, "quality"), "f_score", 4), ["f_score"], 3)


def f_class_sql(cols=ORDER_COLS) -> str:
    return _union(f"""SELECT '{c}' AS feature, (SUM(n * POW(m - g, 2)) / (COUNT(*) - 1)) / (SUM(n * v) / (SUM(n) - COUNT(*))) AS f_score
      FROM (SELECT COUNT(*) AS n, AVG({c}) AS m, VAR_POP({c}) AS v FROM order_features GROUP BY quality), (SELECT AVG({c}) AS g FROM order_features)""" for c in cols)


@query("l04_f_classif", with_views("order_features", f"SELECT feature, {r('f_score', 3)} AS f_score FROM ({f_class_sql()})"))
def l04(spark, sf):
    return rounded(select.f_classif(_order(spark, sf), ORDER_COLS, "quality"), ["f_score"], 3)


def _bins(c: str, view: str) -> str:
    return " + ".join(f"CASE WHEN {c} > (SELECT QUANTILE_CONT({c}, {i / 10}) FROM {view}) THEN 1 ELSE 0 END" for i in range(1, 10))


def mi_sql(cols=ORDER_COLS, bin_label: str | None = None) -> str:
    y = _bins(bin_label, "order_features") if bin_label else "quality"
    return _union(f"""SELECT '{c}' AS feature, GREATEST(SUM(n / t * LN(n * t / nb / ny)), 0.0) AS mi FROM (
      SELECT CAST(COUNT(*) AS DOUBLE) AS n, CAST(SUM(COUNT(*)) OVER () AS DOUBLE) AS t, CAST(SUM(COUNT(*)) OVER (PARTITION BY b) AS DOUBLE) AS nb,
        CAST(SUM(COUNT(*)) OVER (PARTITION BY y) AS DOUBLE) AS ny FROM (SELECT {_bins(c, 'order_features')} AS b, {y} AS y FROM order_features) GROUP BY b, y)""" for c in cols)


@query("l05_mutual_information", with_views("order_features", f"SELECT feature, {r('mi')} AS mi FROM ({mi_sql()})"))
def l05(spark, sf):
    return rounded(select.binned_mutual_information(_order(spark, sf), ORDER_COLS, "quality"), ["mi"])


@query("l05_mutual_information_regression", with_views("order_features", f"SELECT feature, {r('mi')} AS mi FROM ({mi_sql(ORDER_COLS[1:], 'sum_qty')})"))
def l05_reg(spark, sf):
    return rounded(select.binned_mutual_information(_order(spark, sf), ORDER_COLS[1:], "sum_qty", bin_label=True), ["mi"])


@query("l06_low_variance", with_views("order_features", f"""THEN v AS ({_union(f"SELECT '{c}' AS feature, VAR_SAMP({c}) AS variance FROM order_features" for c in ORDER_COLS)})
SELECT feature, {r('variance', 8)} AS variance FROM v WHERE variance < (SELECT QUANTILE_CONT(variance, 0.01) FROM v)"""))
def l06(spark, sf):
    return rounded(select.low_variance(_order(spark, sf), ORDER_COLS), ["variance"], 8)


def _mm(c: str) -> str:
    return f"({c} - MIN({c}) OVER ()) / (MAX({c}) OVER () - MIN({c}) OVER ())"


_F_MI = f"fr AS ({f_reg_sql('order_features')}), mi AS ({mi_sql()})"


@query("l13_join_scores", with_views("order_features", f"""THEN {_F_MI} SELECT fr.feature, {r('f_score', 3)} AS f_score, {r('mi')} AS mi,
  {r(_mm('f_score'))} AS f_norm, {r(_mm('mi'))} AS mi_norm FROM fr JOIN mi ON mi.feature = fr.feature"""))
def l13(spark, sf):
    df = _order(spark, sf)
    out = select.join_scores(select.f_regression(df, ORDER_COLS, "quality"), select.binned_mutual_information(df, ORDER_COLS, "quality"))
    return out.withColumns({"f_score": rnd("f_score", 3), "mi": rnd("mi"), "f_norm": rnd("f_norm"), "mi_norm": rnd("mi_norm")})


_TOP_F = "tf AS (SELECT feature FROM fr ORDER BY f_score DESC LIMIT 3)"
_TOP_MI = "tm AS (SELECT feature FROM mi ORDER BY mi DESC LIMIT 3)"


@query("l14_common_and_all", with_views("order_features", f"""THEN {_F_MI}, {_TOP_F}, {_TOP_MI}
SELECT feature, feature IN (SELECT feature FROM tf) AND feature IN (SELECT feature FROM tm) AS in_both
FROM (SELECT feature FROM tf UNION SELECT feature FROM tm)"""))
def l14(spark, sf):
    df = _order(spark, sf)
    f = select.top_k(select.f_regression(df, ORDER_COLS, "quality"), "f_score", 3)
    mi = select.top_k(select.binned_mutual_information(df, ORDER_COLS, "quality"), "mi", 3)
    return select.common_and_all(f, mi)


METHODS = ["anova", "corr", "f_test", "mi"]
_PICKS = f"""{_F_MI}, {_TOP_F}, {_TOP_MI}, an AS ({f_class_sql()}), picks AS (
  SELECT 'anova' AS method, feature FROM (SELECT feature FROM an ORDER BY f_score DESC LIMIT 3) UNION ALL
  SELECT 'corr', feature FROM ({_TC}) WHERE corr_abs >= 0.1 UNION ALL SELECT 'f_test', feature FROM tf UNION ALL SELECT 'mi', feature FROM tm)"""


def stat_picks(df, cols, label, k=3):
    tagged = {
        "anova": select.top_k(select.f_classif(df, cols, label), "f_score", k),
        "corr": select.by_correlation(corr.target_corr(df, cols, label)),
        "f_test": select.top_k(select.f_regression(df, cols, label), "f_score", k),
        "mi": select.top_k(select.binned_mutual_information(df, cols, label), "mi", k),
    }
    parts = [t.select(F.lit(m).alias("method"), "feature") for m, t in tagged.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("l15_vote", with_views("order_features", f"""THEN {_PICKS} SELECT feature, COUNT(*) AS votes, COUNT(*) >= 2 AS by_half, COUNT(*) = 4 AS by_all
FROM picks GROUP BY feature"""))
def l15(spark, sf):
    return select.vote(stat_picks(_order(spark, sf), ORDER_COLS, "quality"), len(METHODS))


@query("l16_removal_candidates", with_views("order_features", f"""THEN {_PICKS}, v AS ({_union(f"SELECT '{c}' AS feature, VAR_SAMP({c}) AS variance FROM order_features" for c in ORDER_COLS)}),
  reasons AS (SELECT feature, 'few votes' AS reason FROM v WHERE (SELECT COUNT(*) FROM picks WHERE picks.feature = v.feature) < 2
    UNION ALL SELECT feature, 'low variance' FROM v WHERE variance < (SELECT QUANTILE_CONT(variance, 0.01) FROM v)
    UNION ALL SELECT feature, 'low correlation' FROM ({_TC}) WHERE corr_abs < 0.1)
SELECT feature, STRING_AGG(reason, ', ' ORDER BY reason) AS reasons FROM reasons GROUP BY feature"""))
def l16(spark, sf):
    df = _order(spark, sf)
    features = spark.createDataFrame([(c,) for c in ORDER_COLS], "feature string")
    votes = select.vote(stat_picks(df, ORDER_COLS, "quality"), len(METHODS))
    few = features.join(votes.filter("by_half"), "feature", "left_anti")
    low = corr.target_corr(df, ORDER_COLS, "quality").filter("corr_abs < 0.1")
    return select.removal_candidates({"few votes": few, "low variance": select.low_variance(df, ORDER_COLS), "low correlation": low})


_W = select.RANK_WEIGHTS


@query("l17_weighted_rank_statistics", with_views("order_features", "THEN " + vif_cte() + f""", fr AS ({f_reg_sql('order_features', _V3)}), mi AS ({mi_sql(_V3)}),
  t AS (SELECT vif.feature, vif, corr_abs, f_score, mi FROM vif JOIN ({_TC}) c ON c.feature = vif.feature JOIN fr ON fr.feature = vif.feature JOIN mi ON mi.feature = vif.feature),
  n AS (SELECT feature, 1 - {_mm('vif')} AS vif_norm, {_mm('corr_abs')} AS corr_norm, {_mm('f_score')} AS f_score_norm, {_mm('mi')} AS mi_norm FROM t)
SELECT feature, {r(f"vif_norm * {_W['vif']} + corr_norm * {_W['corr']} + f_score_norm * {_W['f_score']} + mi_norm * {_W['mi']}")} AS total FROM n"""))
def l17_statistics(spark, sf):
    df = _order(spark, sf)
    scores = {
        "vif": corr.vif(df, _V3), "corr": corr.target_corr(df, _V3, "quality").select("feature", F.col("corr_abs").alias("corr")),
        "f_score": select.f_regression(df, _V3, "quality"), "mi": select.binned_mutual_information(df, _V3, "quality"),
    }
    return select.weighted_rank(scores).select("feature", rnd("total").alias("total"))


@query("l18_method_matrix", with_views("order_features", f"THEN {_PICKS} SELECT feature, " + ", ".join(
    f"CAST(MAX(CASE WHEN method = '{m}' THEN 1 ELSE 0 END) AS INT) AS {m}" for m in METHODS) + " FROM picks GROUP BY feature"))
def l18(spark, sf):
    return select.method_matrix(stat_picks(_order(spark, sf), ORDER_COLS, "quality"), METHODS)
