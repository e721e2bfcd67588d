"""Profiling and chart-data queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import charts, outliers, profile, splits
from ..session import cut_lineage
from ..sources import views
from ..sources.views import DOC_COLS, LINE_COLS, ORDER_COLS, with_views
from .registry import query, rnd, rounded, sql_rnd as r

_union = " UNION ALL ".join


def _describe_sql(view: str, col: str, extra: str = "") -> str:
    return (
        f"SELECT {extra}'{col}' AS feature, COUNT({col}) AS n, {r(f'AVG({col})', 5)} AS mean, {r(f'STDDEV_SAMP({col})', 5)} AS std, "
        f"{r(f'MIN({col})')} AS min, {r(f'QUANTILE_CONT({col}, 0.25)')} AS q25, {r(f'QUANTILE_CONT({col}, 0.5)')} AS q50, "
        f"{r(f'QUANTILE_CONT({col}, 0.75)')} AS q75, {r(f'MAX({col})')} AS max FROM {view}"
    )


_DOC_TYPES = {"doc_id": "bigint", "n_chars": "double", "spaces": "double", "lang": "string", "source": "string", "quality": "int"}


@query("p01_shape_report", with_views("doc_features", _union(
    f"SELECT '{c}' AS \"column\", '{t}' AS dtype, COUNT(*) AS n_rows, COUNT({c}) AS non_null FROM doc_features"
    for c, t in _DOC_TYPES.items())))
def p01(spark, sf):
    return profile.shape_report(views.doc_features(spark, sf))


@query("p02_describe", with_views("line_features", _union(_describe_sql("line_features", c) for c in LINE_COLS)))
def p02(spark, sf):
    out = profile.describe(views.line_features(spark, sf), LINE_COLS)
    return rounded(rounded(out, ["mean", "std"], 5), ["min", "q25", "q50", "q75", "max"])


@query("p03_null_counts", with_views("doc_features", "SELECT * FROM (" + _union(
    f"SELECT '{c}' AS \"column\", COUNT(*) - COUNT({c}) AS n_null, COUNT(*) AS n_rows FROM doc_features" for c in _DOC_TYPES
) + ") WHERE n_null > 0"))
def p03(spark, sf):
    return profile.null_counts(views.doc_features(spark, sf))


_SHARES = "SELECT quality AS label, COUNT(*) AS n, 100.0 * CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER () AS share FROM order_features GROUP BY quality"


@query("p04_target_distribution", with_views("order_features", f"SELECT label, n, {r('share')} AS share FROM ({_SHARES})"))
def p04(spark, sf):
    return rounded(profile.class_shares(views.order_features(spark, sf), "quality"), ["share"]).orderBy("label")


@query("p05a_imbalance_share", with_views("order_features", f"""
SELECT minority, COUNT(*) AS n_classes, CAST(SUM(n) AS BIGINT) AS n_rows, {r('SUM(share)')} AS share
FROM (SELECT n, share, share < 100.0 / 7 AS minority FROM ({_SHARES})) GROUP BY minority"""))
def p05a(spark, sf):
    return rounded(profile.imbalance_by_share(views.order_features(spark, sf), "quality", parts=7), ["share"])


@query("p05b_imbalance_ratio", with_views("order_features", f"""
SELECT MAX(n) AS max_n, MIN(n) AS min_n, {r('CAST(MAX(n) AS DOUBLE) / MIN(n)')} AS ratio,
  FIRST(label ORDER BY n DESC, label) AS largest, FIRST(label ORDER BY n, label) AS smallest FROM ({_SHARES})"""))
def p05b(spark, sf):
    return rounded(profile.imbalance_ratio(views.order_features(spark, sf), "quality"), ["ratio"])


@query("p06_split_shares", with_views("order_features", f"""
SELECT quality AS label, COUNT(*) AS n_full, COUNT(*) FILTER (split = 'train') AS n_train, COUNT(*) FILTER (split = 'test') AS n_test,
  {r("100.0 * COUNT(*) / SUM(COUNT(*)) OVER ()")} AS share_full,
  {r("100.0 * COUNT(*) FILTER (split = 'train') / SUM(COUNT(*) FILTER (split = 'train')) OVER ()")} AS share_train,
  {r("100.0 * COUNT(*) FILTER (split = 'test') / SUM(COUNT(*) FILTER (split = 'test')) OVER ()")} AS share_test
FROM (SELECT quality, CASE WHEN ROW_NUMBER() OVER (PARTITION BY quality ORDER BY md5(concat('42:', row_id)), row_id)
        <= FLOOR(0.2 * COUNT(*) OVER (PARTITION BY quality) + 0.5) THEN 'test' ELSE 'train' END AS split FROM order_features)
GROUP BY quality"""))
def p06(spark, sf):
    parts = splits.stratified_split(views.order_features(spark, sf), "row_id", "quality", 0.2)
    return rounded(profile.class_shares_by_split(parts, "quality", "split"), ["share_full", "share_train", "share_test"])


@query("p07_duplicates", "SELECT COUNT(*) AS n_rows, COUNT(DISTINCT text) AS n_distinct, COUNT(*) - COUNT(DISTINCT text) AS n_duplicates FROM documents")
def p07(spark, sf):
    return profile.duplicate_count(views.table(spark, sf, "documents"), ["text"])


@query("p07_drop_duplicates", "SELECT MIN(doc_id) AS doc_id, FIRST(n_chars ORDER BY doc_id) AS n_chars FROM documents GROUP BY text")
def p07_drop(spark, sf):
    return profile.drop_duplicates(views.table(spark, sf, "documents"), ["text"], "doc_id").select("doc_id", "n_chars")


def _moment_sql(view: str, col: str) -> str:
    return f"""SELECT '{col}' AS feature, COUNT({col}) AS n,
      AVG(POW({col} - m, 3)) / POW(AVG(POW({col} - m, 2)), 1.5) AS skewness,
      AVG(POW({col} - m, 4)) / POW(AVG(POW({col} - m, 2)), 2) - 3 AS kurtosis
      FROM {view}, (SELECT AVG({col}) AS m FROM {view})"""


@query("p08_skew_screen", with_views("doc_features", f"SELECT feature, {r('skewness')} AS skewness FROM ("
       + _union(_moment_sql("doc_features", c) for c in DOC_COLS) + ") WHERE ABS(skewness) > 1"))
def p08(spark, sf):
    return rounded(profile.skew_screen(views.doc_features(spark, sf), DOC_COLS, 1.0), ["skewness"])


@query("p09_normality", with_views("order_features", f"""SELECT feature, n, {r('skewness', 5)} AS skewness, {r('kurtosis', 5)} AS kurtosis,
  {r('jb', 3)} AS jb, {r('EXP(-jb / 2)')} AS p_value, EXP(-jb / 2) > 0.05 AS normal FROM (
  SELECT *, n / 6.0 * (POW(skewness, 2) + POW(kurtosis, 2) / 4.0) AS jb FROM (
  """ + _union(_moment_sql("order_features", c) for c in ORDER_COLS) + "))"))
def p09(spark, sf):
    out = profile.normality(views.order_features(spark, sf), ORDER_COLS)
    return out.withColumns({"skewness": rnd("skewness", 5), "kurtosis": rnd("kurtosis", 5), "jb": rnd("jb", 3), "p_value": rnd("p_value")})


def _ks_sql(col: str) -> str:
    t = f"(1 / (1 + {profile.NORMAL_SCALE} * ABS(z)))"
    poly = " + ".join(f"({b}) * POW({t}, {i})" for i, b in enumerate(profile.NORMAL_TERMS, 1))
    return f"""SELECT '{col}' AS feature, CAST(MAX(n) AS BIGINT) AS n, MAX(GREATEST(ABS(p - (upto - w) / n), ABS(p - upto / n))) AS ks FROM (
      SELECT *, CASE WHEN z < 0 THEN tail ELSE 1 - tail END AS p FROM (SELECT *, ({poly}) * EXP(-z * z / 2) / SQRT(2 * PI()) AS tail FROM (
      SELECT (v - m) / s AS z, w, CAST(SUM(w) OVER (ORDER BY v) AS DOUBLE) AS upto, n FROM
        (SELECT {col} AS v, COUNT(*) AS w FROM order_features WHERE {col} IS NOT NULL GROUP BY 1),
        (SELECT AVG({col}) AS m, STDDEV_SAMP({col}) AS s, COUNT({col}) AS n FROM order_features))))"""


_KS_P = " + ".join(f"{2 if k % 2 else -2} * EXP(-2.0 * {k * k} * x * x)" for k in range(1, 31))


@query("p09_ks_normality", with_views("order_features", f"""SELECT feature, n, {r('ks', 5)} AS ks, {r('p', 4)} AS p_value, p > 0.05 AS normal FROM (
  SELECT *, CASE WHEN x < 0.2 THEN 1.0 ELSE LEAST(GREATEST({_KS_P}, 0.0), 1.0) END AS p FROM (
  SELECT *, (SQRT(n) + 0.12 + 0.11 / SQRT(n)) * ks AS x FROM ({_union(_ks_sql(c) for c in ORDER_COLS)})))"""))
def p09_ks(spark, sf):
    out = profile.ks_normality(views.order_features(spark, sf), ORDER_COLS)
    return out.withColumns({"ks": rnd("ks", 5), "p_value": rnd("p_value", 4)})


@query("p10_category_counts", with_views("doc_features", _union(
    f"SELECT '{c}' AS \"column\", {c} AS value, COUNT(*) AS n FROM doc_features GROUP BY {c}" for c in ("lang", "source"))))
def p10(spark, sf):
    return profile.category_counts(views.doc_features(spark, sf), ["lang", "source"])


def iqr_ctes(view: str, cols, factor: float = 1.5, votes: int = 1, name: str = "kept") -> str:
    """CTEs ``bounds`` (one row) and ``<name>`` (rows flagged in fewer than ``votes`` columns)."""
    bounds = ", ".join(f"QUANTILE_CONT({c}, 0.25) AS {c}_a, QUANTILE_CONT({c}, 0.75) AS {c}_b" for c in cols)
    flags = " + ".join(
        f"CASE WHEN {c} < {c}_a - {factor} * ({c}_b - {c}_a) OR {c} > {c}_b + {factor} * ({c}_b - {c}_a) THEN 1 ELSE 0 END" for c in cols)
    return (f"THEN bounds AS (SELECT {bounds} FROM {view}), flagged AS (SELECT v.*, {flags} AS votes FROM {view} v, bounds), "
            f"{name} AS (SELECT * FROM flagged WHERE votes < {votes})")


def _side(view: str, name: str, col: str) -> str:
    return (f"SELECT '{col}' AS feature, COUNT({col}) AS {name}_n, AVG({col}) AS {name}_mean, STDDEV_SAMP({col}) AS {name}_std, "
            f"MIN({col}) AS {name}_min, MAX({col}) AS {name}_max FROM {view}")


@query("p11_compare_stats", with_views("order_features", iqr_ctes("order_features", ORDER_COLS) + f"""
SELECT b.feature, before_n, {r('before_mean', 4)} AS before_mean, {r('before_std', 4)} AS before_std, before_min, before_max,
  after_n, {r('after_mean', 4)} AS after_mean, {r('after_std', 4)} AS after_std, after_min, after_max,
  {r('after_mean - before_mean', 4)} AS mean_diff, {r('after_std - before_std', 4)} AS std_diff
FROM ({_union(_side('order_features', 'before', c) for c in ORDER_COLS)}) b
JOIN ({_union(_side('kept', 'after', c) for c in ORDER_COLS)}) a ON a.feature = b.feature"""))
def p11(spark, sf):
    df = views.order_features(spark, sf)
    kept = outliers.iqr_filter(df, outliers.iqr_fit(df, ORDER_COLS))
    out = profile.compare_stats(df, kept, ORDER_COLS)
    return rounded(out, ["before_mean", "before_std", "after_mean", "after_std", "mean_diff", "std_diff"], 4)


_Q3 = "QUANTILE_CONT({c}, 0.25) AS q25, QUANTILE_CONT({c}, 0.5) AS q50, QUANTILE_CONT({c}, 0.75) AS q75"


@query("p13_class_box", with_views("order_features", _union(
    f"SELECT quality AS label, '{c}' AS feature, COUNT({c}) AS n, {r(f'MIN({c})')} AS min, {r(f'QUANTILE_CONT({c}, 0.25)')} AS q25, "
    f"{r(f'QUANTILE_CONT({c}, 0.5)')} AS q50, {r(f'QUANTILE_CONT({c}, 0.75)')} AS q75, {r(f'MAX({c})')} AS max FROM order_features GROUP BY quality"
    for c in ORDER_COLS)))
def p13(spark, sf):
    return rounded(profile.class_box(views.order_features(spark, sf), ORDER_COLS, "quality"), ["min", "q25", "q50", "q75", "max"])


def hist_sql(source: str, cols, bins: int) -> str:
    """Histogram rows of several columns of a view or parenthesised query."""
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS feature, CAST(i AS INT) AS bin, {r(f'lo + (hi - lo) * i / {bins}')} AS lo,
          {r(f'lo + (hi - lo) * (i + 1) / {bins}')} AS hi, COALESCE(n, 0) AS n
        FROM (SELECT MIN({c}) AS lo, MAX({c}) AS hi FROM {source}) CROSS JOIN RANGE({bins}) g(i) LEFT JOIN (
          SELECT CAST(LEAST(FLOOR(({c} - lo) / (hi - lo) * {float(bins)}), {bins - 1}) AS INT) AS b, COUNT(*) AS n
          FROM {source}, (SELECT MIN({c}) AS lo, MAX({c}) AS hi FROM {source}) WHERE {c} IS NOT NULL GROUP BY 1) ON b = i""")
    return _union(parts)


@query("v01_histogram", with_views("line_features", hist_sql("line_features", LINE_COLS, 30)))
def v01(spark, sf):
    return rounded(charts.histogram(views.line_features(spark, sf), LINE_COLS, 30), ["lo", "hi"])


def kde_sql(by: str | None, points: int = 32) -> str:
    g = by or "0"
    return f"""kde AS (SELECT g AS label, CAST(i AS INT) AS point, MAX(lo + (hi - lo) * i / {points - 1}.0) AS x,
      SUM(w * EXP(-0.5 * POW((lo + (hi - lo) * i / {points - 1}.0 - v) / h, 2))) / (MAX(n) * MAX(h) * SQRT(2.0 * PI())) AS density
      FROM (SELECT {g} AS g, value AS v, COUNT(*) AS w FROM event_values GROUP BY 1, 2) t
      JOIN (SELECT {g} AS bg, COUNT(*) AS n, MIN(value) AS lo, MAX(value) AS hi, STDDEV_SAMP(value) * POW(COUNT(*), -0.2) AS h
            FROM event_values GROUP BY 1) b ON t.g = b.bg CROSS JOIN RANGE({points}) p(i) GROUP BY 1, 2)"""


@query("v02_kde", with_views("event_values", "THEN " + kde_sql("event_type") + f" SELECT label, point, {r('x')} AS x, {r('density')} AS density FROM kde"))
def v02(spark, sf):
    return rounded(charts.kde(views.event_values(spark, sf), "value", by="event_type"), ["x", "density"])


@query("v02_kde_whole", with_views("event_values", "THEN " + kde_sql(None) + f" SELECT point, {r('x')} AS x, {r('density')} AS density FROM kde"))
def v02_whole(spark, sf):
    return rounded(charts.kde(views.event_values(spark, sf), "value"), ["x", "density"])


def _box_sql(source: str, col: str, extra: str) -> str:
    inside = f"{col} >= q25 - 1.5 * (q75 - q25) AND {col} <= q75 + 1.5 * (q75 - q25)"
    quart = _Q3.format(c=col)
    return f"""SELECT {extra} '{col}' AS feature, COUNT({col}) AS n, {r('MAX(q25)')} AS q25, {r('MAX(q50)')} AS q50, {r('MAX(q75)')} AS q75,
      {r(f'MIN(CASE WHEN {inside} THEN {col} END)')} AS whisker_lo, {r(f'MAX(CASE WHEN {inside} THEN {col} END)')} AS whisker_hi,
      COUNT(*) FILTER (NOT ({inside})) AS n_out FROM {source}, (SELECT {quart} FROM {source})"""


@query("v03_box_before_after", with_views("order_features", iqr_ctes("order_features", ORDER_COLS) + " " + _union(
    [_box_sql("order_features", c, "'before' AS stage,") for c in ORDER_COLS] + [_box_sql("kept", c, "'after' AS stage,") for c in ORDER_COLS])))
def v03(spark, sf):
    df = cut_lineage(views.order_features(spark, sf))  # bounds, quantiles and boxes read it several times
    kept = outliers.iqr_filter(df, outliers.iqr_fit(df, ORDER_COLS))
    return rounded(charts.box_before_after(df, kept, ORDER_COLS), ["q25", "q50", "q75", "whisker_lo", "whisker_hi"])


@query("v04_violin", with_views("event_values", "THEN " + kde_sql("event_type") + f"""
SELECT label, point, {r('x')} AS x, {r('density')} AS density, {r('q25')} AS q25, {r('q50')} AS q50, {r('q75')} AS q75
FROM kde JOIN (SELECT event_type, {_Q3.format(c='value')} FROM event_values GROUP BY 1) ON label = event_type"""))
def v04(spark, sf):
    return rounded(charts.violin(views.event_values(spark, sf), "value", "event_type"), ["x", "density", "q25", "q50", "q75"])


@query("v05_pair_sample", with_views("order_features", """SELECT row_id, sum_qty, sum_price, min_qty, quality FROM order_features
ORDER BY md5(concat('42:', row_id)), row_id LIMIT 800"""))
def v05(spark, sf):
    return charts.pair_sample(views.order_features(spark, sf), "row_id", ["sum_qty", "sum_price", "min_qty"], "quality", 800)


@query("v06_corr_triangle", with_views("order_features", _union(
    f"SELECT '{b}' AS f1, '{a}' AS f2, {r(f'CORR({b}, {a})')} AS corr FROM order_features"
    for i, a in enumerate(ORDER_COLS + ["quality"]) for b in (ORDER_COLS + ["quality"])[i + 1:])))
def v06(spark, sf):
    return rounded(charts.corr_triangle(views.order_features(spark, sf), ORDER_COLS + ["quality"]), ["corr"])


@query("v07_residual_bins", with_views("scored", hist_sql("(SELECT label - prediction AS residual FROM scored)", ["residual"], 20)))
def v07(spark, sf):
    return rounded(charts.residual_bins(views.scored(spark, sf), "label", "prediction", 20), ["lo", "hi"])


@query("v07_predicted_distribution", with_views("scored", """
SELECT COALESCE(a.v, p.v) AS value, CAST(COALESCE(na, 0) AS BIGINT) AS n_actual, CAST(COALESCE(np, 0) AS BIGINT) AS n_predicted
FROM (SELECT label AS v, COUNT(*) AS na FROM scored GROUP BY 1) a FULL JOIN
     (SELECT CAST(ROUND_EVEN(prediction, 0) AS INT) AS v, COUNT(*) AS np FROM scored GROUP BY 1) p ON a.v = p.v"""))
def v07_dist(spark, sf):
    return charts.predicted_distribution(views.scored(spark, sf), "label", "prediction")


_SCATTER = [("sum_qty", "sum_price"), ("sum_qty", "min_qty")]


@query("v08_interaction_scatter", with_views("order_features", "THEN s AS (SELECT * FROM order_features ORDER BY md5(concat('42:', row_id)), row_id LIMIT 500) "
       + _union(f"SELECT row_id, quality AS label, '{a}|{b}' AS pair, {a} AS x, {b} AS y FROM s" for a, b in _SCATTER)))
def v08(spark, sf):
    return charts.interaction_scatter(views.order_features(spark, sf), "row_id", _SCATTER, "quality", 500)
