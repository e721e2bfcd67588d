"""Derivation, outlier, missing-value and scaling queries with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.stats import numeric_columns
from ..operators import derive, impute, outliers, profile, scale, splits
from ..session import cut_lineage
from ..sources import tables, views
from ..sources.views import DOC_COLS, LINE_COLS, ORDER_COLS, with_views
from .profile_queries import _union, iqr_ctes
from .registry import query, rnd, rounded, sql_rnd as r

# ---- row functions -------------------------------------------------------

_OF = "FROM order_features"


@query("r01_ratio_epsilon", with_views("order_features", f"SELECT row_id, {r('sum_qty / (avg_disc + 1e-6)', 4)} AS qty_per_disc {_OF}"))
def r01(spark, sf):
    return views.order_features(spark, sf).select("row_id", rnd(derive.ratio("sum_qty", "avg_disc"), 4).alias("qty_per_disc"))


@query("r02_ratio_null_fill", with_views("order_features", f"""SELECT row_id, {r('sum_qty / NULLIF(max_tax, 0)', 4)} AS ratio,
  {r('COALESCE(sum_qty / NULLIF(max_tax, 0), 0)', 4)} AS ratio_filled {_OF}"""))
def r02(spark, sf):
    return views.order_features(spark, sf).select(
        "row_id", rnd(derive.ratio_or_null("sum_qty", "max_tax"), 4).alias("ratio"),
        rnd(derive.ratio_or_null("sum_qty", "max_tax", 0.0), 4).alias("ratio_filled"))


@query("r03_sum_difference_product", with_views("order_features", f"""SELECT row_id, {r('sum_qty + min_qty', 8)} AS total,
  {r('total_price - sum_price', 8)} AS unbound, {r('sum_qty * avg_disc', 8)} AS body {_OF}"""))
def r03(spark, sf):
    df = views.order_features(spark, sf)
    out = derive.derive(df, {"total": F.col("sum_qty") + F.col("min_qty"), "unbound": F.col("total_price") - F.col("sum_price"),
                             "body": F.col("sum_qty") * F.col("avg_disc")})
    return rounded(out.select("row_id", "total", "unbound", "body"), ["total", "unbound", "body"], 8)


@query("r04_dissociation", with_views("order_features", f"SELECT row_id, {r('sum_qty / (1 + POW(10, max_tax * 30 - 1.81))')} AS molecular {_OF}"))
def r04(spark, sf):
    df = views.order_features(spark, sf).withColumn("ph", F.col("max_tax") * 30)
    return df.select("row_id", rnd(derive.dissociated("sum_qty", "ph")).alias("molecular"))


@query("r05_log_features", with_views("doc_features", f"SELECT doc_id, {r('LN(1 + n_chars)')} AS log_n_chars, {r('LN(1 + spaces)')} AS log_spaces FROM doc_features"))
def r05(spark, sf):
    df = views.doc_features(spark, sf)
    out = derive.log_features(df, derive.log_columns_fit(df, DOC_COLS))
    return rounded(out.select("doc_id", "log_n_chars", "log_spaces"), ["log_n_chars", "log_spaces"])


@query("r05_log_replace", with_views("doc_features", f"SELECT doc_id, lang, source, quality, {r('LN(1 + n_chars)')} AS n_chars_log, {r('LN(1 + spaces)')} AS spaces_log FROM doc_features"))
def r05_replace(spark, sf):
    return rounded(derive.log_features(views.doc_features(spark, sf), DOC_COLS, "replace"), ["n_chars_log", "spaces_log"])


_R6 = ["sum_qty", "avg_disc", "min_qty"]
_R6_PAIRS = [("sum_qty", "avg_disc"), ("sum_qty", "min_qty"), ("avg_disc", "min_qty")]


@query("r06_pair_products", with_views("order_features", "SELECT row_id, " + ", ".join(
    f"{r(f'{a} * {b}', 8)} AS {a}_mul_{b}, {r(f'{a} / ({b} + 1e-6)', 8)} AS {a}_div_{b}" for a, b in _R6_PAIRS) + f" {_OF}"))
def r06(spark, sf):
    out = derive.pair_products(views.order_features(spark, sf).select("row_id", *_R6), _R6).drop(*_R6)
    return rounded(out, out.columns[1:], 8)


@query("r07_poly2", with_views("order_features", "SELECT row_id, " + ", ".join(
    [f"{r(f'{c} * {c}', 8)} AS poly_{c}_2" for c in _R6] + [f"{r(f'{a} * {b}', 8)} AS poly_{a}_{b}" for a, b in _R6_PAIRS]) + f" {_OF}"))
def r07(spark, sf):
    out = derive.poly2(views.order_features(spark, sf).select("row_id", *_R6), _R6).drop(*_R6)
    return rounded(out, out.columns[1:], 8)


@query("r07_poly2_interactions", with_views("order_features", "SELECT row_id, " + ", ".join(
    f"{r(f'{a} * {b}', 8)} AS poly_{a}_{b}" for a, b in _R6_PAIRS) + f" {_OF}"))
def r07_inter(spark, sf):
    out = derive.poly2(views.order_features(spark, sf).select("row_id", *_R6), _R6, interaction_only=True).drop(*_R6)
    return rounded(out, out.columns[1:], 8)


# The order table in the column names that the domain bundles expect.
DOMAIN = {
    "fixed_acidity": "sum_qty", "volatile_acidity": "max_tax", "citric_acid": "avg_disc", "residual_sugar": "min_qty",
    "free_sulfur_dioxide": "sum_price", "total_sulfur_dioxide": "total_price", "alcohol": "sum_qty + min_qty",
    "density": "1 + avg_disc", "ph": "2 + max_tax * 20", "sulphates": "max_tax + avg_disc", "chlorides": "avg_disc * max_tax",
}
_DOMAIN_CTE = "THEN domain AS (SELECT row_id, " + ", ".join(f"{e} AS {n}" for n, e in DOMAIN.items()) + f" {_OF}) "
_DOMAIN_SQL = {
    "ratios_and_logs": {
        "sugar_acid_ratio": "residual_sugar / (fixed_acidity + 1e-6)", "sulfur_ratio": "free_sulfur_dioxide / (total_sulfur_dioxide + 1e-6)",
        "alcohol_density_ratio": "alcohol / (density + 1e-6)", "ph_sulphate_ratio": "ph / (sulphates + 1e-6)",
        "acid_ratio_2": "citric_acid / (volatile_acidity + 1e-6)",
        **{f"log_{c}": f"LN(1 + {c})" for c in ("residual_sugar", "chlorides", "sulphates", "volatile_acidity", "citric_acid")}},
    "acidity_and_body": {
        "total_acidity": "fixed_acidity + volatile_acidity",
        "sugar_acidity_ratio": "residual_sugar / (fixed_acidity + volatile_acidity + 1e-6)",
        "density_alcohol_ratio": "density / (alcohol + 1e-6)", "so2_ratio": "free_sulfur_dioxide / (total_sulfur_dioxide + 1e-6)"},
    "acid_balance": {
        "total_acidity": "fixed_acidity + volatile_acidity", "acidity_ratio": "fixed_acidity / (volatile_acidity + 1e-6)",
        "sugar_to_acid": "residual_sugar / (fixed_acidity + 1e-6)", "density_to_alcohol": "density / (alcohol + 1e-6)"},
    "expert": {
        "total_acidity": "fixed_acidity + volatile_acidity", "acidity_ratio": "fixed_acidity / (volatile_acidity + 1e-6)",
        "sugar_to_acidity": "residual_sugar / (fixed_acidity + volatile_acidity + 1e-6)", "alcohol_density": "alcohol * density"},
    "sulfur": {
        "total_acidity": "fixed_acidity + volatile_acidity", "free_sulfur_ratio": "free_sulfur_dioxide / (total_sulfur_dioxide + 1e-5)",
        "alcohol_sugar_ratio": "alcohol / (residual_sugar + 1e-5)", "bound_sulfur_dioxide": "total_sulfur_dioxide - free_sulfur_dioxide"},
    "merged": {"total_acidity": "fixed_acidity + volatile_acidity", "alcohol_density": "COALESCE(alcohol / NULLIF(density, 0), 0)"},
    "chemistry": {
        "molecular_so2": "free_sulfur_dioxide / (1 + POW(10, ph - 1.81))", "acidity_ratio": "fixed_acidity / (volatile_acidity + 1e-5)",
        "body_index": "alcohol * residual_sugar", "bound_so2": "total_sulfur_dioxide - free_sulfur_dioxide"},
    "chemistry_shares": {
        "molecular_so2": "free_sulfur_dioxide / (1 + POW(10, ph - 1.81))", "bound_so2": "total_sulfur_dioxide - free_sulfur_dioxide",
        "total_acidity": "fixed_acidity + volatile_acidity",
        "volatile_ratio": "COALESCE(volatile_acidity / NULLIF(fixed_acidity + volatile_acidity, 0), 0)", "alcohol_density": "alcohol * density"},
}


def domain_table(spark, sf):
    return views.order_features(spark, sf).select("row_id", *[F.expr(e).alias(n) for n, e in DOMAIN.items()])


def _bundle_query(name):
    made = _DOMAIN_SQL[name]
    sql = _DOMAIN_CTE + "SELECT row_id, " + ", ".join(f"{r(e, 8)} AS {n}" for n, e in made.items()) + " FROM domain"

    @query(f"r08_bundle_{name}", with_views("order_features", sql))
    def run(spark, sf):
        out = derive.bundle(domain_table(spark, sf), name).select("row_id", *made)
        return rounded(out, list(made), 8)


for _name in _DOMAIN_SQL:
    _bundle_query(_name)


@query("r09_round_clip", with_views("order_features", f"SELECT row_id, CAST(LEAST(GREATEST(ROUND_EVEN(sum_qty / 10, 0), 1), 9) AS INT) AS class {_OF}"))
def r09(spark, sf):
    return views.order_features(spark, sf).select("row_id", derive.to_class(F.col("sum_qty") / 10, 1, 9).alias("class"))


@query("r10_label_encode", """WITH c AS (SELECT event_id, event_type, CAST(DENSE_RANK() OVER (ORDER BY event_type) - 1 AS INT) AS code FROM events)
SELECT event_id, code, event_type AS label FROM c""")
def r10(spark, sf):
    df = views.event_values(spark, sf)
    classes = derive.label_fit(df, "event_type")
    coded = derive.encode_label(df, "event_type", classes)
    return derive.decode_label(coded, "code", classes).select("event_id", "code", "label")


_CLASSES = list(range(1, 10))


@query("r11_class_probabilities", with_views("scored", "SELECT row_id, " + ", ".join(
    f"{r(f'EXP(-2 * POW(prediction - {c}, 2)) / total')} AS p_{c}" for c in _CLASSES)
    + " FROM (SELECT row_id, prediction, " + " + ".join(f"EXP(-2 * POW(prediction - {c}, 2))" for c in _CLASSES) + " AS total FROM scored)"))
def r11(spark, sf):
    out = derive.regression_to_proba(views.scored(spark, sf), "prediction", _CLASSES)
    names = [f"p_{c}" for c in _CLASSES]
    return rounded(out.select("row_id", *names), names)


@query("r12_numeric_columns", with_views("doc_features", "SELECT doc_id, n_chars, spaces FROM doc_features"))
def r12(spark, sf):
    df = views.doc_features(spark, sf)
    return df.select(*derive.feature_columns(df, "quality"))


@query("r13_infinite_to_null", with_views("order_features", f"SELECT row_id, sum_qty, {r('LN(NULLIF(avg_disc, 0))')} AS log_disc {_OF}"))
def r13(spark, sf):
    # The log of a zero discount goes to minus infinity.
    df = views.order_features(spark, sf).select(
        "row_id", "sum_qty", F.when(F.col("avg_disc") == 0, F.lit(float("-inf"))).otherwise(F.log("avg_disc")).alias("log_disc"))
    return rounded(derive.infinite_to_null(df), ["log_disc"])


# ---- outliers ------------------------------------------------------------


@query("o01_iqr_bounds", with_views("line_features", _union(
    f"SELECT '{c}' AS feature, {r(f'a - 1.5 * (b - a)', 4)} AS lower, {r(f'b + 1.5 * (b - a)', 4)} AS upper FROM "
    f"(SELECT QUANTILE_CONT({c}, 0.25) AS a, QUANTILE_CONT({c}, 0.75) AS b FROM line_features)" for c in LINE_COLS)))
def o01(spark, sf):
    df = views.line_features(spark, sf)
    return rounded(outliers.bounds_table(df, outliers.iqr_fit(df, LINE_COLS)), ["lower", "upper"], 4)


@query("o02_iqr_filter", with_views("order_features", iqr_ctes("order_features", ORDER_COLS) + " SELECT row_id, quality FROM kept"))
def o02(spark, sf):
    df = views.order_features(spark, sf)
    return outliers.iqr_filter(df, outliers.iqr_fit(df, ORDER_COLS)).select("row_id", "quality")


@query("o03_iqr_filter_with_target", with_views("order_features", iqr_ctes("order_features", ORDER_COLS + ["quality"]) + " SELECT row_id, quality FROM kept"))
def o03(spark, sf):
    df = views.order_features(spark, sf)
    return outliers.iqr_filter(df, outliers.iqr_fit(df, ORDER_COLS + ["quality"])).select("row_id", "quality")


def _sequential_sql(view: str, cols) -> str:
    parts, last = [], view
    for i, c in enumerate(cols):
        parts.append(f"s{i} AS (SELECT v.* FROM {last} v, (SELECT QUANTILE_CONT({c}, 0.25) AS a, QUANTILE_CONT({c}, 0.75) AS b FROM {last}) "
                     f"WHERE {c} >= a - 1.5 * (b - a) AND {c} <= b + 1.5 * (b - a))")
        last = f"s{i}"
    return "THEN " + ", ".join(parts) + f" SELECT * FROM {last}"


@query("o04_iqr_sequential", with_views("order_features", _sequential_sql("order_features", ["min_qty", "sum_price", "avg_disc"])))
def o04(spark, sf):
    return outliers.iqr_sequential(views.order_features(spark, sf), ["min_qty", "sum_price", "avg_disc"])


@query("o05_iqr_votes", with_views("order_features", iqr_ctes("order_features", ORDER_COLS, 0.5, 3) + " SELECT row_id FROM kept"))
def o05(spark, sf):
    df = views.order_features(spark, sf)
    return outliers.iqr_filter(df, outliers.iqr_fit(df, ORDER_COLS, 0.5), min_votes=3).select("row_id")


@query("o06_iqr_flagged", with_views("order_features", iqr_ctes("order_features", ORDER_COLS) + " SELECT row_id FROM flagged WHERE votes >= 1"))
def o06(spark, sf):
    df = views.order_features(spark, sf)
    return outliers.iqr_flagged(df, outliers.iqr_fit(df, ORDER_COLS)).select("row_id")


@query("o07_zscore_filter", with_views("order_features", "THEN s AS (SELECT " + ", ".join(
    f"AVG({c}) AS {c}_m, STDDEV_POP({c}) AS {c}_s" for c in ORDER_COLS) + f" {_OF}) SELECT row_id {_OF}, s WHERE "
    + " AND ".join(f"ABS(({c} - {c}_m) / {c}_s) < 3" for c in ORDER_COLS)))
def o07(spark, sf):
    return outliers.zscore_filter(views.order_features(spark, sf), ORDER_COLS).select("row_id")


@query("o11_removal_report", with_views("order_features", iqr_ctes("order_features", ORDER_COLS) + f"""
SELECT COUNT(*) AS n_before, COUNT(*) FILTER (votes = 0) AS n_after, COUNT(*) FILTER (votes > 0) AS n_removed,
  {r('100.0 * COUNT(*) FILTER (votes > 0) / COUNT(*)')} AS pct_removed FROM flagged"""))
def o11(spark, sf):
    df = views.order_features(spark, sf)
    keep = outliers.votes(outliers.iqr_fit(df, ORDER_COLS)) == 0
    return rounded(outliers.removal_report(df, keep), ["pct_removed"])


@query("o13_threshold_filter", with_views("order_features", f"SELECT label, n FROM (SELECT quality AS label, COUNT(*) AS n {_OF} GROUP BY 1) WHERE n < 1500"))
def o13(spark, sf):
    return profile.class_shares(views.order_features(spark, sf), "quality").filter("n < 1500").select("label", "n")


# ---- missing values ------------------------------------------------------


@query("m01_fill_mean", with_views("doc_features", f"SELECT doc_id, {r('COALESCE(quality, (SELECT AVG(quality) FROM doc_features))')} AS quality FROM doc_features"))
def m01(spark, sf):
    df = views.doc_features(spark, sf)
    return rounded(impute.impute_apply(df, impute.impute_fit(df, ["quality"])).select("doc_id", "quality"), ["quality"])


_SPLIT_CTE = """THEN parts AS (SELECT *, CASE WHEN ROW_NUMBER() OVER (ORDER BY md5(concat('42:', doc_id)), doc_id)
  <= CEIL(0.2 * (SELECT COUNT(*) FROM doc_features)) THEN 'test' ELSE 'train' END AS split FROM doc_features) """


@query("m02_fill_train_mean", with_views("doc_features", _SPLIT_CTE + f"""
SELECT doc_id, split, {r("COALESCE(quality, (SELECT AVG(quality) FROM parts WHERE split = 'train'))")} AS quality FROM parts"""))
def m02(spark, sf):
    parts = splits.split(views.doc_features(spark, sf), "doc_id", 0.2)
    fill = impute.impute_fit(parts.filter("split = 'train'"), ["quality"])
    return rounded(impute.impute_apply(parts, fill).select("doc_id", "split", "quality"), ["quality"])


@query("m03_fill_median", with_views("doc_features", f"SELECT doc_id, {r('COALESCE(quality, (SELECT QUANTILE_CONT(quality, 0.5) FROM doc_features))')} AS quality FROM doc_features"))
def m03(spark, sf):
    df = views.doc_features(spark, sf)
    return rounded(impute.impute_apply(df, impute.impute_fit(df, ["quality"], "median")).select("doc_id", "quality"), ["quality"])


# ---- scaling -------------------------------------------------------------

_SCALE_SQL = {
    "standard": "({c} - AVG({c}) OVER ()) / STDDEV_POP({c}) OVER ()",
    "minmax": "({c} - MIN({c}) OVER ()) / (MAX({c}) OVER () - MIN({c}) OVER ())",
    "robust": "({c} - QUANTILE_CONT({c}, 0.5) OVER ()) / (QUANTILE_CONT({c}, 0.75) OVER () - QUANTILE_CONT({c}, 0.25) OVER ())",
    "maxabs": "{c} / MAX(ABS({c})) OVER ()",
}


def _scale_query(name, how):
    sql = "SELECT row_id, " + ", ".join(f"{r(_SCALE_SQL[how].format(c=c), 5)} AS {c}" for c in ORDER_COLS) + f" {_OF}"

    @query(name, with_views("order_features", sql))
    def run(spark, sf):
        df = views.order_features(spark, sf)
        out = scale.scale_apply(df, scale.scale_fit(df, ORDER_COLS, how))
        return rounded(out.select("row_id", *ORDER_COLS), ORDER_COLS, 5)


_scale_query("f01_scale_standard", "standard")
_scale_query("f02_scale_minmax", "minmax")
_scale_query("f03_scale_robust", "robust")
_scale_query("f04_scale_maxabs", "maxabs")


@query("f05_quantile_normal")
def f05(spark, sf):
    df = views.event_values(spark, sf)
    out = scale.scale_apply(df, scale.scale_fit(df, ["value"], "quantile_normal"))
    return rounded(out.select("event_id", "value"), ["value"], 5)


@query("f05_quantile_uniform", f"""WITH marks AS (SELECT UNNEST(RANGE(1000)) AS i, UNNEST(QUANTILE_CONT(value, [{", ".join(repr(i / 999) for i in range(1000))}])) AS q FROM events),
up AS (SELECT event_id, value, MAX(i) AS i FROM events JOIN marks ON q <= value GROUP BY 1, 2),
down AS (SELECT event_id, MIN(i) AS j FROM events JOIN marks ON q >= value GROUP BY 1)
SELECT up.event_id, {r('''CASE WHEN down.j = 0 THEN 0.0 WHEN up.i = 999 THEN 1.0
  WHEN down.j <= up.i THEN (down.j + up.i) / 2.0 / 999
  ELSE (up.i + (value - a.q) / (b.q - a.q)) / 999 END''', 5)} AS value
FROM up JOIN down ON up.event_id = down.event_id JOIN marks a ON a.i = up.i JOIN marks b ON b.i = down.j""")
def f05_uniform(spark, sf):
    df = views.event_values(spark, sf)
    out = scale.scale_apply(df, scale.scale_fit(df, ["value"], "quantile_uniform"))
    return rounded(out.select("event_id", "value"), ["value"], 5)


def _yj(v: str, lam: str) -> str:
    return (f"CASE WHEN {v} >= 0 THEN CASE WHEN {lam} = 0 THEN LN(1 + {v}) ELSE (POW({v} + 1, {lam}) - 1) / {lam} END "
            f"ELSE CASE WHEN {lam} = 2 THEN -LN(1 - {v}) ELSE -(POW(1 - {v}, 2 - {lam}) - 1) / (2 - {lam}) END END")


def _yj_slope(name: str, lam: str) -> str:
    """``name``: an exponent and the slope of the likelihood there."""
    u, w = "LN(1 + ABS(value))", "CASE WHEN value >= 0 THEN lam ELSE 2 - lam END"
    turn = f"CASE WHEN {w} = 0 THEN {u} * {u} / 2 ELSE ({u} * EXP({w} * {u}) * {w} - (EXP({w} * {u}) - 1)) / (({w}) * ({w})) END"
    return f"""{name} AS MATERIALIZED (SELECT lam, SUM(SIGN(value) * {u}) / COUNT(*) - COVAR_POP({_yj('value', 'lam')}, {turn}) / VAR_POP({_yj('value', 'lam')}) AS s
      FROM events, (SELECT {lam} AS lam) GROUP BY lam)"""


def _yj_secant(steps: int = 12) -> str:
    """The root of the slope by the secant rule from -0.5 and 0.5."""
    parts = [_yj_slope("p0", "-0.5::DOUBLE"), _yj_slope("p1", "0.5::DOUBLE")]
    for k in range(2, steps):
        parts.append(_yj_slope(f"p{k}", f"(SELECT COALESCE(b.lam - b.s * (b.lam - a.lam) / NULLIF(b.s - a.s, 0), b.lam) FROM p{k - 2} a, p{k - 1} b)"))
    return ", ".join(parts) + f", l3 AS (SELECT lam FROM p{steps - 1})"


@query("f06_yeo_johnson", f"WITH {_yj_secant()}"
       + f", y AS (SELECT event_id, {_yj('value', 'lam')} AS y FROM events, l3) SELECT event_id, {r('(y - AVG(y) OVER ()) / STDDEV_POP(y) OVER ()', 5)} AS value FROM y")
def f06(spark, sf):
    df = views.event_values(spark, sf)
    out = scale.scale_apply(df, scale.scale_fit(df, ["value"], "yeo_johnson"))
    return rounded(out.select("event_id", "value"), ["value"], 5)


@query("f07_scale_subset", with_views("order_features", "SELECT row_id, quality, sum_qty, sum_price, "
       + ", ".join(f"{r(_SCALE_SQL['standard'].format(c=c), 5)} AS {c}_scaled" for c in ("sum_qty", "sum_price")) + f" {_OF}"))
def f07(spark, sf):
    df = views.order_features(spark, sf)
    out = scale.scale_apply(df, scale.scale_fit(df, ["sum_qty", "sum_price"]), "_scaled")
    return rounded(out.select("row_id", "quality", "sum_qty", "sum_price", "sum_qty_scaled", "sum_price_scaled"), ["sum_qty_scaled", "sum_price_scaled"], 5)


def _describe_scaled(how: str) -> str:
    return (f"SELECT '{how}' AS method, 'sum_qty' AS feature, COUNT(x) AS n, {r('AVG(x)', 4)} AS mean, {r('STDDEV_SAMP(x)', 4)} AS std, {r('MIN(x)', 4)} AS min, "
            f"{r('QUANTILE_CONT(x, 0.25)', 4)} AS q25, {r('QUANTILE_CONT(x, 0.5)', 4)} AS q50, {r('QUANTILE_CONT(x, 0.75)', 4)} AS q75, {r('MAX(x)', 4)} AS max "
            f"FROM (SELECT {_SCALE_SQL[how].format(c='sum_qty')} AS x {_OF})")


@query("p12_compare_scalers", with_views("order_features", _union(_describe_scaled(h) for h in scale.LINEAR)))
def p12(spark, sf):
    df = cut_lineage(views.order_features(spark, sf).select("sum_qty"))  # every scaler and summary reads it several times
    parts = []
    for how in scale.LINEAR:
        scaled = scale.scale_apply(df, scale.scale_fit(df, ["sum_qty"], how))
        parts.append(profile.describe(scaled, ["sum_qty"]).withColumn("method", F.lit(how)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return rounded(out, ["mean", "std", "min", "q25", "q50", "q75", "max"], 4)


# ---- sources -------------------------------------------------------------


@query("s03_drop_index", "SELECT o_custkey, o_orderstatus, o_totalprice FROM orders")
def s03(spark, sf):
    df = views.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return tables.drop_index(df, "o_orderkey")


@query("s04_holdout_slice", "SELECT event_id, user_id, value FROM events WHERE event_id BETWEEN 4001 AND 4897")
def s04(spark, sf):
    return tables.holdout(views.table(spark, sf, "events"), "event_id", 4001, 4897).select("event_id", "user_id", "value")


@query("s05_normalise_names", 'SELECT l_orderkey AS "order_key", l_quantity AS "total_quantity" FROM lineitem')
def s05(spark, sf):
    df = views.table(spark, sf, "lineitem").select(F.col("l_orderkey").alias(" Order Key"), F.col("l_quantity").alias("Total Quantity "))
    return tables.normalise_names(df)
