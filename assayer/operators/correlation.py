"""Correlation, collinearity and the search for derived features."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.stats import all_pairs, collect_aggs, corr_pairs, gram, moments, q
from .derive import ratio_or_null

CATALOGUE = "f1 string, f2 string, operation string, new_feature_name string, corr_abs double, corr_raw double"
OPERATIONS = ["plus", "minus", "multiply", "divide"]


def corr_long(df: DataFrame, cols: list[str]) -> DataFrame:
    """``f1, f2, corr`` for every ordered pair, the diagonal included."""
    half = corr_pairs(df, all_pairs(cols))
    both = half.select(F.explode(F.array(
        F.struct(F.col("f1").alias("f1"), F.col("f2").alias("f2"), "corr"),
        F.struct(F.col("f2").alias("f1"), F.col("f1").alias("f2"), "corr"),
    )).alias("s")).select("s.*")
    diagonal = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "f1 string, f2 string, corr double")
    return both.unionByName(diagonal)


def high_pairs(df: DataFrame, cols: list[str], threshold: float = 0.85) -> DataFrame:
    return corr_pairs(df, all_pairs(cols)).filter(F.abs("corr") > threshold)


def collinear_drops(df: DataFrame, cols: list[str], threshold: float = 0.85) -> list[str]:
    """The later member of every highly correlated pair, in column order."""
    late = {r["f2"] for r in high_pairs(df, cols, threshold).select("f2").distinct().collect()}
    return [c for c in cols if c in late]


def drop_collinear(df: DataFrame, cols: list[str], threshold: float = 0.85) -> DataFrame:
    return df.drop(*collinear_drops(df, cols, threshold))


def target_corr(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """``feature, corr, corr_abs`` of every column with the target; one pass."""
    return corr_pairs(df, [(c, label) for c in cols]).select(
        F.col("f1").alias("feature"), "corr", F.abs("corr").alias("corr_abs")
    )


def corr_tiers(scores: DataFrame, high: float = 0.2, medium: float = 0.1) -> DataFrame:
    a = F.col("corr_abs")
    return scores.withColumn("tier", F.when(a > high, "high").when(a > medium, "medium").when(a.isNotNull(), "low"))


def tier_selection(scores: DataFrame, high: float = 0.2, medium: float = 0.1) -> DataFrame:
    """The high and medium features with their absolute correlation."""
    return corr_tiers(scores, high, medium).filter(F.col("tier").isin("high", "medium")).select("feature", "corr_abs")


def corr_signs(scores: DataFrame, low: float = 0.1) -> DataFrame:
    return scores.withColumns({
        "sign": F.when(F.col("corr") > 0, "positive").when(F.col("corr") < 0, "negative"),
        "is_low": F.col("corr_abs") < low,
    })


# ---- variance inflation --------------------------------------------------


def vif_from_gram(g: np.ndarray) -> list[float]:
    """Inflation of each column regressed on the others without an intercept."""
    p = len(g)
    if p == 1:
        return [1.0]
    size = np.sqrt(np.diag(g))
    size[size == 0] = 1.0
    r = g / np.outer(size, size)
    out = []
    for i in range(p):
        rest = [j for j in range(p) if j != i]
        left = r[i, i] - r[i, rest] @ np.linalg.pinv(r[np.ix_(rest, rest)], hermitian=True) @ r[rest, i]
        out.append(float(r[i, i] / left) if left > 1e-12 else float("inf"))
    return out


def _gram_for(df: DataFrame, cols: list[str], standardise: bool) -> np.ndarray:
    if not standardise:
        return gram(df, cols)
    stats = moments(df, cols)
    return gram(df, cols, {c: stats[c]["mean"] for c in cols}, {c: stats[c]["std_pop"] or 1.0 for c in cols})


def vif(df: DataFrame, cols: list[str], standardise: bool = False) -> DataFrame:
    """``feature, vif``. On raw columns the value depends on their offset."""
    values = vif_from_gram(_gram_for(df, cols, standardise)) if cols else []
    return df.sparkSession.createDataFrame(list(zip(cols, values)), "feature string, vif double")


def vif_split(table: DataFrame, threshold: float = 10.0) -> DataFrame:
    return table.withColumn("selected", F.col("vif") < threshold)


def vif_prune(df: DataFrame, cols: list[str], label: str | None = None, threshold: float = 10.0, cap: int | None = None, standardise: bool = False) -> DataFrame:
    """``feature, vif, step``: drop the most inflated column until all are at most ``threshold``.

    The cross products are computed once; every round only removes a row and a
    column from the small matrix. ``step`` numbers the dropped columns and is
    null for those kept. No column is cut beforehand unless ``cap`` is given: then
    only the ``cap`` with the largest absolute correlation to ``label`` take part.
    """
    work = list(cols)
    if label is not None and cap is not None and len(work) > cap:
        top = target_corr(df, work, label).orderBy(F.desc("corr_abs"), "feature").limit(cap).collect()
        chosen = {r["feature"] for r in top}
        work = [c for c in work if c in chosen]
    g = _gram_for(df, work, standardise)
    keep, rows, step = list(range(len(work))), [], 0
    while keep:
        values = vif_from_gram(g[np.ix_(keep, keep)])
        worst = max(range(len(keep)), key=lambda i: (values[i], -i))
        if values[worst] <= threshold:
            rows += [(work[k], v, None) for k, v in zip(keep, values)]
            break
        step += 1
        rows.append((work[keep[worst]], values[worst], step))
        del keep[worst]
    return df.sparkSession.createDataFrame(rows, "feature string, vif double, step int")


# ---- pair interactions ---------------------------------------------------


def pair_search(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """Correlation with the target of ``a + b``, ``a - b``, ``a * b`` and ``a / b`` for all pairs.

    Every sum a correlation needs is an entry of a product of two n x p
    matrices, so each Arrow batch contributes a few p x p matrices and the
    whole search is one scan and one small aggregation, whatever the number of
    pairs. Columns and reciprocals are taken less their means, and a product less
    the product of the means, which leaves correlations as they are and keeps the
    digits of columns that lie far from zero. A zero divisor is missing, as is a
    pair without variance.
    """
    p = len(cols)
    numeric = df.select(*[F.nanvl(q(c).cast("double"), F.lit(None)).alias(f"x{i}") for i, c in enumerate(cols)], q(label).cast("double").alias("y"))
    means = collect_aggs(numeric, {"y": F.avg(F.nanvl("y", F.lit(None).cast("double"))), **{f"x{i}": F.avg(f"x{i}") for i in range(p)}, **{
        f"z{i}": F.avg(F.when(F.col(f"x{i}") != 0, 1 / F.col(f"x{i}"))) for i in range(p)}})
    mean = {k: v if v is not None and np.isfinite(v) else 0.0 for k, v in means.items()}
    of_y, of_x, of_z = mean["y"], np.array([mean[f"x{i}"] for i in range(p)]), np.array([mean[f"z{i}"] for i in range(p)])

    def product(a, ma, mean_a, b, mb, mean_b, y):
        """Sums over (mean_a + a) * (mean_b + b) - mean_a * mean_b for all pairs; ``a`` and ``b`` are 0 where missing."""
        u, w, a2, b2 = mean_a[:, None], mean_b[None, :], a * a, b * b
        cross, left, right = a.T @ b, a.T @ mb, ma.T @ b
        parts = u * u * (ma.T @ b2) + w * w * (a2.T @ mb) + a2.T @ b2
        squares = parts + 2 * (u * w * cross + u * (a.T @ b2) + w * (a2.T @ b))
        with_y = u * ((ma * y).T @ b) + w * ((a * y).T @ mb) + (a * y).T @ b
        return np.stack([ma.T @ mb, u * right + w * left + cross, squares, with_y, (ma * y).T @ mb, (ma * y * y).T @ mb, parts])

    def partial(batches):
        total = np.zeros((4, 7, p, p))
        for pdf in batches:
            data = pdf.to_numpy(dtype=float)
            data = data[~np.isnan(data[:, p])]
            raw, y = data[:, :p], (data[:, p] - of_y)[:, None]
            m = (~np.isnan(raw)).astype(float)
            x = np.where(m > 0, raw - of_x, 0.0)
            mz = m * (np.where(m > 0, raw, 0.0) != 0)
            z = np.where(mz > 0, np.divide(1.0, raw, out=np.zeros_like(raw), where=mz > 0) - of_z, 0.0)
            x2, xy = x * x, x * y
            seen = np.stack([m.T @ m, (m * y).T @ m, (m * y * y).T @ m])
            left, right, cross = x.T @ m, m.T @ x, x.T @ x
            squares = x2.T @ m + m.T @ x2
            left_y, right_y = xy.T @ m, (m * y).T @ x
            total[0] += np.stack([seen[0], left + right, squares + 2 * cross, left_y + right_y, seen[1], seen[2], squares])
            total[1] += np.stack([seen[0], left - right, squares - 2 * cross, left_y - right_y, seen[1], seen[2], squares])
            total[2] += product(x, m, of_x, x, m, of_x, y)
            total[3] += product(x, m, of_x, z, mz, of_z, y)
        i, j = np.triu_indices(p, 1)
        for o in range(4):
            yield pd.DataFrame({"o": o, "i": i, "j": j, **{f"s{k}": total[o, k][i, j] for k in range(7)}})

    ddl = "o int, i int, j int, " + ", ".join(f"s{k} double" for k in range(7))
    s = numeric.mapInPandas(partial, ddl).groupBy("o", "i", "j").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(7)])
    n, sd, sdd, sdy, sy, syy, parts = (F.col(f"s{k}") for k in range(7))
    var_d, var_y = n * sdd - sd * sd, n * syy - sy * sy
    # Below this share of the squares of its parts the variance is rounding noise.
    real = (var_d > F.lit(1e-13) * n * parts) & (var_y > 0)
    corr = F.when(real, (n * sdy - sd * sy) / F.sqrt(var_d) / F.sqrt(var_y))
    names, kinds = F.array(*[F.lit(c) for c in cols]), F.array(*[F.lit(o) for o in OPERATIONS])
    return (
        s.select(F.element_at(names, F.col("i") + 1).alias("f1"), F.element_at(names, F.col("j") + 1).alias("f2"),
                 F.element_at(kinds, F.col("o") + 1).alias("operation"), corr.alias("corr_raw"))
        .filter("corr_raw is not null")
        .select("f1", "f2", "operation", F.concat_ws("_", "f1", "operation", "f2").alias("new_feature_name"),
                F.abs("corr_raw").alias("corr_abs"), "corr_raw")
    )


def best_operations(catalogue: DataFrame, min_corr: float | None = None) -> DataFrame:
    """The strongest operation of each pair (a catalogue has at most 4 rows per pair)."""
    order = Window.partitionBy("f1", "f2").orderBy(F.desc("corr_abs"), "operation")
    best = catalogue.withColumn("__rn", F.row_number().over(order)).filter("__rn = 1").drop("__rn")
    return best.filter(F.col("corr_abs") >= min_corr) if min_corr is not None else best


def _expression(f1: str, f2: str, operation: str) -> Column:
    made = {
        "plus": lambda: q(f1) + q(f2),
        "minus": lambda: q(f1) - q(f2),
        "multiply": lambda: q(f1) * q(f2),
        "divide": lambda: ratio_or_null(f1, f2, 0.0),
    }
    if operation not in made:
        raise ValueError(f"unknown operation {operation!r}")
    return made[operation]()


def catalogue_rows(catalogue: DataFrame | Iterable) -> list:
    """The catalogue as driver rows; its size is set by the number of features, not of rows."""
    return catalogue.collect() if isinstance(catalogue, DataFrame) else list(catalogue)


def apply_catalogue(df: DataFrame, catalogue: DataFrame | Iterable) -> DataFrame:
    """Add every derived column whose inputs exist."""
    return df.withColumns({
        r["new_feature_name"]: _expression(r["f1"], r["f2"], r["operation"])
        for r in catalogue_rows(catalogue) if r["f1"] in df.columns and r["f2"] in df.columns
    })


def serve_features(df: DataFrame, catalogue: DataFrame | Iterable, selected: list[str], on_missing: str = "error", keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the ``selected`` columns, in order, raw or derived by the catalogue.

    ``on_missing='skip'`` leaves out what cannot be built; ``'error'`` raises.
    """
    trimmed = df.toDF(*[c.strip() for c in df.columns])
    rules = {}
    for r in catalogue_rows(catalogue):
        rules.setdefault(r["new_feature_name"], r)
    made = []
    for name in selected:
        rule = rules.get(name)
        if name in trimmed.columns:
            made.append(q(name))
        elif rule is not None and rule["f1"] in trimmed.columns and rule["f2"] in trimmed.columns:
            made.append(_expression(rule["f1"], rule["f2"], rule["operation"]).alias(name))
        elif on_missing == "error":
            raise ValueError(f"{name!r} is neither a column nor derivable from the columns at hand")
    return trimmed.select(*keep, *made)


def disjoint_pick(catalogue: DataFrame | Iterable, base_scores: dict[str, float]) -> list[tuple[str, float]]:
    """Best-first choice of features that share no input column."""
    offers = [(r["new_feature_name"], r["corr_abs"], {r["f1"], r["f2"]}) for r in catalogue_rows(catalogue) if r["f1"] != r["f2"]]
    offers += [(name, score, {name}) for name, score in base_scores.items()]
    taken, used = [], set()
    for name, score, parts in sorted(offers, key=lambda o: (-o[1], o[0])):
        if used.isdisjoint(parts):
            taken.append((name, score))
            used |= parts
    return taken


def pareto(df: DataFrame, cols: list[str], label: str, n: int = 20) -> DataFrame:
    """Relevance against redundancy: ``score = R / (1 + D)``, the best ``n``."""
    both = corr_pairs(df, all_pairs(cols) + [(c, label) for c in cols])
    ends = both.select("f1", "f2", F.abs("corr").alias("a"))
    relevance = ends.filter(F.col("f2") == label).select(F.col("f1").alias("feature"), F.col("a").alias("relevance"))
    spread = ends.filter(F.col("f2") != label).select(F.explode(F.array("f1", "f2")).alias("feature"), "a")
    redundancy = spread.groupBy("feature").agg((F.sum("a") / F.lit(float(len(cols) - 1))).alias("redundancy"))
    scored = relevance.join(redundancy, "feature", "left").withColumn("redundancy", F.coalesce("redundancy", F.lit(0.0)))
    return scored.withColumn("score", F.col("relevance") / (1 + F.col("redundancy"))).orderBy(F.desc("score"), "feature").limit(n)
