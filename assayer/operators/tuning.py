"""Leak-free fitting, cross-validation and search.

A recipe says how a model is made; fitting it learns every number (fill values,
scaler, resampled rows, model) from the training rows alone.
"""

from __future__ import annotations

import random
from dataclasses import dataclass, field, replace
from itertools import product
from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import FractionalType

from ..functions.stats import collect_aggs, q
from ..session import cached
from . import impute, linear, models, neighbors, resample, scale, splits
from .derive import encode_label, label_fit, poly2, to_class

CELL_LIMIT = 1_000_000  # (label, predicted class) cells that may come to the driver


@dataclass(frozen=True)
class Recipe:
    """How to get from columns to a prediction."""

    model: str
    cols: tuple[str, ...]
    params: dict = field(default_factory=dict)
    scaler: str | None = None
    fill: str | None = None
    interactions: bool = False
    resampling: str | None = None     # None, "smote", "smote_tomek" or "weights"
    neighbors: int = 5
    seed: int = 42

    @property
    def regression(self) -> bool:
        return self.model == "knn" or models.is_regressor(self.model)


@dataclass
class Fitted:
    recipe: Recipe
    fill: dict | None
    scaler: dict | None
    cols: list[str]
    classes: list | None
    model: object

    def prepare(self, df: DataFrame) -> DataFrame:
        cols = list(self.recipe.cols)
        df = df.withColumns({c: q(c).cast("double") for c in cols})
        if self.fill is not None:
            df = impute.impute_apply(df, self.fill)
        if self.scaler is not None:
            df = scale.scale_apply(df, self.scaler)
        return poly2(df, cols, interaction_only=True) if self.recipe.interactions else df

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``prediction``: a number, or the class for a classifier."""
        ready = self.prepare(df)
        if self.recipe.model == "knn":
            train, label, row_id = self.model
            return neighbors.knn_regress(train, ready, self.cols, label, self.recipe.params.get("n_neighbors", 5), row_id)
        vector = self._vector(ready)
        out = self.model.transform(vector)
        if self.classes is not None:
            codes = F.array(*[F.lit(float(c)) for c in self.classes])
            out = out.withColumn("prediction", F.element_at(codes, F.col("prediction").cast("int") + 1))
        return out

    def _vector(self, df: DataFrame) -> DataFrame:
        if self.recipe.model in ("rbf_svc", "svr"):
            return models.fourier_features(df, self.cols, self.recipe.params.get("gamma"), self.recipe.params.get("n_components", 100), self.recipe.seed)
        return models.assembled(df, self.cols)


def fit(train: DataFrame, recipe: Recipe, label: str, row_id: str = "row_id", learned: tuple[dict | None, dict | None] | None = None) -> Fitted:
    """Learn the recipe from ``train``; ``learned`` may hold the fill values and the scaler, if these rows gave them before."""
    cols = list(recipe.cols)
    base = train.select(row_id, *[q(c).cast("double").alias(c) for c in cols], label)
    if learned is None:
        fill = impute.impute_fit(base, cols, recipe.fill) if recipe.fill else None
        filled = impute.impute_apply(base, fill) if fill else base
        learned = fill, scale.scale_fit(filled, cols, recipe.scaler) if recipe.scaler else None
    fill, scaler = learned
    fitted = Fitted(recipe, fill, scaler, cols, None, None)
    ready = fitted.prepare(base)
    if recipe.interactions:
        fitted.cols = [c for c in ready.columns if c not in (row_id, label)]
    if recipe.resampling in ("smote", "smote_tomek"):
        grow = resample.smote_tomek if recipe.resampling == "smote_tomek" else resample.smote
        if recipe.resampling == "smote_tomek" or resample.can_interpolate(ready, label):
            ready = grow(ready, row_id, fitted.cols, label, recipe.neighbors, recipe.seed)
    weight = None
    if recipe.resampling == "weights":
        ready, weight = resample.with_class_weights(ready, label, "weight"), "weight"
    if recipe.model == "knn":
        fitted.model = (ready, label, row_id)
        return fitted
    if not recipe.regression:
        fitted.classes = label_fit(ready, label)
        ready = encode_label(ready, label, fitted.classes, "label").withColumn("label", F.col("label").cast("double"))
    else:
        ready = ready.withColumn("label", F.col(label).cast("double"))
    if recipe.model in ("rbf_svc", "svr") and "gamma" not in recipe.params:
        spread = np.mean([(s["std_pop"] or 0.0) ** 2 for s in models.moments(ready, fitted.cols).values()])
        gamma = float(1.0 / (len(fitted.cols) * spread)) if spread > 0 else 1.0
        fitted.recipe = replace(recipe, params={**recipe.params, "gamma": gamma})
    vector = fitted._vector(ready).select("features", "label", *([weight] if weight else []))
    with cached(vector) as rows:
        size = rows.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop("label").alias("std")).first()
        stage = models.estimator(recipe.model, fitted.recipe.params, size["n"], "label", recipe.seed, weight, size["std"])
        fitted.model = stage.fit(rows)
    return fitted


# ---- metrics -------------------------------------------------------------


def score(predicted: DataFrame, label: str, prediction: str = "prediction", limits: tuple[int, int] | None = None) -> dict[str, float]:
    """All regression and class metrics from one grouped pass; class metrics are left out if a label is no whole number."""
    return next(iter(scores(predicted, [], label, prediction, limits).values()))


def scores(predicted: DataFrame, by: list[str], label: str, prediction: str = "prediction", limits: tuple[int, int] | None = None) -> dict[tuple, dict[str, float]]:
    """The metrics of every group of ``by``.

    The rows are merged per (label, rounded and clipped prediction), or into one cell where the label is no whole number; everything
    else is arithmetic on that small table.
    """
    y, error = F.col(label).cast("double"), F.col(label) - F.col(prediction)
    rounded = F.rint(prediction) if limits is None else to_class(prediction, *limits)
    whole = y == F.rint(y)
    cells = predicted.groupBy(*by, F.when(whole, y).alias("__y"), F.when(whole, rounded.cast("double")).alias("__c")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(error * error).alias("se"), F.sum(F.abs(error)).alias("ae"),
        F.avg(y).alias("mean"), F.var_pop(y).alias("var"), F.first(whole).alias("whole"))
    rows = cells.limit(CELL_LIMIT + 1).collect()
    if len(rows) > CELL_LIMIT:
        raise ValueError(f"{label} has too many classes; use evaluate.regression_metrics")
    groups: dict[tuple, list] = {} if by else {(): []}
    for r in rows:
        groups.setdefault(tuple(r[c] for c in by), []).append(r)
    return {key: _metrics(found, limits) for key, found in groups.items()}


def _metrics(rows: list, limits: tuple[int, int] | None) -> dict[str, float]:
    n, se, ae, mean, var = (np.array([r[k] if r[k] is not None else np.nan for r in rows], dtype=float) for k in ("n", "se", "ae", "mean", "var"))
    total = n.sum()
    centre = np.nansum(n * mean) / total if total else 0.0
    spread = np.nansum(n * (var + (mean - centre) ** 2)) / total if total else 0.0
    mse = np.nansum(se) / total if total else 0.0
    out = {"n": float(total), "mse": mse, "rmse": mse ** 0.5, "mae": np.nansum(ae) / total if total else 0.0, "r2": 1 - mse / spread if spread else 0.0}
    if not all(r["whole"] for r in rows):
        return out
    y, c = (np.array([r[k] for r in rows], dtype=float) for k in ("__y", "__c"))
    if limits is None and len(y):
        c = np.clip(c, y.min(), y.max())
    classes = np.unique(np.concatenate([y, c]))
    i, j = np.searchsorted(classes, y), np.searchsorted(classes, c)
    count = lambda at, weight: np.bincount(at, weight, len(classes)).astype(float)
    hit, truth, guess = count(i[i == j], n[i == j]), count(i, n), count(j, n)
    f1 = np.divide(2 * hit, truth + guess, out=np.zeros_like(hit), where=truth + guess > 0)
    # The expected disagreement of independent margins needs their first two moments only.
    place = np.arange(len(classes), dtype=float)
    expected = (truth + guess) @ place**2 - 2 * (truth @ place) * (guess @ place) / total if total else 0.0
    return out | {
        "accuracy": hit.sum() / total if total else 0.0, "f1_macro": float(f1.mean()) if len(f1) else 0.0,
        "f1_weighted": float((f1 * truth).sum() / total) if total else 0.0,
        "qwk": float(1 - (n * (i - j) ** 2).sum() / expected) if expected else 0.0,
    }


LOWER_IS_BETTER = ("mse", "rmse", "mae")


def better(metric: str, a: float, b: float) -> bool:
    return a < b if metric in LOWER_IS_BETTER else a > b


def in_parallel(tasks, parallelism: int = 4) -> list:
    """Run independent Spark jobs from a few driver threads, as CrossValidator does."""
    pool = ThreadPool(max(1, parallelism))
    run = inheritable_thread_target(SparkSession.getActiveSession() or SparkSession.builder.getOrCreate())(lambda task: task())
    try:
        return pool.map(run, list(tasks))
    finally:
        pool.close()


# ---- cross-validation ----------------------------------------------------


def with_folds(df: DataFrame, row_id: str, label: str | None, k: int, seed=42) -> DataFrame:
    """Folds that share out every class; a fractional label (by its type) gets plain ones."""
    if label is not None and isinstance(df.schema[label].dataType, FractionalType):
        label = None
    return df if "fold" in df.columns else splits.folds(df, row_id, k, seed, label)


def cross_validate(
    df: DataFrame, recipe: Recipe, label: str, row_id: str = "row_id", k: int = 3, seed=42, parallelism: int = 4, learned: dict | None = None,
) -> list[dict]:
    """The metrics of each fold; ``df`` may already carry its ``fold`` column (and should be kept then). ``learned``: see ``fold_steps``."""
    if "fold" not in df.columns:
        with cached(with_folds(df.select(row_id, *recipe.cols, label), row_id, label, k, seed)) as folded:
            return cross_validate(folded, recipe, label, row_id, k, seed, parallelism, learned)
    if linear.fits(recipe):
        return linear_runs(df, {"": recipe}, label, k)[""]

    def one(i):
        def run():
            model = fit(df.filter(F.col("fold") != i), recipe, label, row_id, learned and learned[(*_steps(recipe), i)])
            return {"fold": i, **score(model.transform(df.filter(F.col("fold") == i)), label)}
        return run

    return in_parallel([one(i) for i in range(k)], parallelism)


def fold_fills(folded: DataFrame, recipes: list[Recipe], k: int, parallelism: int = 4) -> dict[str, list[dict]]:
    """Per way of filling, the fill values of every fold's training rows, once for all recipes.

    A column without a missing value in the whole table needs none, in training and held-out rows alike.
    """
    ways: dict[str, dict] = {}
    for r in recipes:
        if r.fill:
            ways.setdefault(r.fill, {}).update(dict.fromkeys(r.cols))
    if not ways:
        return {}
    names = list(dict.fromkeys(c for cols in ways.values() for c in cols))
    missing = collect_aggs(folded, {c: F.count_if(q(c).cast("double").isNull()) for c in names})
    gaps = {how: [c for c in cols if missing[c]] for how, cols in ways.items()}

    def one(how, i):
        train = folded.filter(F.col("fold") != i).select(*[q(c).cast("double").alias(c) for c in gaps[how]])
        return impute.impute_fit(train, gaps[how], how)

    found = iter(in_parallel([lambda how=how, i=i: one(how, i) for how in ways for i in range(k)], parallelism))
    return {how: [next(found) for _ in range(k)] for how in ways}


def _steps(recipe: Recipe) -> tuple:
    """What the fill values and the scaler depend on, besides the rows."""
    return recipe.fill, recipe.scaler, tuple(recipe.cols)


def fold_steps(folded: DataFrame, recipes: list[Recipe], k: int, parallelism: int = 4) -> dict[tuple, tuple[dict | None, dict | None]]:
    """Fill values and scaler of every fold's training rows, learned once for all recipes that share them."""
    fills = fold_fills(folded, recipes, k, parallelism)

    def one(how, scaler, cols, i):
        fill = {c: v for c, v in fills[how][i].items() if c in cols} if how else None
        if not scaler:
            return fill, None
        train = folded.filter(F.col("fold") != i).select(*[q(c).cast("double").alias(c) for c in cols])
        return fill, scale.scale_fit(impute.impute_apply(train, fill) if fill else train, list(cols), scaler)

    keys = [(*steps, i) for steps in dict.fromkeys(map(_steps, recipes)) for i in range(k)]
    return dict(zip(keys, in_parallel([lambda key=key: one(*key) for key in keys], parallelism), strict=True))


def linear_runs(folded: DataFrame, recipes: dict[str, Recipe], label: str, k: int) -> dict[str, list[dict]]:
    """``cross_validate`` of many linear recipes: a scan for the cross products of all folds, and one for all predictions."""
    found = scores(linear.fold_predictions(folded, recipes, label, k), ["run", "fold"], "label")
    return {n: [{"fold": f, **found[n, f]} for f in range(k) if (n, f) in found] for n in recipes}


def summarise(runs: list[dict]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation of every metric over the folds."""
    names = [m for m in runs[0] if m not in ("fold", "n")]
    return {m: (float(np.mean([r[m] for r in runs])), float(np.std([r[m] for r in runs]))) for m in names}


def compare(df: DataFrame, recipes: dict[str, Recipe], label: str, row_id: str = "row_id", k: int = 3, seed=42, parallelism: int = 4) -> dict[str, dict]:
    """Cross-validated summary of several recipes on the same folds; equal recipes, which draws may give, are fitted once."""
    alike = {n: next(m for m in recipes if recipes[m] == r) for n, r in recipes.items()}
    needed = list(dict.fromkeys(c for r in recipes.values() for c in r.cols))
    keep = [row_id, *needed, label] + (["fold"] if "fold" in df.columns else [])
    with cached(with_folds(df.select(*keep), row_id, label, k, seed)) as folded:
        n = folded.count()
        plain = {n: r for n, r in recipes.items() if linear.fits(r) and alike[n] == n}
        found = linear_runs(folded, plain, label, k) if plain else {}
        rest = [n for n in recipes if n not in plain and alike[n] == n]
        learned = fold_steps(folded, [recipes[n] for n in rest], k, parallelism)
        columns = lambda r: len(r.cols) * (len(r.cols) + 1) // 2 if r.interactions else len(r.cols)
        widest = max((models.kept_bytes(r.model, r.params, columns(r)) for r in recipes.values()), default=0)
        fits = models.at_once(n, widest, parallelism * k)  # fits side by side each keep their rows
        runs = in_parallel([lambda n=n: cross_validate(folded, recipes[n], label, row_id, k, seed, min(k, fits), learned) for n in rest], max(1, min(parallelism, fits // k)))
    found.update(zip(rest, runs))
    return {n: summarise(found[alike[n]]) for n in recipes}


def summary_table(df: DataFrame, summaries: dict[str, dict], name: str = "run_name") -> DataFrame:
    """Long table ``<name>, metric, mean, std``."""
    rows = [(n, m, mean, std) for n, s in summaries.items() for m, (mean, std) in s.items()]
    return df.sparkSession.createDataFrame(rows, f"{name} string, metric string, mean double, std double")


def best(summaries: dict[str, dict], metric: str) -> str:
    sign = 1.0 if metric in LOWER_IS_BETTER else -1.0
    return min(summaries, key=lambda n: (sign * summaries[n][metric][0], n))


# ---- search --------------------------------------------------------------


def grid(space: dict[str, list]) -> list[dict]:
    names = list(space)
    return [dict(zip(names, values)) for values in product(*space.values())]


def draw(space: dict, n: int, seed: int = 42) -> list[dict]:
    """Seeded draws from lists, ``("int", lo, hi)``, ``("float", lo, hi)`` and ``("log", lo, hi)``."""
    rng = random.Random(seed)

    def value(spec):
        if isinstance(spec, list):
            return rng.choice(spec)
        kind, lo, hi = spec
        if kind == "int":
            return rng.randint(lo, hi)
        if kind == "float":
            return rng.uniform(lo, hi)
        return float(np.exp(rng.uniform(np.log(lo), np.log(hi))))

    return [{name: value(spec) for name, spec in space.items()} for _ in range(n)]


# The search spaces a user of the workflow expects.
SPACES = {
    "forest_classifier": {"scaler": ["minmax", "standard", "robust"], "n_estimators": ("int", 100, 500), "max_depth": ("int", 5, 30)},
    "boost_regressor": {"scaler": ["minmax", "standard", "robust"], "n_estimators": ("int", 100, 500), "learning_rate": ("float", 0.01, 0.3),
                        "max_depth": ("int", 3, 10), "subsample": ("float", 0.6, 1.0)},
    "boost_classifier": {"scaler": ["minmax", "standard", "robust"], "n_estimators": ("int", 100, 500), "learning_rate": ("float", 0.01, 0.3),
                         "max_depth": ("int", 3, 10)},
    "linear_svc": {"scaler": ["minmax", "standard", "robust"], "C": ("log", 0.1, 100.0)},
    "rbf_svc": {"scaler": ["minmax", "standard", "robust"], "C": ("log", 0.1, 100.0)},
    "logistic": {"scaler": ["minmax", "standard", "robust"], "C": ("log", 0.1, 100.0)},
    "elastic_net": {"scaler": ["minmax", "standard", "robust"], "alpha": ("log", 0.01, 10.0), "l1_ratio": ("float", 0.0, 1.0)},
}


def with_params(recipe: Recipe, params: dict) -> Recipe:
    """A recipe with drawn parameters; ``scaler`` is a recipe field, the rest go to the model."""
    rest = {k: v for k, v in params.items() if k != "scaler"}
    return replace(recipe, scaler=params.get("scaler", recipe.scaler), params={**recipe.params, **rest})


@dataclass
class Search:
    best_params: dict
    best_recipe: Recipe
    best_score: tuple[float, float]
    summaries: dict[str, dict]
    tried: dict[str, dict]
    model: Fitted | None = None


def search(df: DataFrame, recipe: Recipe, candidates: list[dict], label: str, metric: str = "qwk", row_id: str = "row_id", k: int = 3, seed=42, parallelism: int = 4, refit: bool = True) -> Search:
    """Cross-validate every candidate on the same folds, keep and refit the best."""
    tried = {f"candidate_{i:03d}": p for i, p in enumerate(candidates)}
    summaries = compare(df, {n: with_params(recipe, p) for n, p in tried.items()}, label, row_id, k, seed, parallelism)
    top = best(summaries, metric)
    chosen = with_params(recipe, tried[top])
    found = Search(tried[top], chosen, summaries[top][metric], summaries, tried)
    if refit:
        found.model = fit(df, chosen, label, row_id)
    return found


def grid_search(df, recipe, space: dict[str, list], label, **kw) -> Search:
    return search(df, recipe, grid(space), label, **kw)


def random_search(df, recipe, space: dict, label, n: int = 10, seed: int = 42, **kw) -> Search:
    return search(df, recipe, draw(space, n, seed), label, seed=seed, **kw)


def champion(searches: dict[str, Search], metric: str) -> str:
    sign = 1.0 if metric in LOWER_IS_BETTER else -1.0
    return min(searches, key=lambda n: (sign * searches[n].best_score[0], n))


# ---- elimination ---------------------------------------------------------


def eliminate(df: DataFrame, recipe: Recipe, label: str, row_id: str = "row_id", keep: int = 1) -> list[str]:
    """Refit and drop the least important column until ``keep`` are left; the dropped ones in order."""
    left, dropped = list(recipe.cols), []
    while len(left) > keep:
        model = fit(df, replace(recipe, cols=tuple(left)), label, row_id)
        weight = models.importances(model.model, left)
        worst = min(left, key=lambda c: (weight[c], c))
        left.remove(worst)
        dropped.append(worst)
    return dropped


def rfe(df: DataFrame, recipe: Recipe, label: str, row_id: str = "row_id", keep: int = 1) -> dict[str, int]:
    """Rank 1 for the kept columns, then 2, 3, ... against the order of elimination."""
    with cached(df.select(row_id, *recipe.cols, label)) as rows:
        dropped = eliminate(rows, recipe, label, row_id, keep)
    ranks = {c: 1 for c in recipe.cols}
    ranks.update({c: 2 + i for i, c in enumerate(reversed(dropped))})
    return ranks


def rfecv(df: DataFrame, recipe: Recipe, label: str, row_id: str = "row_id", k: int = 3, metric: str = "r2", seed=42, parallelism: int = 4) -> tuple[int, dict[int, float], dict[str, int]]:
    """Number of columns with the best cross-validated score, score per size, ranks at that size."""
    with cached(with_folds(df.select(row_id, *recipe.cols, label), row_id, label, k, seed)) as folded:
        def one(i):
            def run():
                train, test = folded.filter(F.col("fold") != i), folded.filter(F.col("fold") == i)
                left, scores = list(recipe.cols), {}
                while left:
                    model = fit(train, replace(recipe, cols=tuple(left)), label, row_id)
                    scores[len(left)] = score(model.transform(test), label)[metric]
                    weight = models.importances(model.model, left)
                    left.remove(min(left, key=lambda c: (weight[c], c)))
                return scores
            return run

        runs = in_parallel([one(i) for i in range(k)], parallelism)
    sign = 1.0 if metric in LOWER_IS_BETTER else -1.0
    means = {size: float(np.mean([r[size] for r in runs])) for size in runs[0]}
    size = min(means, key=lambda s: (sign * means[s], s))
    return size, means, rfe(df, recipe, label, row_id, size)


def lasso_path(df: DataFrame, cols: list[str], label: str, alphas: list[float], row_id: str = "row_id", k: int = 5, seed=42) -> tuple[float, dict[str, float], dict[float, dict]]:
    """Penalty with the smallest cross-validated error, the coefficients of standardised columns at it, and the errors of every penalty.

    All penalties and folds come from one scan. Of equal errors the larger penalty wins.
    """
    found = linear.grams(with_folds(df.select(row_id, *cols, label, *(["fold"] if "fold" in df.columns else [])), row_id, label, k, seed), cols, label, "fold")
    runs: dict[float, list[dict]] = {a: [] for a in sorted(set(alphas), reverse=True)}
    for fold in found.folds:
        for a, (intercept, w) in linear.path(found.without(fold), "lasso", alphas, scaler="standard").items():
            runs[a].append({"fold": fold, **linear.errors(found.part([fold]), intercept, w)})
    summaries = {a: summarise(r) for a, r in runs.items()}
    alpha = min(runs, key=lambda a: (summaries[a]["mse"][0], -a))
    whole = found.whole()
    weights = linear.path(whole, "lasso", list(runs), scaler="standard")[alpha][1] * whole.spread("standard")
    return alpha, dict(zip(cols, map(float, weights), strict=True)), summaries


def subset_sweep(df: DataFrame, ordered: list[str], recipes: dict[str, Recipe], label: str, sizes: tuple[int, ...] = (10, 20, 30, 9999), metric: str = "qwk", **kw) -> dict[str, dict]:
    """Every recipe on the first 10, 20, 30 and all columns of an importance order."""
    steps = sorted({min(s, len(ordered)) for s in sizes})
    tried = {f"{name}_{s}_features": replace(r, cols=tuple(ordered[:s])) for s in steps for name, r in recipes.items()}
    return compare(df, tried, label, **kw)
