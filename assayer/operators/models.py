"""Estimators by name, as ``pyspark.ml`` stages with the usual parameter names."""

from __future__ import annotations

import json
import math

import numpy as np
import pandas as pd
from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import column_table, gram, moments, q
from .boosting import Boost

MAX_DEPTH = 30  # the deepest tree pyspark.ml grows
HELD = 1 << 29  # bytes of rows that fits side by side may keep, in memory or on disk

REGRESSORS = ("ols", "ridge", "elastic_net", "lasso", "forest_regressor", "boost_regressor", "svr")
CLASSIFIERS = ("logistic", "forest_classifier", "boost_classifier", "linear_svc", "rbf_svc")


def is_regressor(name: str) -> bool:
    if name not in REGRESSORS + CLASSIFIERS:
        raise ValueError(f"unknown estimator {name!r}")
    return name in REGRESSORS


_TREE = {"n_estimators", "max_depth", "min_samples_leaf"}
_BOOST = {"learning_rate", "subsample", "colsample_bytree", "reg_lambda", "min_samples_split", "min_child_weight", "gamma", "max_bins"}
#: Parameters that each estimator takes; any other name is an error. ``gamma`` and ``n_components`` belong to the feature map of the kernel machines.
ACCEPTED = {
    "ols": set(), "ridge": {"alpha"}, "elastic_net": {"alpha", "l1_ratio", "max_iter"}, "lasso": {"alpha", "max_iter"},
    "svr": {"epsilon", "C", "max_iter", "gamma", "n_components"}, "logistic": {"C", "l1_ratio", "max_iter"},
    "forest_regressor": _TREE | {"max_features"}, "forest_classifier": _TREE | {"max_features"},
    "boost_regressor": _TREE | _BOOST, "boost_classifier": _TREE | _BOOST,
    "linear_svc": {"C", "max_iter", "parallelism"}, "rbf_svc": {"C", "max_iter", "parallelism", "gamma", "n_components"},
}


def at_once(rows: int, row_bytes: int, most: int) -> int:
    """How many fits of ``rows`` rows may run side by side: each keeps its rows in a form of its own."""
    return max(1, min(most, HELD // max(1, rows * row_bytes)))


def kept_bytes(name: str, params: dict, columns: int) -> int:
    """About what a fit keeps of a row: a forest a count for each tree, a kernel machine its features, all others the columns."""
    if name in ("forest_regressor", "forest_classifier"):
        return 4 * params.get("n_estimators", 100) + 12 * columns + 100
    return 8 * (params.get("n_components", 100) if name in ("rbf_svc", "svr") else columns) + 50


def estimator(
    name: str, params: dict | None = None, n_rows: int | None = None, label: str = "label", seed: int = 42,
    weight: str | None = None, label_std: float | None = None,
):
    """A ``pyspark.ml`` estimator on the columns ``features`` and ``label``.

    ``alpha`` and ``C`` keep their usual meaning. Spark penalises the mean loss
    instead of the sum, for which ``n_rows`` is needed, and its linear regression
    divides the squared penalty (not the absolute one) by the population
    deviation of the label, for which ``label_std`` is needed.
    """
    p = dict(params or {})
    io = {"featuresCol": "features", "labelCol": label}
    if unknown := set(p) - ACCEPTED.get(name, set()):
        raise ValueError(f"{name} takes no {', '.join(sorted(unknown))}")
    if weight:
        io["weightCol"] = weight  # one-versus-rest hands it on to its classifiers
    n, spread = float(n_rows or 1), float(label_std or 1.0)
    if name == "ols":
        return LinearRegression(solver="normal", **io)
    if name == "ridge":
        return LinearRegression(regParam=p.get("alpha", 1.0) / n * spread, elasticNetParam=0.0, standardization=False, **io)
    if name in ("elastic_net", "lasso"):
        share = 1.0 if name == "lasso" else p.get("l1_ratio", 0.5)
        absolute, squared = p.get("alpha", 1.0) * share, p.get("alpha", 1.0) * (1 - share) * spread
        total = absolute + squared
        return LinearRegression(regParam=total, elasticNetParam=absolute / total if total else 0.0, standardization=False,
                                maxIter=p.get("max_iter", 100), **io)
    if name == "svr":
        # A linear fit with a loss that is linear in the tails.
        return LinearRegression(loss="huber", epsilon=p.get("epsilon", 1.35), regParam=1.0 / (p.get("C", 1.0) * n), standardization=False,
                                maxIter=p.get("max_iter", 50), **io)
    if name == "logistic":
        return LogisticRegression(family="multinomial", regParam=1.0 / (p.get("C", 1.0) * n), elasticNetParam=p.get("l1_ratio", 0.0),
                                  standardization=False, maxIter=p.get("max_iter", 100), **io)
    depth = min(p.get("max_depth") or MAX_DEPTH, MAX_DEPTH)
    tree = {"maxDepth": depth, "seed": seed, "minInstancesPerNode": p.get("min_samples_leaf", 1)}
    if name == "forest_regressor":
        return RandomForestRegressor(numTrees=p.get("n_estimators", 100), featureSubsetStrategy=p.get("max_features", "all"), **tree, **io)
    if name == "forest_classifier":
        return RandomForestClassifier(numTrees=p.get("n_estimators", 100), featureSubsetStrategy=p.get("max_features", "sqrt"), **tree, **io)
    if name in ("boost_regressor", "boost_classifier"):
        settings = {
            "rounds": p.get("n_estimators", 100), "rate": p.get("learning_rate", 0.1), "depth": min(p.get("max_depth") or 3, MAX_DEPTH),
            "leaf_rows": p.get("min_samples_leaf", 1), "split_rows": p.get("min_samples_split", 2), "leaf_weight": p.get("min_child_weight", 0.0),
            "l2": p.get("reg_lambda", 0.0), "gain": p.get("gamma", 0.0), "rows": p.get("subsample", 1.0), "columns": p.get("colsample_bytree", 1.0),
            "bins": p.get("max_bins", 128), "seed": seed}
        return Boost(labelCol=label, weightCol=weight or "", classes=name == "boost_classifier", settings=json.dumps(settings))
    if name in ("linear_svc", "rbf_svc"):
        svc = LinearSVC(regParam=1.0 / (p.get("C", 1.0) * n), standardization=False, maxIter=p.get("max_iter", 50))
        most = p.get("parallelism", 4)
        if name == "rbf_svc":  # the fit of a class keeps its features as blocks of doubles
            most = at_once(int(n), 8 * p.get("n_components", 100), most)
        return OneVsRest(classifier=svc, parallelism=most, **io)
    raise ValueError(f"unknown estimator {name!r}")


def assembled(df: DataFrame, cols: list[str], label: str | None = None, out: str = "features") -> DataFrame:
    """Add the vector column and, if asked, a double ``label``."""
    df = VectorAssembler(inputCols=cols, outputCol=out, handleInvalid="keep").transform(df)
    return df.withColumn("label", F.col(label).cast("double")) if label else df


def pipeline(
    cols: list[str], name: str, params: dict | None = None, n_rows: int | None = None, label: str = "label", seed: int = 42,
    label_std: float | None = None,
) -> Pipeline:
    """Assembler and estimator as one savable pipeline."""
    stage = estimator(name, params, n_rows, label, seed, label_std=label_std)
    return Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features"), stage])


def save_pipeline(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_pipeline(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def importances(model: Model, cols: list[str]) -> dict[str, float]:
    """Importance of each feature: tree importances, or absolute linear coefficients."""
    if isinstance(model, PipelineModel):
        model = model.stages[-1]
    if hasattr(model, "featureImportances"):
        values = model.featureImportances.toArray()
    elif hasattr(model, "coefficientMatrix") and model.numClasses > 2:
        values = np.abs(model.coefficientMatrix.toArray()).mean(axis=0)
    else:
        values = np.abs(model.coefficients.toArray())
    return {c: float(v) for c, v in zip(cols, values)}


def importance_table(df: DataFrame, scores: dict[str, float]) -> DataFrame:
    return df.sparkSession.createDataFrame(sorted(scores.items(), key=lambda s: (-s[1], s[0])), "feature string, importance double")


def nonzero_coefficients(model: Model) -> int:
    return int(np.count_nonzero(model.coefficients.toArray()))


def fourier_features(df: DataFrame, cols: list[str], gamma: float | None = None, n_components: int = 100, seed: int = 42, out: str = "features") -> DataFrame:
    """Random Fourier features whose inner products approximate the kernel ``exp(-gamma |x - y|²)``.

    ``gamma`` defaults to ``1 / (columns * mean variance)``. The projection is a
    small seeded matrix; each Arrow batch is one matrix product.
    """
    if gamma is None:
        spread = np.mean([(s["std_pop"] or 0.0) ** 2 for s in moments(df, cols).values()])
        gamma = 1.0 / (len(cols) * spread) if spread > 0 else 1.0
    rng = np.random.default_rng(seed)
    weights = rng.normal(0.0, math.sqrt(2.0 * gamma), (len(cols), n_components))
    shift = rng.uniform(0.0, 2.0 * math.pi, n_components)

    @F.pandas_udf("array<double>")
    def project(v: pd.Series) -> pd.Series:
        x = np.stack(v.to_numpy()) if len(v) else np.zeros((0, len(cols)))
        return pd.Series(list(math.sqrt(2.0 / n_components) * np.cos(x @ weights + shift)))

    return df.withColumn(out, array_to_vector(project(F.array(*[q(c).cast("double") for c in cols]))))


def linear_shap(df: DataFrame, cols: list[str], weights: dict[str, float]) -> DataFrame:
    """``feature, mean_abs_shap`` of a linear model: the mean of ``|w (x - mean)|``."""
    mean = {c: s["mean"] for c, s in moments(df, cols).items()}
    return column_table(df, cols, lambda c: {"mean_abs_shap": F.avg(F.abs(F.lit(float(weights[c])) * (q(c) - F.lit(mean[c]))))})


def principal_axes(df: DataFrame, cols: list[str], k: int) -> dict:
    """Loadings of the ``k`` largest components of the standardised columns.

    Only the p x p cross products leave the cluster. The sign of an axis is the
    one that makes its largest loading positive.
    """
    stats = moments(df, cols)
    mean = {c: stats[c]["mean"] for c in cols}
    std = {c: stats[c]["std_pop"] or 1.0 for c in cols}
    g = gram(df, cols, mean, std)
    values, vectors = np.linalg.eigh(g)
    order = np.argsort(values)[::-1][:k]
    axes = vectors[:, order]
    lead = np.abs(axes).round(9).argmax(axis=0)  # the first of equally large loadings
    axes = axes * np.where(axes[lead, range(len(order))] < 0, -1.0, 1.0)
    total = values.sum()
    return {"cols": cols, "mean": mean, "std": std, "axes": axes, "explained": values[order] / total if total else values[order]}


def project(df: DataFrame, axes: dict, prefix: str = "pca_") -> DataFrame:
    """Add ``pca_1..k`` as plain column arithmetic."""
    z = {c: (q(c) - F.lit(axes["mean"][c])) / F.lit(axes["std"][c]) for c in axes["cols"]}
    made = {}
    for j in range(axes["axes"].shape[1]):
        terms = [z[c] * F.lit(float(axes["axes"][i, j])) for i, c in enumerate(axes["cols"])]
        made[f"{prefix}{j + 1}"] = sum(terms[1:], terms[0])
    return df.withColumns(made)


def with_probability(df: DataFrame, classes: int, col: str = "probability") -> DataFrame:
    """Unpack a probability vector into ``p_0..p_<classes-1>``."""
    arr = vector_to_array(col)
    return df.withColumns({f"p_{i}": arr[i] for i in range(classes)})
