"""Model-agnostic explanations; every changed row is scored by the distributed model."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import row_hash
from ..functions.ranks import hash_rank
from ..functions.stats import q
from ..session import cached, cut_lineage


def _with_partner(df: DataFrame, row_id: str, cols: list[str], seed) -> DataFrame:
    """Each row beside the next row of a seeded shuffle (``__z0..``), cyclically.

    Rows are matched by their distributed rank, so this is one equi-join on
    unique keys, without a sort of the table in one place.
    """
    ranked = cut_lineage(hash_rank(df, [row_id], seed, out="__rank", total="__n"))
    other = ranked.select(((F.col("__rank") % F.col("__n")) + 1).alias("__rank"), *[q(c).alias(f"__z{i}") for i, c in enumerate(cols)])
    return ranked.join(other, "__rank").drop("__rank", "__n")


def permutation_importance(predict: Callable[[DataFrame], DataFrame], df: DataFrame, cols: list[str], label: str, row_id: str = "row_id", repeats: int = 10, seed=42) -> DataFrame:
    """``feature, importance, std``: the fall of R² when one column is shuffled.

    ``predict`` adds ``prediction``. In every repeat all columns share one
    shuffle join; the variants of a row go through the model together. The rows
    are kept while the repeats read them.
    """
    def r2_aggs():
        error = F.col(label) - F.col("prediction")
        return 1 - F.avg(error * error) / F.var_pop(F.col(label).cast("double"))

    falls: dict[str, list[float]] = {c: [] for c in cols}
    with cached(df.select(row_id, *[q(c).cast("double").alias(c) for c in cols], label)) as base:
        reference = predict(base).agg(r2_aggs().alias("r2")).first()["r2"]
        for r in range(repeats):
            pairs = _with_partner(base, row_id, cols, f"permute-{seed}-{r}")
            variants = F.explode(F.array(*[
                F.struct(F.lit(c).alias("feature"), *[(F.col(f"__z{j}") if i == j else q(d)).alias(f"v{j}") for j, d in enumerate(cols)])
                for i, c in enumerate(cols)
            ])).alias("s")
            long = pairs.select(row_id, label, variants).select(row_id, label, "s.feature", *[F.col(f"s.v{j}").alias(d) for j, d in enumerate(cols)])
            for row in predict(long).groupBy("feature").agg(r2_aggs().alias("r2")).collect():
                falls[row["feature"]].append(reference - row["r2"])
    rows = [(c, float(np.mean(v)), float(np.std(v))) for c, v in falls.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double, std double")


def sampled_shapley(predict: Callable[[DataFrame], DataFrame], df: DataFrame, cols: list[str], row_id: str = "row_id", permutations: int = 8, seed=42) -> DataFrame:
    """``feature, mean_abs_shap`` from sampled orders of the columns.

    For each row and order, a column's effect is the change of the prediction
    when it switches from a background row's value to the row's own, with the
    columns before it already switched. A point between two switches is scored
    once, for the column switched last and for the one switched next.
    """
    base = df.select(row_id, *[q(c).cast("double").alias(c) for c in cols])
    pairs = _with_partner(base, row_id, cols, f"background-{seed}").withColumn("__m", F.explode(F.sequence(F.lit(0), F.lit(permutations - 1))))
    keys = [row_hash(f"order-{seed}-{i}", row_id, "__m") for i in range(len(cols))]
    placed = pairs.withColumns({f"__k{i}": k for i, k in enumerate(keys)})
    place = []
    for i in range(len(cols)):
        before = [(F.col(f"__k{j}") < F.col(f"__k{i}")).cast("int") for j in range(len(cols)) if j != i]
        place.append(sum(before[1:], before[0]) if before else F.lit(0))
    placed = placed.withColumns({f"__p{i}": p for i, p in enumerate(place)})

    def column_at(t):
        return F.coalesce(*[F.when(F.col(f"__p{i}") == t, F.lit(c)) for i, c in enumerate(cols)])

    def mixed(t):
        return [F.when(F.col(f"__p{j}") < t, q(d)).otherwise(F.col(f"__z{j}")).alias(f"v{j}") for j, d in enumerate(cols)]

    points = F.explode(F.array(*[
        F.struct(column_at(t - 1).alias("last"), column_at(t).alias("next"), *mixed(t)) for t in range(len(cols) + 1)
    ])).alias("s")
    long = placed.select(row_id, points).select(row_id, "s.last", "s.next", *[F.col(f"s.v{j}").alias(d) for j, d in enumerate(cols)])
    sides = F.inline(F.array(*[F.struct(F.col(c).alias("feature"), F.lit(sign).alias("sign")) for c, sign in (("last", 1.0), ("next", -1.0))]))
    steps = predict(long).select(row_id, "prediction", sides).filter("feature is not null")
    effect = steps.groupBy(row_id, "feature").agg((F.sum(F.col("sign") * F.col("prediction")) / permutations).alias("phi"))
    return effect.groupBy("feature").agg(F.avg(F.abs("phi")).alias("mean_abs_shap"))
