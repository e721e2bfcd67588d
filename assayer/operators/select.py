"""Feature scores from statistics, and the ways to combine several scores."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantiles import column_quantiles
from ..functions.stats import column_table, q
from .correlation import target_corr


def by_correlation(scores: DataFrame, threshold: float = 0.1) -> DataFrame:
    return scores.filter(F.col("corr_abs") >= threshold)


def top_k(scores: DataFrame, score: str, k: int) -> DataFrame:
    return scores.orderBy(F.desc(score), "feature").limit(k)


def f_regression(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """``feature, f_score``: the F statistic of a one-variable linear fit."""
    def stats(c):
        r = F.corr(q(c).cast("double"), q(label).cast("double"))
        n = F.count_if(q(c).isNotNull() & q(label).isNotNull())
        return {"r2": r * r, "n": n}

    table = column_table(df, cols, stats)
    return table.select("feature", (F.try_divide(F.col("r2"), 1 - F.col("r2")) * (F.col("n") - 2)).alias("f_score"))


def f_classif(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    """``feature, f_score``: one-way analysis of variance from per-class moments."""
    def stats(c):
        v = q(c).cast("double")
        return {"n": F.count(v), "mean": F.avg(v), "var": F.var_pop(v)}

    classes = column_table(df.filter(F.col(label).isNotNull()), cols, stats, by=label).filter("n > 0")
    whole = Window.partitionBy("feature")
    grand = F.sum(F.col("n") * F.col("mean")).over(whole) / F.sum("n").over(whole)
    sums = classes.withColumn("grand", grand).groupBy("feature").agg(
        F.sum(F.col("n") * F.pow(F.col("mean") - F.col("grand"), F.lit(2))).alias("between"),
        F.sum(F.col("n") * F.col("var")).alias("within"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"),
    )
    f = F.try_divide(F.col("between") / (F.col("k") - 1), F.col("within") / (F.col("n") - F.col("k")))
    return sums.select("feature", f.alias("f_score"))


def binned_mutual_information(df: DataFrame, cols: list[str], label: str, bins: int = 10, bin_label: bool = False) -> DataFrame:
    """``feature, mi`` in nats over quantile bins; ``bin_label`` also bins a continuous target.

    Only the (feature, bin, label) counts are shuffled.
    """
    probs = [i / bins for i in range(1, bins)]
    cut = column_quantiles(df, cols + ([label] if bin_label else []), probs)[None]

    def slot(c):
        v = q(c).cast("double")
        edges = [e for e in cut[c] if e is not None]
        return reduce(lambda a, b: a + b, [(v > F.lit(e)).cast("int") for e in edges], F.lit(0))

    y = slot(label).cast("string") if bin_label else q(label).cast("string")
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.when(q(c).isNotNull(), slot(c)).alias("b")) for c in cols])
    spots = df.filter(q(label).isNotNull()).select(y.alias("y"), F.explode(cells).alias("s")).select("y", "s.*").filter("b is not null")
    counts = spots.groupBy("feature", "b", "y").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("feature"))
    in_bin = F.sum("n").over(Window.partitionBy("feature", "b"))
    in_class = F.sum("n").over(Window.partitionBy("feature", "y"))
    parts = counts.select("feature", (F.col("n") / total * F.log(F.col("n") * total / in_bin / in_class)).alias("part"))
    return parts.groupBy("feature").agg(F.greatest(F.sum("part"), F.lit(0.0)).alias("mi"))


def low_variance(df: DataFrame, cols: list[str], share: float = 0.01) -> DataFrame:
    """Features whose variance lies below the ``share`` quantile of all variances."""
    table = column_table(df, cols, lambda c: {"variance": F.var_samp(q(c).cast("double"))})
    limit = F.percentile("variance", share).over(Window.partitionBy())
    return table.withColumn("limit", limit).filter("variance < limit").drop("limit")


def min_max(col: str):
    """Scale a score column of a feature table to [0, 1]; a constant column becomes 0."""
    whole = Window.partitionBy()
    low, high = F.min(col).over(whole), F.max(col).over(whole)
    return F.when(high > low, (F.col(col) - low) / (high - low)).otherwise(F.when(F.col(col).isNotNull(), 0.0))


def join_scores(f_scores: DataFrame, mi_scores: DataFrame) -> DataFrame:
    """F and MI scores side by side, each also scaled to [0, 1]."""
    both = f_scores.select("feature", "f_score").join(mi_scores.select("feature", "mi"), "feature")
    return both.withColumns({"f_norm": min_max("f_score"), "mi_norm": min_max("mi")})


def picks(df: DataFrame, chosen: dict[str, list[str]]) -> DataFrame:
    """The long table ``method, feature`` from driver-side choices."""
    return df.sparkSession.createDataFrame([(m, f) for m, fs in chosen.items() for f in fs], "method string, feature string")


def common_and_all(a: DataFrame, b: DataFrame) -> DataFrame:
    """``feature, in_both`` over the union of two feature lists."""
    both = a.select("feature").intersect(b.select("feature")).withColumn("in_both", F.lit(True))
    return a.select("feature").union(b.select("feature")).distinct().join(both, "feature", "left").fillna(False, ["in_both"])


def vote(picks_table: DataFrame, n_methods: int) -> DataFrame:
    """``feature, votes, by_half, by_all``; half is rounded down but at least one."""
    need = max(1, n_methods // 2)
    counted = picks_table.select("method", "feature").distinct().groupBy("feature").agg(F.count(F.lit(1)).alias("votes"))
    return counted.withColumns({"by_half": F.col("votes") >= need, "by_all": F.col("votes") == n_methods})


def removal_candidates(reasons: dict[str, DataFrame]) -> DataFrame:
    """``feature, reasons`` (sorted, comma separated) from one feature list per reason."""
    parts = [t.select("feature", F.lit(name).alias("reason")) for name, t in reasons.items()]
    merged = reduce(DataFrame.union, parts)
    return merged.groupBy("feature").agg(F.concat_ws(", ", F.sort_array(F.collect_set("reason"))).alias("reasons"))


# The weights of the combined ranking; VIF and RFE count inverted.
RANK_WEIGHTS = {"vif": 0.10, "corr": 0.15, "f_score": 0.15, "mi": 0.15, "forest": 0.20, "rfe": 0.25}
INVERTED = ("vif", "rfe")


def weighted_rank(scores: dict[str, DataFrame], weights: dict[str, float] = RANK_WEIGHTS, k: int | None = None) -> DataFrame:
    """Weighted sum of min-max scaled scores.

    ``scores`` maps a score name to a table ``feature, <name>``; the first one
    lists all features and the others are joined to it.
    """
    names = list(scores)
    table = reduce(lambda a, b: a.join(b, "feature", "left"), [scores[n].select("feature", n) for n in names])
    scaled = table.withColumns({f"{n}_norm": (1 - min_max(n)) if n in INVERTED else min_max(n) for n in names})
    total = reduce(lambda a, b: a + b, [F.coalesce(F.col(f"{n}_norm"), F.lit(0.0)) * weights[n] for n in names])
    ranked = scaled.withColumn("total", total)
    return ranked.orderBy(F.desc("total"), "feature").limit(k) if k else ranked


def method_matrix(picks_table: DataFrame, methods: list[str]) -> DataFrame:
    return picks_table.groupBy("feature").pivot("method", methods).agg(F.lit(1)).fillna(0, methods)
