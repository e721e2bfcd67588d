"""Metrics as aggregations over a table of labels and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantiles import column_quantiles
from ..functions.ranks import cut_points, dense_positions, running_total
from .derive import to_class


def regression_aggs(label: str, prediction: str) -> dict[str, Column]:
    error = F.col(label) - F.col(prediction)
    mse = F.avg(error * error)
    return {"mse": mse, "rmse": F.sqrt(mse), "mae": F.avg(F.abs(error)), "r2": 1 - F.try_divide(mse, F.var_pop(label))}


def regression_metrics(df: DataFrame, label: str, prediction: str, by: str | None = None) -> DataFrame:
    """``n, mse, rmse, mae, r2``, optionally per group (for instance per split)."""
    grouped = df.groupBy(by) if by else df.groupBy()
    return grouped.agg(F.count(F.lit(1)).alias("n"), *[e.alias(m) for m, e in regression_aggs(label, prediction).items()])


def accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``n, n_correct, n_wrong, accuracy`` of the rounded prediction."""
    hit = F.rint(F.col(prediction).cast("double")) == F.col(label)
    return df.agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("n_correct"), F.count_if(~hit).alias("n_wrong"),
                  F.avg(hit.cast("double")).alias("accuracy"))


def confusion_counts(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``label, prediction, n`` of the pairs of classes that occur; the report and kappa need no more."""
    return df.groupBy(F.col(label).cast("int").alias("label"), F.col(prediction).cast("int").alias("prediction")).agg(F.count(F.lit(1)).alias("n"))


def confusion(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``label, prediction, n, share`` for every pair of classes, empty ones included.

    ``share`` is the part of the label's row. The table has classes x classes rows;
    ``confusion_counts`` is the one for many classes.
    """
    counts = confusion_counts(df, label, prediction)
    classes = counts.agg(F.array_sort(F.array_union(F.collect_set("label"), F.collect_set("prediction"))).alias("c"))
    grid = classes.select(F.explode("c").alias("label"), "c").select("label", F.explode("c").alias("prediction"))
    full = grid.join(counts, ["label", "prediction"], "left").fillna(0, ["n"])
    row = F.sum("n").over(Window.partitionBy("label"))
    return full.withColumn("share", F.coalesce(F.try_divide(F.col("n").cast("double"), row), F.lit(0.0)))


def confusion_matrix(df: DataFrame, label: str, prediction: str, classes: list[int]) -> DataFrame:
    """One row per label, one column ``pred_<class>`` per class."""
    pivoted = confusion(df, label, prediction).groupBy("label").pivot("prediction", classes).agg(F.sum("n"))
    named = pivoted.toDF("label", *[f"pred_{c}" for c in classes])
    return named.fillna(0, [f"pred_{c}" for c in classes])


def class_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """``label, precision, recall, f1, support``; a 0 / 0 counts as 0."""
    none, n = F.lit(0).cast("bigint"), F.when(F.col("label").isNotNull() & F.col("prediction").isNotNull(), F.col("n")).otherwise(0)
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)
    sides = F.inline(F.array(
        F.struct(F.col("label").alias("class"), n.alias("support"), hit.alias("hits"), none.alias("predicted")),
        F.struct(F.col("prediction").alias("class"), none.alias("support"), none.alias("hits"), n.alias("predicted"))))
    table = confusion_counts(df, label, prediction).select(sides).filter("class is not null").groupBy(F.col("class").alias("label")).agg(
        *[F.sum(c).alias(c) for c in ("support", "hits", "predicted")])
    zero = F.lit(0.0)
    table = table.withColumns({
        "precision": F.coalesce(F.try_divide(F.col("hits").cast("double"), F.col("predicted")), zero),
        "recall": F.coalesce(F.try_divide(F.col("hits").cast("double"), F.col("support")), zero),
    })
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), zero)
    return table.withColumn("f1", f1).select("label", "precision", "recall", "f1", "support")


def report_averages(report: DataFrame) -> DataFrame:
    """Macro and support-weighted means of a class report."""
    parts = []
    for m in ("precision", "recall", "f1"):
        parts.append(F.avg(m).alias(f"macro_{m}"))
        parts.append((F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(f"weighted_{m}"))
    return report.agg(*parts)


def qwk(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Quadratic weighted kappa; the weights use positions in the sorted union of classes.

    Chance disagreement over all pairs of classes is n times the two variances of position and the squared
    difference of their means, so the pairs that occur suffice.
    """
    counts = confusion_counts(df, label, prediction)
    classes = counts.select(F.explode(F.array("label", "prediction")).alias("class")).filter("class is not null").distinct()
    places = dense_positions(classes, "class", "place")
    cells = counts.join(places.toDF("label", "i"), "label").join(places.toDF("prediction", "j"), "prediction")

    def mean(c):
        return F.sum(F.col("n") * F.col(c)) / F.sum("n")

    centre = cells.agg(F.sum("n").alias("total"), mean("i").alias("mi"), mean("j").alias("mj"))

    def spread(c, m):
        return F.sum(F.col("n") * F.pow(F.col(c) - F.col(m), F.lit(2)))

    both = cells.join(F.broadcast(centre), how="cross")  # one row
    between = F.max("total") * F.pow(F.max("mi") - F.max("mj"), F.lit(2))
    seen = F.sum(F.col("n") * F.pow(F.col("i") - F.col("j"), F.lit(2)))
    return both.agg((1 - F.try_divide(seen, spread("i", "mi") + spread("j", "mj") + between)).alias("qwk"))


def qwk_regression(df: DataFrame, label: str, prediction: str, limits: tuple[int, int] | None = None) -> DataFrame:
    """Kappa of the rounded prediction, clipped to the range of the true labels or to ``limits``."""
    if limits is None:
        row = df.agg(F.min(label).alias("lo"), F.max(label).alias("hi")).first()
        limits = (row["lo"], row["hi"])
    return qwk(df.withColumn("__class", to_class(prediction, *limits)), label, "__class")


def auc_per_class(df: DataFrame, label: str, proba: dict[int, str], digits: int | None = None) -> DataFrame:
    """``label, n_pos, n_neg, auc`` one-versus-rest, ties counted half.

    Rows are merged per class and score first; the running count of negatives
    below a score is then formed slice by slice of each class's scores, in as many
    slices as its rows call for.
    """
    spots = df.select(F.col(label).alias("y"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(p).alias("s")) for c, p in proba.items()
    ])).alias("x")).select((F.col("y") == F.col("x.c")).alias("pos"), F.col("x.c").alias("c"), F.col("x.s").alias("s"))
    if digits is not None:
        spots = spots.withColumn("s", F.round("s", digits))
    merged = spots.groupBy("c", "s").agg(F.count_if("pos").alias("pos"), F.count_if(~F.col("pos")).alias("neg"))
    cuts = cut_points(df, {c: F.col(p).cast("double") for c, p in proba.items()})
    ranked = running_total(merged, "s", "neg", cuts, by="c", out="neg_below")
    won = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
    table = ranked.groupBy(F.col("c").alias("label")).agg(F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"), won.alias("won"))
    auc = F.try_divide(F.col("won"), F.col("n_pos").cast("double") * F.col("n_neg"))
    return table.select("label", "n_pos", "n_neg", auc.alias("auc"))


def macro_auc(per_class: DataFrame) -> DataFrame:
    return per_class.agg(F.avg("auc").alias("macro_auc"))


def mae_by_class(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col(label) - F.col(prediction))).alias("mae"))


def mae_improvement(df: DataFrame, label: str, baseline: str, variant: str) -> DataFrame:
    """Per class: both errors and the improvement in percent of the baseline (0 where it is 0)."""
    table = df.groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.abs(F.col(label) - F.col(baseline))).alias("mae_baseline"),
        F.avg(F.abs(F.col(label) - F.col(variant))).alias("mae_variant"))
    gain = F.coalesce(F.try_divide(100.0 * (F.col("mae_baseline") - F.col("mae_variant")), F.col("mae_baseline")), F.lit(0.0))
    return table.withColumn("improvement_pct", gain)


def error_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    errors = df.select((F.col(label) - F.col(prediction)).alias("e")).withColumn("a", F.abs("e"))
    middle = column_quantiles(errors, ["a"], [0.5])[None]["a"][0]
    return errors.agg(F.avg("a").alias("mean_abs"), F.max(F.lit(middle).cast("double")).alias("median_abs"), F.max("a").alias("max_abs"),
                      F.min("a").alias("min_abs"), F.stddev_samp("e").alias("error_std"))


def class_accuracy(df: DataFrame, label: str, prediction: str) -> DataFrame:
    hit = (F.col(label) == F.col(prediction)).cast("double")
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"), F.avg(hit).alias("accuracy"))


def train_test_gap(df: DataFrame, label: str, prediction: str, split: str = "split") -> DataFrame:
    """Metrics of both splits in one row with test minus train RMSE."""
    table = regression_metrics(df, label, prediction, split)
    parts = [F.max(F.when(F.col(split) == s, F.col(m))).alias(f"{s}_{m}") for s in ("train", "test") for m in ("rmse", "r2", "mae")]
    wide = table.agg(*parts)
    return wide.withColumns({"rmse_gap": F.col("test_rmse") - F.col("train_rmse"), "r2_gap": F.col("train_r2") - F.col("test_r2")})


def composite_score(results: DataFrame) -> DataFrame:
    """``(1/rmse + r2 + 1/mae) / 3`` for a table with those columns."""
    tiny = 1e-10
    return results.withColumn("composite", (1 / (F.col("rmse") + tiny) + F.col("r2") + 1 / (F.col("mae") + tiny)) / 3)


def composite_normalised(results: DataFrame) -> DataFrame:
    """Mean of the three metrics, each scaled to [0, 1] over the table with 1 as the best."""
    whole, tiny = Window.partitionBy(), 1e-10

    def share(m):
        low, high = F.min(m).over(whole), F.max(m).over(whole)
        return (F.col(m) - low) / (high - low + tiny)

    return results.withColumn("composite", (1 - share("rmse") + share("r2") + 1 - share("mae")) / 3)
