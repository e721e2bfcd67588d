"""Profiling aggregates: every report is one pass, or one pass after the quantiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.quantiles import column_quantiles, quantile_table
from ..functions.ranks import cut_points, running_total
from ..functions.stats import column_table, moments, numeric_columns, q, string_columns

#: Coefficients of the rational approximation of the normal distribution function (absolute error below 7.5e-8).
NORMAL_SCALE, NORMAL_TERMS = 0.2316419, (0.319381530, -0.356563782, 1.781477937, -1.821255978, 1.330274429)


def shape_report(df: DataFrame) -> DataFrame:
    """``column, dtype, n_rows, non_null`` per column."""
    kinds = dict(df.dtypes)
    return column_table(
        df, df.columns,
        lambda c: {"dtype": F.lit(kinds[c]), "n_rows": F.count(F.lit(1)), "non_null": F.count(q(c))},
        key="column",
    )


def describe(df: DataFrame, cols: list[str] | None = None, exact: bool = True) -> DataFrame:
    cols = cols or numeric_columns(df)
    cut = column_quantiles(df, cols, [0.25, 0.5, 0.75], exact=exact)[None]

    def stats(c):
        v = q(c).cast("double")
        low, mid, high = (F.lit(x).cast("double") for x in cut[c])
        return {"n": F.count(v), "mean": F.avg(v), "std": F.stddev_samp(v), "min": F.min(v),
                "q25": F.max(low), "q50": F.max(mid), "q75": F.max(high), "max": F.max(v)}

    return column_table(df, cols, stats)


def null_counts(df: DataFrame, only_positive: bool = True) -> DataFrame:
    table = column_table(df, df.columns, lambda c: {"n_null": F.count_if(q(c).isNull()), "n_rows": F.count(F.lit(1))}, key="column")
    return table.filter("n_null > 0") if only_positive else table


def class_shares(df: DataFrame, label: str, total: bool = False) -> DataFrame:
    """``label, n, share`` (share in percent), one small row per class."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    everything = F.sum("n").over(Window.partitionBy())
    out = counts.withColumn("share", 100.0 * F.col("n") / everything)
    return out.withColumn("total", everything) if total else out


def imbalance_by_share(df: DataFrame, label: str, parts: int | None = None) -> DataFrame:
    """Classes below ``100 / parts`` percent against the rest; ``parts`` defaults to the class count."""
    shares = class_shares(df, label)
    limit = F.lit(100.0 / parts) if parts else 100.0 / F.count(F.lit(1)).over(Window.partitionBy())
    flagged = shares.withColumn("minority", F.col("share") < limit)
    return flagged.groupBy("minority").agg(
        F.count(F.lit(1)).alias("n_classes"), F.sum("n").alias("n_rows"), F.sum("share").alias("share")
    )


def imbalance_ratio(df: DataFrame, label: str) -> DataFrame:
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    # The smaller label wins between equal counts.
    return counts.agg(
        F.max("n").alias("max_n"), F.min("n").alias("min_n"),
        (F.max("n") / F.min("n")).alias("ratio"),
        F.min_by("label", F.struct(-F.col("n"), F.col("label"))).alias("largest"),
        F.min_by("label", F.struct(F.col("n"), F.col("label"))).alias("smallest"),
    )


def class_shares_by_split(df: DataFrame, label: str, split: str) -> DataFrame:
    """Share of each class in the full table and in each split, one pass."""
    counts = df.groupBy(F.col(label).alias("label")).agg(
        F.count(F.lit(1)).alias("n_full"),
        F.count_if(F.col(split) == "train").alias("n_train"),
        F.count_if(F.col(split) == "test").alias("n_test"),
    )
    whole = Window.partitionBy()
    return counts.select(
        "label", "n_full", "n_train", "n_test",
        *[F.try_divide(100.0 * F.col(f"n_{s}"), F.sum(f"n_{s}").over(whole)).alias(f"share_{s}") for s in ("full", "train", "test")],
    )


def content_key(cols: list[str]):
    """A short stand-in for a whole row: sha-256 over the length-marked values."""
    def marked(c):
        text = q(c).cast("string")
        return F.when(text.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), F.length(text).cast("string"), F.lit(":"), text))

    return F.sha2(F.concat(*[marked(c) for c in cols]), 256)


def duplicate_count(df: DataFrame, cols: list[str]) -> DataFrame:
    per_key = df.groupBy(content_key(cols).alias("k")).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"), (F.sum("n") - F.count(F.lit(1))).alias("n_duplicates"))


def drop_duplicates(df: DataFrame, cols: list[str], row_id: str) -> DataFrame:
    """Keep the row with the smallest id of each group of equal ``cols``.

    Only the content hash and the id are shuffled for the grouping; a group of
    copies of any size collapses to one row on the map side.
    """
    first = df.groupBy(content_key(cols).alias("k")).agg(F.min(row_id).alias(row_id)).select(row_id)
    return df.join(first, row_id, "left_semi")


def skew_screen(df: DataFrame, cols: list[str], threshold: float | None = None) -> DataFrame:
    table = column_table(df, cols, lambda c: {"skewness": F.skewness(q(c).cast("double"))})
    return table.filter(F.abs("skewness") > threshold) if threshold is not None else table


def normality(df: DataFrame, cols: list[str], alpha: float = 0.05) -> DataFrame:
    """Jarque–Bera statistic and p-value (chi-square with two degrees of freedom)."""
    def stats(c):
        v = q(c).cast("double")
        return {"n": F.count(v), "skewness": F.skewness(v), "kurtosis": F.kurtosis(v)}

    table = column_table(df, cols, stats)
    jb = F.col("n") / 6.0 * (F.pow("skewness", F.lit(2)) + F.pow("kurtosis", F.lit(2)) / 4.0)
    scored = table.withColumn("jb", jb).withColumn("p_value", F.exp(-F.col("jb") / 2.0))
    return scored.withColumn("normal", F.col("p_value") > alpha)


def normal_below(z: Column) -> Column:
    """Share of the standard normal distribution below ``z``."""
    t = 1 / (1 + NORMAL_SCALE * F.abs(z))
    tail = F.lit(0.0)
    for b in reversed(NORMAL_TERMS):
        tail = t * (F.lit(b) + tail)
    tail = tail * F.exp(-z * z / 2) / F.sqrt(2 * F.pi())
    return F.when(z < 0, tail).otherwise(1 - tail)


def ks_normality(df: DataFrame, cols: list[str], alpha: float = 0.05) -> DataFrame:
    """``feature, n, ks, p_value, normal``: the largest distance of each standardised column's distribution from the normal one.

    Equal values are merged, so that a column takes one shuffle of its distinct values; ranks are exact running totals over
    slices of each column. The p-value is the limit distribution's with Stephens' correction of n. Mean and deviation come
    from the same rows, so it is on the large side. Nulls and NaN are left out; a column without spread has no row.
    """
    clean = df.select(*[F.nanvl(q(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    stats = {c: s for c, s in moments(clean, cols, ("n", "mean", "std")).items() if s["n"] > 1 and s["std"]}
    values = clean.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), q(c).alias("v")) for c in stats])).alias("s")).select(
        "s.*").filter("v is not null") if stats else df.sparkSession.createDataFrame([], "feature string, v double")
    merged = values.groupBy("feature", "v").agg(F.count(F.lit(1)).alias("w"))
    ranked = running_total(merged, "v", "w", cut_points(clean, {c: q(c) for c in stats}) if stats else [], by="feature", out="below")
    numbers = F.col("feature")
    n, mean, std = (F.create_map(*[x for c, s in stats.items() for x in (F.lit(c), F.lit(float(s[k])))])[numbers] if stats else F.lit(1.0) for k in ("n", "mean", "std"))
    share = normal_below((F.col("v") - mean) / std)
    gap = F.greatest(F.abs(share - F.col("below") / n), F.abs(share - (F.col("below") + F.col("w")) / n))
    table = ranked.groupBy("feature").agg(F.sum("w").alias("n"), F.max(gap).alias("ks"))
    root = F.sqrt(F.col("n").cast("double"))
    x = (root + 0.12 + 0.11 / root) * F.col("ks")
    series = sum((F.exp(-2.0 * k * k * x * x) * (2.0 if k % 2 else -2.0) for k in range(1, 31)), F.lit(0.0))
    p = F.when(x < 0.2, 1.0).otherwise(F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0)))  # below 0.2 it is 1 to 12 digits
    return table.withColumn("p_value", p).withColumn("normal", F.col("p_value") > alpha)


def category_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """``column, value, n`` for every string column; one shuffle for all columns."""
    cols = cols or string_columns(df)
    return df.select(*cols).unpivot([], cols, "column", "value").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


def compare_stats(before: DataFrame, after: DataFrame, cols: list[str]) -> DataFrame:
    """mean, std, min and max before and after, and the differences of mean and std."""
    def side(df, name):
        def stats(c):
            v = q(c).cast("double")
            return {f"{name}_n": F.count(v), f"{name}_mean": F.avg(v), f"{name}_std": F.stddev_samp(v),
                    f"{name}_min": F.min(v), f"{name}_max": F.max(v)}
        return column_table(df, cols, stats)

    return side(before, "before").join(side(after, "after"), "feature").withColumns({
        "mean_diff": F.col("after_mean") - F.col("before_mean"),
        "std_diff": F.col("after_std") - F.col("before_std"),
    })


def class_box(df: DataFrame, cols: list[str], label: str | None, exact: bool = True) -> DataFrame:
    """Five numbers per class and feature."""
    cut = quantile_table(df, cols, [0.25, 0.5, 0.75], by=label, exact=exact)
    quart = cut.select(F.col("group").alias("label"), "feature", *[F.col("quantiles")[i].alias(n) for i, n in enumerate(("q25", "q50", "q75"))])
    base = df.withColumn("__label", F.col(label) if label else F.lit(0))
    ends = column_table(base, cols, lambda c: {"n": F.count(q(c)), "min": F.min(q(c).cast("double")), "max": F.max(q(c).cast("double"))}, by="__label")
    joined = ends.withColumnRenamed("feature", "__f").join(
        quart, F.col("__label").eqNullSafe(F.col("label")) & (F.col("__f") == F.col("feature")))
    out = joined.select("label", "feature", "n", "min", "q25", "q50", "q75", "max")
    return out if label else out.drop("label")
