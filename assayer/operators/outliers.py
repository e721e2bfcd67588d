"""Outlier bounds, filters and reports; bounds are learned once and applied as a projection."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import column_quantiles
from ..functions.stats import moments, q
from ..session import cached

Bounds = dict[str, tuple[float, float]]


def iqr_fit(df: DataFrame, cols: list[str], factor: float = 1.5, exact: bool = True) -> Bounds:
    """``{column: (lower, upper)}``; a column without values has no bounds."""
    cut = column_quantiles(df, cols, [0.25, 0.75], exact=exact)[None]
    return {c: (a - factor * (b - a), b + factor * (b - a)) for c, (a, b) in cut.items() if a is not None}


def bounds_table(df: DataFrame, bounds: Bounds) -> DataFrame:
    rows = [(c, float(lo), float(hi)) for c, (lo, hi) in bounds.items()]
    return df.sparkSession.createDataFrame(rows, "feature string, lower double, upper double")


def outside(bounds: Bounds) -> dict[str, Column]:
    """One flag per column; a null is not an outlier."""
    return {c: F.coalesce((q(c) < F.lit(lo)) | (q(c) > F.lit(hi)), F.lit(False)) for c, (lo, hi) in bounds.items()}


def votes(bounds: Bounds) -> Column:
    return reduce(add, [f.cast("int") for f in outside(bounds).values()], F.lit(0))


def iqr_filter(df: DataFrame, bounds: Bounds, min_votes: int = 1) -> DataFrame:
    """Keep rows flagged in fewer than ``min_votes`` columns.

    With one vote the test is a conjunction of ranges, which reaches the scan.
    """
    if min_votes > 1:
        return df.filter(votes(bounds) < min_votes)
    for c, (lo, hi) in bounds.items():
        df = df.filter(q(c).isNull() | ((q(c) >= F.lit(lo)) & (q(c) <= F.lit(hi))))
    return df


def iqr_flagged(df: DataFrame, bounds: Bounds, min_votes: int = 1) -> DataFrame:
    return df.filter(votes(bounds) >= min_votes)


def iqr_sequential(df: DataFrame, cols: list[str], factor: float = 1.5) -> DataFrame:
    """Bounds of each column come from the rows that survived the columns before it.

    Each step adds one literal range filter to the plan over the same base, so
    the plan stays a scan with a growing predicate.
    """
    kept = df
    with cached(df.select(*cols)) as base:
        left = base
        for c in cols:
            bounds = iqr_fit(left, [c], factor)
            for lo, hi in bounds.values():
                keep = q(c).between(F.lit(lo), F.lit(hi))
                left, kept = left.filter(keep), kept.filter(keep)
    return kept


def zscore_filter(df: DataFrame, cols: list[str], limit: float = 3.0) -> DataFrame:
    """Keep rows with every |x - mean| / population deviation below ``limit``; constant columns are ignored."""
    stats = moments(df, cols)
    keep = F.lit(True)
    for c, s in stats.items():
        if s["std_pop"]:
            keep = keep & (F.abs((q(c) - F.lit(s["mean"])) / F.lit(s["std_pop"])) < F.lit(float(limit)))
    return df.filter(keep)


def removal_report(df: DataFrame, kept: Column) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("n_before"), F.count_if(kept).alias("n_after"), F.count_if(~kept).alias("n_removed"),
        (100.0 * F.count_if(~kept) / F.count(F.lit(1))).alias("pct_removed"),
    )


def overlap_code(iqr: Column, forest: Column) -> Column:
    """0 normal, 1 IQR only, 2 forest only, 3 both."""
    return (iqr.cast("int") + 2 * forest.cast("int")).alias("outlier_type")
