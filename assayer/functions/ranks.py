"""Exact row ranks without sorting a whole table or a hot group in one task."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .hashing import hash_bits, row_hash

SLICE_ROWS = 50_000   # rows of a column that a slice of a running total is meant to hold
MOST_SLICES = 1_024   # slices a column


def _offsets(df: DataFrame, by: list[str], bucket: str, weight: Column) -> DataFrame:
    sizes = df.groupBy(*by, bucket).agg(F.sum(weight).alias("__size"))
    before = Window.partitionBy(*by).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        *by, bucket, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"),
        F.sum("__size").over(Window.partitionBy(*by)).alias("__total"))


def _join_offsets(left: DataFrame, offsets: DataFrame, by: list[str], bucket: str) -> DataFrame:
    """Null-safe, as groups may be null; it also keeps the optimizer from copying long bucket expressions."""
    renamed = offsets.withColumnsRenamed({k: f"__r_{k}" for k in [*by, bucket]})
    cond = F.lit(True)
    for k in [*by, bucket]:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__r_{k}"))
    return left.join(renamed, cond).drop(*[f"__r_{k}" for k in [*by, bucket]])


def hash_rank(df: DataFrame, ids: list[str], seed=42, by: str | None = None, out: str = "rank", total: str | None = None) -> DataFrame:
    """Add ``out`` = 1..n in seeded hash order (ties by id), per value of ``by``, and ``total`` = n.

    Equal to ``row_number() over (partition by <by> order by md5, id)``, but the
    rows are cut into 65,536 hash buckets: the window sorts one bucket at a time
    and the bucket's offset comes from the (small) table of bucket sizes, so a
    label that holds most of the rows is still spread over all tasks.
    """
    # A struct around the label is never null and equal for equal labels, null
    # included. Window, bucket sizes and join then share these two keys, and the
    # join can reuse the window's partitioning.
    digest = row_hash(seed, *ids)
    keyed = df.withColumns({
        "__g": F.struct(F.col(by) if by else F.lit(0)), "__h": digest, "__b": F.coalesce(hash_bits(digest, 4).cast("int"), F.lit(0)),
    })
    inside = Window.partitionBy("__g", "__b").orderBy("__h", *ids)
    numbered = keyed.withColumn("__rn", F.row_number().over(inside))
    offsets = _offsets(keyed, ["__g"], "__b", F.lit(1)).withColumnsRenamed({"__g": "__rg", "__b": "__rb"})
    ranked = numbered.join(offsets, (F.col("__g") == F.col("__rg")) & (F.col("__b") == F.col("__rb")))
    added = {out: (F.col("__rn") + F.col("__before")).cast("bigint")}
    if total:
        added[total] = F.col("__total")
    return ranked.withColumns(added).drop("__g", "__h", "__b", "__rn", "__rg", "__rb", "__before", "__total")


def running_total(df: DataFrame, key: str, weight: str, bounds: list[float] | dict, by: str | None = None, out: str = "before") -> DataFrame:
    """Add the sum of ``weight`` over all smaller ``key`` values, per ``by``.

    Every key value must be one row (aggregate first). ``bounds`` are ascending
    cut points of the key, for instance approximate quantiles, or such a list per
    value of ``by``; each slice between two cuts is summed in its own task. Null
    comes before all values, NaN after them.
    """
    groups = [by] if by else []
    own = {g: np.array(b, float) for g, b in bounds.items()} if isinstance(bounds, dict) else {}
    every = np.array([] if isinstance(bounds, dict) else bounds, float)
    if not len(every) and not any(len(b) for b in own.values()):
        smaller = Window.partitionBy(*groups).orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(out, F.coalesce(F.sum(weight).over(smaller), F.lit(0)))

    @F.pandas_udf("int")
    def slice_of(g: pd.Series, k: pd.Series, missing: pd.Series) -> pd.Series:
        at = np.zeros(len(k), np.int32)
        for name, rows in g.groupby(g).indices.items():
            at[rows] = np.searchsorted(own.get(name, every), k.to_numpy()[rows], "left")
        return pd.Series(np.where(missing, -1, at))

    group = F.col(by) if by else F.lit(0)
    sliced = df.withColumn("__b", slice_of(group, F.col(key).cast("double"), F.col(key).isNull()))
    inside = Window.partitionBy(*groups, "__b").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    summed = sliced.withColumn("__in", F.coalesce(F.sum(weight).over(inside), F.lit(0)))
    offsets = _offsets(sliced, groups, "__b", F.col(weight))
    joined = _join_offsets(summed, offsets, groups, "__b")
    return joined.withColumn(out, F.col("__in") + F.col("__before")).drop("__b", "__in", "__before", "__total")


def cut_points(df: DataFrame, cols: dict) -> dict:
    """For ``running_total``: ``{name: marks}`` of each column of ``cols``, as many as its rows call for; one pass."""
    shares = F.expr("array(" + ", ".join(f"{i / MOST_SLICES}D" for i in range(1, MOST_SLICES)) + ")")  # one text, not a call per number
    parts = [F.struct(F.count(c).alias("n"), F.percentile_approx(c, shares, 10_000).alias("q")) for c in cols.values()]
    found = df.agg(*[part.alias(f"c{i}") for i, part in enumerate(parts)]).first()
    out = {}
    for name, r in zip(cols, found, strict=True):
        wanted = min(MOST_SLICES, r["n"] // SLICE_ROWS + 1) - 1
        take = np.linspace(0, len(r["q"]) - 1, wanted + 2).round().astype(int)[1:-1] if wanted else []
        out[name] = sorted({r["q"][i] for i in take})
    return out


def dense_positions(values: DataFrame, value: str, out: str) -> DataFrame:
    """Number the rows of distinct integers 0, 1, ... in order; a task sorts 4,096 possible values, the sizes make at most 1,048,576 rows."""
    keyed = values.withColumn("__b", F.shiftright(value, 12))
    numbered = keyed.withColumn("__rn", F.row_number().over(Window.partitionBy("__b").orderBy(value)))
    joined = _join_offsets(numbered, _offsets(keyed, [], "__b", F.lit(1)), [], "__b")
    return joined.select(value, (F.col("__rn") - 1 + F.col("__before")).cast("double").alias(out))
