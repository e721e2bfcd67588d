"""Seeded, reproducible splits and folds: a row's side depends on its key only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import hash_uniform, row_hash
from ..functions.ranks import hash_rank


def split(df: DataFrame, row_id: str, share: float = 0.2, seed=42) -> DataFrame:
    """Add ``split``: exactly ``ceil(share * n)`` rows are ``test``."""
    ranked = hash_rank(df, [row_id], seed, out="__rank", total="__n")
    cut = F.ceil(F.lit(float(share)) * F.col("__n"))
    return ranked.withColumn("split", F.when(F.col("__rank") <= cut, "test").otherwise("train")).drop("__rank", "__n")


def threshold_split(df: DataFrame, row_id: str, share: float = 0.2, seed=42) -> DataFrame:
    """Add ``split`` from a hash threshold: no shuffle, the share holds in expectation."""
    return df.withColumn("split", F.when(hash_uniform(row_hash(seed, row_id)) < share, "test").otherwise("train"))


def stratified_split(df: DataFrame, row_id: str, label: str, share: float = 0.2, seed=42) -> DataFrame:
    """Add ``split``: per label, the first ``floor(share * n + 0.5)`` rows in hash order are ``test``."""
    ranked = hash_rank(df, [row_id], seed, by=label, out="__rank", total="__n")
    cut = F.floor(F.lit(float(share)) * F.col("__n") + 0.5)
    return ranked.withColumn("split", F.when(F.col("__rank") <= cut, "test").otherwise("train")).drop("__rank", "__n")


def folds(df: DataFrame, row_id: str, k: int = 5, seed=42, label: str | None = None, out: str = "fold") -> DataFrame:
    """Add ``fold`` 0..k-1; sizes differ by at most one, per label if one is given."""
    ranked = hash_rank(df, [row_id], seed, by=label, out="__rank")
    return ranked.withColumn(out, ((F.col("__rank") - 1) % k).cast("int")).drop("__rank")


def hash_folds(df: DataFrame, row_id: str, k: int = 5, seed=42, out: str = "fold") -> DataFrame:
    """Add ``fold`` from the hash alone: no shuffle, sizes are equal in expectation."""
    return df.withColumn(out, F.floor(hash_uniform(row_hash(seed, row_id)) * k).cast("int"))


def repeated_folds(df: DataFrame, row_id: str, k: int = 5, repeats: int = 2, seed=42, label: str | None = None) -> DataFrame:
    """One row per row and repeat, with ``repeat`` and ``fold``."""
    parts = [folds(df, row_id, k, f"{seed}-{r}", label).withColumn("repeat", F.lit(r)) for r in range(repeats)]
    return reduce(DataFrame.unionByName, parts)
