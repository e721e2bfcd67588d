"""One-pass statistics: many columns in one aggregate, returned as a long table."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = 120  # aggregate expressions per job; more outgrow generated code


def q(name: str) -> Column:
    return F.col(f"`{name}`")


def numeric_columns(df: DataFrame, exclude: tuple[str, ...] | list[str] = ()) -> list[str]:
    """Names of the numeric columns in schema order, without ``exclude``."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType) and f.name not in exclude]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def column_table(df: DataFrame, cols: list[str], stats, by: str | None = None, key: str = "feature") -> DataFrame:
    """One row per column (and group): ``stats(col_name)`` gives ``{name: aggregate}``.

    All columns share one aggregation pass, up to the number of expressions that
    generated code carries; a wider table takes a pass per slice of columns.
    """
    width = max(1, CHUNK // max(1, len(stats(cols[0])))) if cols else 1
    if len(cols) > width:
        slices = [cols[i:i + width] for i in range(0, len(cols), width)]
        return reduce(DataFrame.unionByName, [column_table(df, part, stats, by, key) for part in slices])
    rows = F.array(*[
        F.struct(F.lit(c).alias(key), *[expr.alias(name) for name, expr in stats(c).items()]) for c in cols
    ])
    grouped = df.groupBy(by) if by else df.groupBy()
    keep = [by] if by else []
    return grouped.agg(rows.alias("__rows")).select(*keep, F.inline("__rows"))


def collect_aggs(df: DataFrame, aggs: dict[str, Column], chunk: int = CHUNK) -> dict:
    """Driver-side values of named aggregates, a bounded number per job."""
    names, out = list(aggs), {}
    for i in range(0, len(names), chunk):
        part = names[i:i + chunk]
        row = df.agg(*[aggs[n].alias(f"a{j}") for j, n in enumerate(part)]).first()
        out.update({n: row[f"a{j}"] for j, n in enumerate(part)})
    return out


MOMENTS = {
    "n": F.count, "mean": F.avg, "std_pop": F.stddev_pop, "std": F.stddev_samp,
    "min": F.min, "max": F.max, "absmax": lambda c: F.max(F.abs(c)),
}


def moments(df: DataFrame, cols: list[str], kinds: tuple[str, ...] = ("n", "mean", "std_pop")) -> dict[str, dict]:
    """The wanted moments of every column on the driver; one pass."""
    got = collect_aggs(df, {f"{k}|{c}": MOMENTS[k](q(c).cast("double")) for c in cols for k in kinds})
    return {c: {k: got[f"{k}|{c}"] for k in kinds} for c in cols}


def corr_pairs(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """``f1, f2, corr`` for the given pairs; rows with a null in a pair are left out of that pair."""
    if not pairs:
        return df.sparkSession.createDataFrame([], "f1 string, f2 string, corr double")
    if len(pairs) <= CHUNK:
        rows = F.array(*[
            F.struct(F.lit(a).alias("f1"), F.lit(b).alias("f2"), _clean(F.corr(q(a).cast("double"), q(b).cast("double"))).alias("corr"))
            for a, b in pairs
        ])
        return df.agg(rows.alias("__rows")).select(F.inline("__rows"))
    cols = list(dict.fromkeys(c for p in pairs for c in p))
    wanted = df.sparkSession.createDataFrame(pairs, "f1 string, f2 string")
    return wanted.join(_matrix_corr(df, cols), ["f1", "f2"]).select("f1", "f2", "corr")


def _clean(c: Column) -> Column:
    return F.when(F.isnan(c), None).otherwise(c)


def _matrix_corr(df: DataFrame, cols: list[str]) -> DataFrame:
    """All ordered pairs from per-batch matrix products: one pass for any width."""
    centre = collect_aggs(df, {c: F.avg(q(c).cast("double")) for c in cols})
    mid = np.array([centre[c] or 0.0 for c in cols])
    p = len(cols)

    def partial(batches):
        total = np.zeros((6, p, p))
        for pdf in batches:
            x = pdf.to_numpy(dtype=float) - mid
            seen = (~np.isnan(x)).astype(float)
            x = np.where(seen > 0, x, 0.0)
            sq = x * x
            total += np.stack([seen.T @ seen, x.T @ seen, seen.T @ x, sq.T @ seen, seen.T @ sq, x.T @ x])
        i, j = (a.ravel() for a in np.indices((p, p)))
        yield pd.DataFrame({"i": i, "j": j, **{f"s{k}": total[k].ravel() for k in range(6)}})

    numeric = df.select(*[q(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
    ddl = "i int, j int, " + ", ".join(f"s{k} double" for k in range(6))
    s = numeric.mapInPandas(partial, ddl).groupBy("i", "j").agg(*[F.sum(f"s{k}").alias(f"s{k}") for k in range(6)])
    n, sx, sy, sxx, syy, sxy = (F.col(f"s{k}") for k in range(6))
    var_x, var_y, cov = n * sxx - sx * sx, n * syy - sy * sy, n * sxy - sx * sy
    names = F.array(*[F.lit(c) for c in cols])
    return s.select(
        F.element_at(names, F.col("i") + 1).alias("f1"), F.element_at(names, F.col("j") + 1).alias("f2"),
        F.when((var_x > 0) & (var_y > 0), cov / F.sqrt(var_x) / F.sqrt(var_y)).alias("corr"),
    )


def corr_values(df: DataFrame, pairs: list[tuple[str, str]]) -> dict[tuple[str, str], float | None]:
    return {(r["f1"], r["f2"]): r["corr"] for r in corr_pairs(df, pairs).collect()}


def gram(df: DataFrame, cols: list[str], centre: dict[str, float] | None = None, scale: dict[str, float] | None = None) -> np.ndarray:
    """XᵀX over rows without nulls, as a p x p array on the driver, in one pass."""
    def value(c):
        v = q(c).cast("double")
        if centre:
            v = v - F.lit(float(centre[c]))
        return v / F.lit(float(scale[c])) if scale else v

    clean = df.select(*[value(c).alias(f"x{i}") for i, c in enumerate(cols)]).dropna()
    p = len(cols)
    out = np.zeros((p, p))
    if p * (p + 1) // 2 <= CHUNK:
        pairs = [(i, j) for i in range(p) for j in range(i, p)]
        got = collect_aggs(clean, {f"{i},{j}": F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i, j in pairs})
        for i, j in pairs:
            out[i, j] = out[j, i] = got[f"{i},{j}"] or 0.0
        return out

    def partial(batches):
        total = np.zeros((p, p))
        for pdf in batches:
            x = pdf.to_numpy(dtype=float)
            total += x.T @ x
        i, j = (a.ravel() for a in np.indices((p, p)))
        yield pd.DataFrame({"i": i, "j": j, "s": total.ravel()})

    for r in clean.mapInPandas(partial, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect():
        out[r["i"], r["j"]] = r["s"]
    return out


def all_pairs(cols: list[str]) -> list[tuple[str, str]]:
    return list(combinations(cols, 2))
