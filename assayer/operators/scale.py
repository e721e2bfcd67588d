"""Scalers: fit returns a few numbers per column, apply is a projection."""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.quantiles import column_quantiles
from ..functions.stats import collect_aggs, moments, q

LINEAR = ("standard", "minmax", "robust", "maxabs")
CURVED = ("quantile_uniform", "quantile_normal", "yeo_johnson")
EDGE = 1e-7  # probabilities are kept this far from 0 and 1 before the inverse normal


def scale_fit(df: DataFrame, cols: list[str], how: str = "standard", exact: bool = True, n_quantiles: int = 1000) -> dict:
    """Learned parameters ``{"how", "columns": {column: numbers}}``; a zero spread becomes 1."""
    if how in ("standard", "minmax", "maxabs"):
        needed = {"standard": ("n", "mean", "std_pop"), "minmax": ("n", "min", "max"), "maxabs": ("n", "absmax")}[how]
        stats = moments(df, cols, needed)
        pick = {
            "standard": lambda s: (s["mean"], s["std_pop"]),
            "minmax": lambda s: (s["min"], s["max"] - s["min"]),
            "maxabs": lambda s: (0.0, s["absmax"]),
        }[how]
        return {"how": how, "columns": {c: _spread(*pick(s)) for c, s in stats.items() if s["n"]}}
    if how == "robust":
        cut = column_quantiles(df, cols, [0.25, 0.5, 0.75], exact=exact)[None]
        return {"how": how, "columns": {c: _spread(m, b - a) for c, (a, m, b) in cut.items() if m is not None}}
    if how in ("quantile_uniform", "quantile_normal"):
        rows = df.count()
        n = min(n_quantiles, rows)
        probs = [i / (n - 1) for i in range(n)] if n > 1 else [0.5]
        cut = column_quantiles(df, cols, probs, exact=exact)[None]
        return {"how": how, "columns": {c: v for c, v in cut.items() if v[0] is not None}}
    if how == "yeo_johnson":
        return {"how": how, "columns": _yeo_johnson_fit(df, cols)}
    raise ValueError(f"unknown scaler {how!r}")


def _spread(centre: float, spread: float) -> tuple[float, float]:
    return float(centre), float(spread) if spread else 1.0


def scale_apply(df: DataFrame, params: dict, suffix: str = "") -> DataFrame:
    how, cols = params["how"], params["columns"]
    if how in LINEAR:
        made = {f"{c}{suffix}": (q(c) - F.lit(m)) / F.lit(s) for c, (m, s) in cols.items()}
    elif how == "yeo_johnson":
        made = {f"{c}{suffix}": (yeo_johnson(q(c).cast("double"), lam) - F.lit(m)) / F.lit(s) for c, (lam, m, s) in cols.items()}
    else:
        made = {f"{c}{suffix}": _quantile_position(cut, how == "quantile_normal")(q(c).cast("double")) for c, cut in cols.items()}
    return df.withColumns(made)


def params_table(df: DataFrame, params: dict) -> DataFrame:
    rows = [(c, params["how"], [float(x) for x in v]) for c, v in params["columns"].items()]
    return df.sparkSession.createDataFrame(rows, "feature string, how string, params array<double>")


def _quantile_position(cut: list[float], normal: bool):
    """Arrow-batched interpolation of a value's place among the learned quantiles."""
    marks = np.asarray(cut, dtype=float)
    places = np.linspace(0.0, 1.0, len(marks)) if len(marks) > 1 else np.array([0.5])
    down = -marks[::-1]
    back = 1.0 - places[::-1]
    # The inverse normal as a table of its even nodes: linear interpolation is off by less than 1e-7.
    nodes = np.linspace(-5.5, 5.5, 32_769)
    mass = np.array([NormalDist().cdf(z) for z in nodes]) if normal else None

    @F.pandas_udf("double")
    def place(v: pd.Series) -> pd.Series:
        x = v.to_numpy(dtype=float)
        # The mean of the interpolation from below and from above centres runs of equal marks.
        p = 0.5 * (np.interp(x, marks, places) + 1.0 - np.interp(-x, down, back))
        if len(marks) > 1:
            p = np.where(x <= marks[0], 0.0, np.where(x >= marks[-1], 1.0, p))
        p = np.where(np.isnan(x), np.nan, p)
        if not normal:
            return pd.Series(p).where(~np.isnan(p))
        z = np.interp(np.clip(p, EDGE, 1.0 - EDGE), mass, nodes)
        return pd.Series(z).where(~np.isnan(p))

    return place


def yeo_johnson(v: Column, lam: float) -> Column:
    up = F.log1p(v) if lam == 0 else (F.pow(v + 1, F.lit(lam)) - 1) / F.lit(lam)
    down = -F.log1p(-v) if lam == 2 else -(F.pow(1 - v, F.lit(2 - lam)) - 1) / F.lit(2 - lam)
    return F.when(v >= 0, up).otherwise(down)


def _yeo_johnson_moments(v: np.ndarray, lams: list[float]) -> np.ndarray:
    """Size, mean of ``sign * log1p|v|``, then per exponent the mean, the slope's mean, the squares and the cross product about them."""
    u, up = np.log1p(np.abs(v)), ~(v < 0)
    sign = np.where(up, 1.0, -1.0)
    out = [float(len(v)), float((sign * u).mean())]
    for lam in lams:
        w = lam if up.all() else np.where(up, lam, 2 - lam)
        power = np.exp(w * u)
        flat = np.asarray(w == 0)
        safe = np.where(flat, 1.0, w)
        y = sign * np.where(flat, u, (power - 1) / safe)
        d = np.where(flat, u * u / 2, (u * power * safe - (power - 1)) / (safe * safe))
        my, md = float(y.mean()), float(d.mean())
        out += [my, md, float(((y - my) ** 2).sum()), float(((y - my) * (d - md)).sum())]
    return np.array(out)


def _merged(a: np.ndarray | None, b: np.ndarray) -> np.ndarray:
    """The moments of two sets of rows together."""
    if a is None:
        return b
    n, m = a[0], b[0]
    out, share = a + b, m / (n + m)
    out[1] = a[1] + (b[1] - a[1]) * share
    for k in range(2, len(a), 4):
        y, d = b[k] - a[k], b[k + 1] - a[k + 1]
        out[k], out[k + 1] = a[k] + y * share, a[k + 1] + d * share
        out[k + 2] += y * y * n * share
        out[k + 3] += y * d * n * share
    return out


def _slopes(df: DataFrame, points: dict[str, list[float]]) -> dict[tuple[str, float], float | None]:
    """Slope of each column's Gaussian log-likelihood at each exponent, per row; null where numbers overflow.

    One pass of array arithmetic; a task sends the moments of its rows, a few numbers per column and exponent.
    """
    tries = list(points.values())

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: list[np.ndarray | None] = [None] * len(tries)
        with np.errstate(all="ignore"):
            for batch in batches:
                for j, lams in enumerate(tries):
                    v = batch.column(j).drop_null().to_numpy(zero_copy_only=False)
                    if len(v):
                        total[j] = _merged(total[j], _yeo_johnson_moments(v, lams))
        used = [j for j, t in enumerate(total) if t is not None]
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array([total[j] for j in used], pa.list_(pa.float64()))], names=["column", "sums"])

    rows = df.select(*[q(c).cast("double").alias(f"x{j}") for j, c in enumerate(points)])
    total: list[np.ndarray | None] = [None] * len(tries)
    with np.errstate(all="ignore"):
        for r in rows.mapInArrow(add_up, "column int, sums array<double>").collect():
            total[r["column"]] = _merged(total[r["column"]], np.array(r["sums"]))
    out: dict[tuple[str, float], float | None] = {}
    for (c, lams), sums in zip(points.items(), total, strict=True):
        for k, lam in enumerate(lams):
            var, fall = (float(x) / float(sums[0]) for x in sums[4 + 4 * k : 6 + 4 * k]) if sums is not None else (math.nan, math.nan)
            good = math.isfinite(var) and math.isfinite(fall) and var > 0
            out[c, lam] = float(sums[1]) - fall / var if good else None
    return out


def _yeo_johnson_fit(df: DataFrame, cols: list[str], passes: int = 12) -> dict:
    """Exponent of highest likelihood: where its slope, which falls, changes sign.

    The bracket starts at -2 and 2 and doubles while the slope has one sign; then each pass tries the secant's point, its flanks
    and a few even cuts of every column's bracket. A column of one value, or whose slope never turns within +-64, keeps the end
    that it leans to (1 without spread).
    """
    reach, bracket, open_cols = 2.0, {}, list(cols)
    while open_cols and reach <= 64:
        grid = [reach * k / 4 for k in range(-4, 5)]
        slope = _slopes(df, {c: grid for c in open_cols})
        for c in list(open_cols):
            known = [(lam, slope[c, lam]) for lam in grid if slope[c, lam] is not None]
            if not known:
                bracket[c] = ((1.0, 0.0), (1.0, 0.0))
            elif known[0][1] > 0 >= known[-1][1]:
                k = next(i for i, (_, s) in enumerate(known) if s <= 0)
                bracket[c] = (known[k - 1], known[k])
            elif reach >= 64 or len(known) < len(grid):
                end = known[-1] if known[-1][1] > 0 else known[0]
                bracket[c] = (end, end)
            else:
                continue
            open_cols.remove(c)
        reach *= 2
    for _ in range(passes):
        points = {}
        for c, ((a, fa), (b, fb)) in bracket.items():
            width = b - a
            if width <= 1e-11 * max(1.0, abs(a)) or fb == 0:
                continue
            middle = a + width * fa / (fa - fb)
            near = [middle - width * 1e-3, middle, middle + width * 1e-3, a + width / 3, b - width / 3]
            points[c] = sorted({x for x in near if a < x < b})
        points = {c: x for c, x in points.items() if x}
        if not points:
            break
        slope = _slopes(df, points)
        for c, tried in points.items():
            ladder = [bracket[c][0], *((x, slope[c, x]) for x in tried if slope[c, x] is not None), bracket[c][1]]
            k = next(i for i, (_, s) in enumerate(ladder) if i and s <= 0)
            bracket[c] = (ladder[k - 1], ladder[k])
    centre = {c: (a + (b - a) * fa / (fa - fb) if fa != fb else b) for c, ((a, fa), (b, fb)) in bracket.items()}
    aggs = {}
    for c in cols:
        t = yeo_johnson(q(c).cast("double"), centre[c])
        aggs[f"m|{c}"], aggs[f"s|{c}"] = F.avg(t), F.stddev_pop(t)
    got = collect_aggs(df, aggs)
    return {c: (centre[c], *_spread(got[f"m|{c}"] or 0.0, got[f"s|{c}"])) for c in cols}
