"""The table behind each chart; nothing here draws."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import row_hash
from ..functions.quantiles import column_quantiles
from ..functions.stats import all_pairs, column_table, corr_pairs, moments, q
from .correlation import best_operations, pair_search
from .profile import class_box

KDE_GROUPS = 10_000  # groups whose curves a task adds up in memory


def histogram(df: DataFrame, cols: list[str], bins: int = 30) -> DataFrame:
    """``feature, bin, lo, hi, n`` with equal-width bins; the top edge is in the last bin."""
    spread = moments(df, cols, ("n", "min", "max"))
    spread = {c: s for c, s in spread.items() if s["n"]}

    def slot(c):
        low, width = spread[c]["min"], spread[c]["max"] - spread[c]["min"]
        v = q(c).cast("double")
        place = F.floor((v - F.lit(low)) / F.lit(width) * F.lit(float(bins))) if width > 0 else F.lit(0)
        index = F.when(v.isNotNull(), F.least(place, F.lit(bins - 1)).cast("int"))
        return F.struct(F.lit(c).alias("feature"), index.alias("bin"))

    found = (
        df.select(F.explode(F.array(*[slot(c) for c in spread])).alias("s")).select("s.*").filter("bin is not null")
        .groupBy("feature", "bin").agg(F.count(F.lit(1)).alias("n"))
    )
    grid = df.sparkSession.createDataFrame(
        [(c, b, s["min"] + (s["max"] - s["min"]) * b / bins, s["min"] + (s["max"] - s["min"]) * (b + 1) / bins)
         for c, s in spread.items() for b in range(bins)],
        "feature string, bin int, lo double, hi double",
    )
    return grid.join(found, ["feature", "bin"], "left").select("feature", "bin", "lo", "hi", F.coalesce("n", F.lit(0)).alias("n"))


def kde(df: DataFrame, col: str, points: int = 32, by: str | None = None) -> DataFrame:
    """Gaussian kernel density on an even grid from min to max, Scott bandwidth, per group.

    A task adds up the kernels of its rows over the grid of each group, so groups x
    points numbers leave it, whatever the rows. NaN counts as missing.
    """
    group = F.col(by) if by else F.lit(0)
    work = df.select(group.alias("g"), q(col).cast("double").alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    base = (
        work.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"), F.stddev_samp("v").alias("sd"))
        .withColumn("h", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).filter("h > 0")
    )
    found = base.limit(KDE_GROUPS + 1).collect()
    if len(found) > KDE_GROUPS:
        raise ValueError(f"more than {KDE_GROUPS} groups for a density curve each")
    kind = work.schema["g"].dataType.simpleString()
    low, high, wide = (np.array([r[c] for r in found], float) for c in ("lo", "hi", "h"))
    grid = low[:, None] + (high - low)[:, None] * np.arange(points) / (points - 1)

    def kernels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(grid.shape)
        for batch in batches:
            ids, values = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            order = np.argsort(ids, kind="stable")
            ids, values = ids[order], values[order]
            cuts = np.flatnonzero(np.diff(ids, prepend=-1, append=-1))
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                k = ids[a]
                z = (grid[k][:, None] - values[None, a:b]) / wide[k]
                total[k] += np.exp(-0.5 * z * z).sum(axis=1)
        at, point = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(point, pa.int32()), pa.array(total[at, point])], names=["id", "point", "part"])

    spark = df.sparkSession
    names = F.broadcast(spark.createDataFrame([(r["g"], i) for i, r in enumerate(found)], f"label {kind}, id int"))
    numbered = work.join(names, F.col("g").eqNullSafe(F.col("label"))).select("id", "v")
    sums = numbered.mapInArrow(kernels, "id int, point int, part double").groupBy("id", "point").agg(F.sum("part").alias("part"))
    frame = F.broadcast(spark.createDataFrame(
        [(r["g"], i, p, float(grid[i, p]), r["n"] * r["h"] * float(np.sqrt(2 * np.pi))) for i, r in enumerate(found) for p in range(points)],
        f"label {kind}, id int, point int, x double, whole double")) if found else spark.createDataFrame(
        [], f"label {kind}, id int, point int, x double, whole double")
    density = F.coalesce(F.col("part"), F.lit(0.0)) / F.col("whole")
    out = frame.join(sums, ["id", "point"], "left").select("label", "point", "x", density.alias("density"))
    return out if by else out.drop("label")


def box_stats(df: DataFrame, cols: list[str], factor: float = 1.5) -> DataFrame:
    """Quartiles, whisker ends and the number of points beyond them per feature."""
    cut = column_quantiles(df, cols, [0.25, 0.5, 0.75])[None]

    def stats(c):
        v = q(c).cast("double")
        low, mid, high = cut[c]
        if low is None:
            none = F.lit(None).cast("double")
            return {"n": F.count(v), "q25": F.max(none), "q50": F.max(none), "q75": F.max(none),
                    "whisker_lo": F.max(none), "whisker_hi": F.max(none), "n_out": F.count_if(v.isNotNull())}
        lower, upper = low - factor * (high - low), high + factor * (high - low)
        inside = v.between(F.lit(lower), F.lit(upper))
        return {"n": F.count(v), "q25": F.max(F.lit(low)), "q50": F.max(F.lit(mid)), "q75": F.max(F.lit(high)),
                "whisker_lo": F.min(F.when(inside, v)), "whisker_hi": F.max(F.when(inside, v)),
                "n_out": F.count_if(v.isNotNull() & ~inside)}

    return column_table(df, cols, stats)


def box_before_after(before: DataFrame, after: DataFrame, cols: list[str]) -> DataFrame:
    return box_stats(before, cols).withColumn("stage", F.lit("before")).unionByName(
        box_stats(after, cols).withColumn("stage", F.lit("after"))
    )


def violin(df: DataFrame, col: str, by: str, points: int = 32) -> DataFrame:
    """Density curve per class with the class quartiles beside it."""
    curve = kde(df, col, points, by)
    box = class_box(df, [col], by).select(F.col("label").alias("__l"), "q25", "q50", "q75")
    return curve.join(F.broadcast(box), F.col("label").eqNullSafe(F.col("__l"))).drop("__l")


def pair_sample(df: DataFrame, row_id: str, cols: list[str], label: str, n: int = 800, seed=42) -> DataFrame:
    """A seeded sample of at most ``n`` rows for a pair plot (top-n of the hash order)."""
    keyed = df.select(row_id, *cols, label).withColumn("__h", row_hash(seed, row_id))
    return keyed.orderBy("__h", row_id).limit(n).drop("__h")


def corr_triangle(df: DataFrame, cols: list[str]) -> DataFrame:
    """Strict lower triangle of the correlation matrix, in long form."""
    return corr_pairs(df, [(b, a) for a, b in all_pairs(cols)])


def residual_bins(df: DataFrame, label: str, prediction: str, bins: int = 20) -> DataFrame:
    return histogram(df.select((F.col(label) - F.col(prediction)).alias("residual")), ["residual"], bins)


def predicted_distribution(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Counts of actual and of rounded predicted values side by side."""
    both = df.select(F.explode(F.array(
        F.struct(F.col(label).cast("int").alias("value"), F.lit(1).alias("a"), F.lit(0).alias("p")),
        F.struct(F.rint(prediction).cast("int").alias("value"), F.lit(0).alias("a"), F.lit(1).alias("p")),
    )).alias("s"))
    return both.groupBy("s.value").agg(F.sum("s.a").alias("n_actual"), F.sum("s.p").alias("n_predicted"))


def interaction_scatter(df: DataFrame, row_id: str, pairs: list[tuple[str, str]], label: str, n: int = 500, seed=42) -> DataFrame:
    """``pair, x, y, label`` of one seeded sample for each of the given feature pairs."""
    cols = list(dict.fromkeys(c for p in pairs for c in p))
    sample = pair_sample(df, row_id, cols, label, n, seed)
    spots = F.explode(F.array(*[
        F.struct(F.lit(f"{a}|{b}").alias("pair"), q(a).cast("double").alias("x"), q(b).cast("double").alias("y")) for a, b in pairs
    ])).alias("s")
    return sample.select(F.col(row_id).alias("row_id"), F.col(label).alias("label"), spots).select("row_id", "label", "s.*")


def found_scatter(df: DataFrame, row_id: str, cols: list[str], label: str, pairs: int = 3) -> DataFrame:
    """``row_id, label, pair, x, y`` of all rows for the ``pairs`` feature pairs whose best operation correlates most with the label.

    One scan searches all pairs; correlations are compared to six digits, ties go to the smaller names.
    """
    best = best_operations(pair_search(df, cols, label))
    top = best.orderBy(F.round("corr_abs", 6).desc(), "f1", "f2").limit(pairs).select("f1", "f2").collect()
    if not top:
        return df.select(F.col(row_id).alias("row_id"), F.col(label).alias("label"), F.lit("").alias("pair"),
                         F.lit(0.0).alias("x"), F.lit(0.0).alias("y")).limit(0)
    spots = F.inline(F.array(*[
        F.struct(F.lit(f"{r['f1']}|{r['f2']}").alias("pair"), q(r["f1"]).cast("double").alias("x"), q(r["f2"]).cast("double").alias("y")) for r in top]))
    return df.select(F.col(row_id).alias("row_id"), F.col(label).alias("label"), spots)
