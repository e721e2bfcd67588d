"""Class rebalancing; training rows only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_uniform, row_hash
from ..functions.ranks import hash_rank
from ..functions.stats import q
from ..session import cut_lineage
from .neighbors import complete, knn_join

CLASS_LIMIT = 10_000  # classes whose sizes may come to the driver
COPIES = 10_000  # copies of one row made in one go


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """``label, n, weight`` with weight ``n / (classes * n_class)``."""
    counts = df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy()
    return counts.withColumn("weight", F.sum("n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n")))


def with_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """``df`` with each row's class weight.

    Up to ``CLASS_LIMIT`` weights are sent to all tasks: a join by shuffle would gather each class in one task.
    """
    weights = class_weights(df, label).select(F.col("label").alias("__l"), F.col("weight").alias(out))
    few = weights.limit(CLASS_LIMIT + 1).collect()
    if len(few) <= CLASS_LIMIT:
        weights = F.broadcast(df.sparkSession.createDataFrame(few, weights.schema))
    return df.join(weights, F.col(label).eqNullSafe(F.col("__l"))).drop("__l")


def random_oversample(df: DataFrame, row_id: str, label: str, seed=42, out: str = "copy") -> DataFrame:
    """Repeat rows until every class has the size of the largest; ``copy`` numbers a row's copies from 0.

    Each row of a class appears ``top // n`` times and the first ``top % n`` rows
    in hash order once more.
    """
    sizes = _class_sizes(df, label).values()
    top = max(sizes, default=0)
    ranked = hash_rank(df, [row_id], seed, by=label, out="__rank", total="__n")
    times = F.expr(f"{top} div __n + if(__rank <= {top} % __n, 1, 0)")
    return _copies(ranked, times, top // min(sizes, default=1) + 1, out, 0).drop("__n", "__rank")


def _class_sizes(df: DataFrame, label: str) -> dict:
    rows = df.groupBy(label).count().limit(CLASS_LIMIT + 1).collect()
    if len(rows) > CLASS_LIMIT:
        raise ValueError(f"{label} has more than {CLASS_LIMIT} classes")
    return {r[label]: r["count"] for r in rows}


def can_interpolate(df: DataFrame, label: str) -> bool:
    """Whether every class has a neighbour to interpolate with."""
    sizes = _class_sizes(df, label)
    return bool(sizes) and min(sizes.values()) > 1


def smote(df: DataFrame, row_id: str, cols: list[str], label: str, k: int = 5, seed=42) -> DataFrame:
    """Raise every class to the size of the largest with points between same-class neighbours.

    Returns ``row_id, copy, synthetic, neighbor, gap, <cols>, label``: the input
    rows with copy 0 and the new rows with their base row and copy 1, 2, ... The
    base rows of a class take turns in hash order; neighbour and position on the
    segment come from a hash of base row and copy, so a rerun gives the same rows.
    ``k`` is lowered to the smallest class size minus one. Rows with a missing value
    stay and are no base rows; the others of their class make up for them.
    """
    every = _class_sizes(df, label)
    sizes = {c: 0 for c in every} | _class_sizes(df.filter(complete(cols)), label)
    if not sizes or min(sizes.values()) < 2:
        raise ValueError("every class needs at least two rows without missing values")
    k = min(k, min(sizes.values()) - 1)
    top = max(every.values())
    neighbor_type = df.schema[row_id].dataType.simpleString()
    base = df.select(row_id, *[q(c).cast("double").alias(c) for c in cols], label)
    original = base.select(
        row_id, F.lit(0).cast("bigint").alias("copy"), F.lit(False).alias("synthetic"), F.lit(None).cast(neighbor_type).alias("neighbor"),
        F.lit(None).cast("double").alias("gap"), *cols, label)
    need = {c: top - n for c, n in every.items() if n < top}
    if not need:
        return original
    small = base.filter(F.col(label).isin(list(need)) & complete(cols))
    vector = F.array(*[q(c) for c in cols])
    near = knn_join(small, small, cols, k, row_id, by=label, exclude_self=True, carry=vector).withColumnsRenamed({row_id: "__base", "carry": "__v"})
    turns = F.create_map(*[x for c, n in need.items() for x in (F.lit(c), F.struct(F.lit(n // sizes[c]).alias("all"), F.lit(n % sizes[c]).alias("first")))])
    ranked = hash_rank(small, [row_id], seed, by=label, out="__rank").withColumn("__t", turns[F.col(label)])
    # The search brings the neighbours' vectors along, k at most a row; copies are made last and are not shuffled.
    around = near.groupBy("__base").agg(F.sort_array(F.collect_list(F.struct("rank", "neighbor", "__v"))).alias("__near"))
    based = ranked.join(around, F.col(row_id) == F.col("__base"))
    times = F.col("__t.all") + F.when(F.col("__rank") <= F.col("__t.first"), 1).otherwise(0)
    most = max(n // sizes[c] + 1 for c, n in need.items())
    digest = row_hash(f"smote-{seed}", row_id, "copy")
    drawn = _copies(based, times, most, "copy", 1).withColumn("gap", hash_uniform(digest)).withColumn(
        "__other", F.element_at("__near", (F.floor(hash_uniform(digest, 13) * k) + 1).cast("int")))
    made = drawn.select(
        row_id, "copy", F.lit(True).alias("synthetic"), F.col("__other.neighbor").alias("neighbor"), "gap",
        *[(q(c) + F.col("gap") * (F.col("__other.__v")[i] - q(c))).alias(c) for i, c in enumerate(cols)], label)
    return original.unionByName(made)


def _copies(df: DataFrame, times: Column, most: int, out: str, first: int) -> DataFrame:
    """Each row ``times`` times, numbered from ``first``; where ``most`` copies are too many for one task, chunks of them are dealt out."""
    counted = df.withColumn("__times", times.cast("bigint")).filter("__times > 0")
    if most > COPIES:
        counted = counted.withColumn("__from", F.explode(F.expr(f"sequence(0L, __times - 1, {COPIES}L)")))
        tasks = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
        counted = counted.repartition(tasks).withColumn("__times", F.least(F.col("__times") - F.col("__from"), F.lit(COPIES)))
    else:
        counted = counted.withColumn("__from", F.lit(0).cast("bigint"))
    numbers = F.sequence(F.col("__from") + first, F.col("__from") + F.col("__times") + (first - 1))
    return counted.withColumn(out, F.explode(numbers)).drop("__times", "__from")


def tomek_links(df: DataFrame, row_id: str, cols: list[str], label: str) -> DataFrame:
    """``row_id`` of every row whose nearest neighbour is of another class and has it as nearest in turn."""
    near = knn_join(df, df, cols, 1, row_id, exclude_self=True).select(F.col(row_id).alias("a"), F.col("neighbor").alias("b"))
    near = cut_lineage(near)
    back = near.select(F.col("b").alias("a"), F.col("a").alias("b"))
    mutual = near.intersect(back)
    labels = df.select(F.col(row_id).alias("__id"), F.col(label).alias("__y"))
    left = mutual.join(labels.withColumnsRenamed({"__id": "a", "__y": "ya"}), "a")
    both = left.join(labels.withColumnsRenamed({"__id": "b", "__y": "yb"}), "b")
    return both.filter("ya <> yb").select(F.col("a").alias(row_id))


def drop_tomek(df: DataFrame, row_id: str, cols: list[str], label: str) -> DataFrame:
    """Remove both rows of every link."""
    return df.join(tomek_links(df, row_id, cols, label), row_id, "left_anti")


def smote_tomek(df: DataFrame, row_id: str, cols: list[str], label: str, k: int = 5, seed=42) -> DataFrame:
    """SMOTE, then both rows of every Tomek link go; ``uid`` names rows and copies.

    A table with a class of one row comes back as it is.
    """
    if not can_interpolate(df, label):
        plain = df.select(row_id, F.lit(0).cast("bigint").alias("copy"), F.lit(False).alias("synthetic"), *[q(c).cast("double").alias(c) for c in cols], label)
        return plain.withColumn("uid", F.concat_ws(":", row_id, "copy"))
    grown = smote(df, row_id, cols, label, k, seed).drop("neighbor", "gap")
    grown = cut_lineage(grown.withColumn("uid", F.concat_ws(":", row_id, "copy")))
    return drop_tomek(grown, "uid", cols, label)
