"""Embedding near-dedup by a pivot-permutation index.

A bounded sample of vectors (those whose ids hash lowest, about the square root of the count, ``PIVOTS`` at most) serves as
reference points, less those at a cosine of ``THIN`` or more to one kept before: a dense group keeps one or a few, so that its
members share lists however large it is. Each distinct vector enters the inverted lists of its ``ENTRIES`` nearest ones. The
cosine of each pair that meets in a list is checked in double precision, and counts only in the first list that both are in.
Every vector is indexed.

Equal vectors are one node with a count. Lists are cut into blocks; each pair of blocks is a task that gives a row per linked
vector (how many it met, and the smallest one it reaches there), never the pairs themselves, so a list with a third of all
vectors is spread over tasks and makes no quadratic output.

Vectors that are null, empty, zero or hold null or non-finite components link with nothing; shorter vectors are filled up
with zeros; rows that repeat a vec_id link with each other only if their vectors do. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import components
from .vectors import finite, matrix

PIVOTS, ENTRIES, BLOCK, THIN = 4096, 5, 1024, 0.7


def unit_rows(cells: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that large or small components keep their precision."""
    cells = cells / np.abs(cells).max(axis=1, keepdims=True)
    return cells / np.sqrt((cells * cells).sum(axis=1, keepdims=True))


def thinned(points: np.ndarray, limit: float = THIN) -> np.ndarray:
    """The unit rows, in order, less those at a cosine of ``limit`` or more to a row kept before."""
    keep = np.ones(len(points), bool)
    for i in range(len(points)):
        if keep[i]:
            keep[i + 1 :] &= points[i + 1 :] @ points[i] < limit
    return points[keep]


def first_shared(a: np.ndarray, b: np.ndarray, pivot: int) -> np.ndarray:
    """Of pairs of rows that are both in ``pivot``'s list, which are in no list before it."""
    earlier = np.zeros(len(a), bool)
    for k in range(a.shape[1]):
        for j in range(b.shape[1]):
            earlier |= (a[:, k] == b[:, j]) & (a[:, k] < pivot)
    return ~earlier


def block_links(frame: pd.DataFrame, first: int, second: int, pivot: int, width: int, threshold: float) -> pd.DataFrame:
    """(id, links, reached) for the linked vectors of two blocks of a list."""
    frame = frame.sort_values("id")
    a = frame[frame["block"] == first]
    b = a if first == second else frame[frame["block"] == second]
    near = lambda f: np.stack(f["near"].to_numpy()) if len(f) else np.zeros((0, 1), np.int32)
    linked = unit_rows(matrix(a["vector"], width)) @ unit_rows(matrix(b["vector"], width)).T >= threshold
    if first == second:
        np.fill_diagonal(linked, False)
    i, j = np.nonzero(linked)
    linked[i, j] = first_shared(near(a)[i], near(b)[j], pivot)
    ids_a, ids_b, m_a, m_b = (f[c].to_numpy(np.int64) for c in ("id", "m") for f in (a, b))
    i, j = np.nonzero(linked)
    nodes, at = np.unique(np.concatenate([ids_a[i], ids_b[j]]), return_inverse=True)
    left, right, reached = at[: len(i)], at[len(i) :], nodes.copy()
    while len(i):
        before = reached.copy()
        np.minimum.at(reached, left, before[right])
        np.minimum.at(reached, right, before[left])
        if (reached == before).all():
            break
    links = pd.Series(0, index=nodes)
    links = links.add(pd.Series(linked @ m_b, index=ids_a), fill_value=0)
    if first != second:
        links = links.add(pd.Series(m_a @ linked, index=ids_b), fill_value=0)
    links = links.loc[nodes].astype(np.int64)
    return pd.DataFrame({"id": nodes, "links": links.to_numpy(), "reached": reached})


def near_duplicates(embeddings: DataFrame, threshold: float = 0.9, entries: int = ENTRIES, thin: float = THIN) -> DataFrame:
    """vec_id, n_links, component_id, kept per row of ``embeddings``."""
    text = F.concat_ws(",", F.transform("embedding", lambda x: x.cast("string")))
    usable = finite() & F.exists("embedding", lambda x: x != 0)
    rows = stored(embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(usable, F.md5(text)).alias("key"), F.when(usable, F.col("embedding")).alias("vector")), "vectors")
    grouped = rows.filter("key is not null").groupBy("key").agg(F.min(F.struct("vec_id", "vector")).alias("least"), F.count("*").alias("m"))
    nodes = stored(grouped.select("key", F.col("least.vec_id").alias("id"), "m", F.col("least.vector").alias("vector")), "nodes")
    count, width = nodes.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    wanted = min(PIVOTS, max(64, int(np.ceil(np.sqrt(count)))))
    points = nodes.orderBy(F.xxhash64("id"), "id").limit(wanted).select("vector").toPandas()["vector"]
    if not len(points):
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    pivots = thinned(unit_rows(matrix(points, width)), thin)

    def describe(frames):
        for frame in frames:
            if len(frame):
                likeness = unit_rows(matrix(frame["vector"], width)) @ pivots.T
                frame["near"] = list(np.argsort(-likeness, axis=1, kind="stable")[:, :entries].astype(np.int32))
                yield frame

    described = stored(nodes.select("id", "m", "vector").mapInPandas(describe, nodes.select("id", "m", "vector", F.array(F.lit(0)).alias("near")).schema), "described")
    entered = described.select("id", F.explode("near").alias("pivot"))
    lists = entered.groupBy("pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))  # a row per pivot
    members = described.select("*", F.explode("near").alias("pivot")).join(F.broadcast(lists), "pivot")
    members = members.withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    met = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "id", "m", "vector", "near", "pivot", "block", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"))

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        pivot, first, second = key
        return block_links(frame, first, second, pivot, width, threshold)

    found = stored(met.groupBy("pivot", "first", "second").applyInPandas(run, "id long, links long, reached long"), "block-links")
    counts = found.groupBy("id").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("id").alias("a"), F.col("reached").alias("b"))).withColumnRenamed("node", "id")
    known = stored(nodes.select("key", "id", "m").join(counts, "id", "left").join(joined, "id", "left").select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("m") - 1).cast("long").alias("n_links"), F.coalesce("component", "id").alias("component_id")), "node-links")
    return rows.select("vec_id", "key").join(known, "key", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.col("vec_id") == F.col("component_id"))
