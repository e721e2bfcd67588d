"""Exact top-k search by no-random-access aggregation.

The rows are dealt into blocks. Each block keeps one list per component, sorted by the component's value. A query reads its
lists only from the end that adds most to its score, all to the same depth. A row's lower bound adds, for lists in which it
has not been met, the least the list holds; its upper bound adds the value last read there. Once no row outside a short list
can reach the k-th best lower bound, reading stops and the scores of that list are resolved. Bounds are kept for all queries
of a block at a time, as matrix products. Groups of blocks and groups of queries, ``GROUP_BYTES`` of each, meet in one task, which
keeps the best k of the group; these are merged by a ranked window. Nothing that grows with the rows comes to the driver.

Queries are the stated set of rows, met with all blocks. Scores are sums of whole numbers and exact. Null vectors and vectors
with null or non-finite components take no part; shorter vectors are filled up with zeros; of rows that share a vec_id one
counts (the smallest vector). Equal scores are ranked by vec_id. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .vectors import finite, packed

BLOCK, QUERIES, DEPTHS = 1024, 256, (0.125, 0.25, 0.5, 0.75)
#: Bytes of row blocks, and of query blocks, that meet in one task at a time, and the groups of rows that are made if there are blocks enough.
GROUP_BYTES, LEAST_GROUPS = 1 << 23, 64
HIT = "query_id long, vec_id long, score long"


def best_of_block(queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) that hold every query's k best rows of the block, as index arrays."""
    n, width = rows.shape
    own = query_ids[:, None] == ids[None, :]
    largest = float(np.abs(queries).max(initial=0)) * float(np.abs(rows).max(initial=0)) * max(1, width)
    kind = np.float64 if largest < 2**52 else object  # doubles are exact here; beyond, Python's whole numbers
    plus, minus = np.maximum(queries, 0).astype(kind), np.minimum(queries, 0).astype(kind)
    values = rows.astype(kind)
    order = np.argsort(rows, axis=0, kind="stable")
    lists = np.take_along_axis(values, order, axis=0)
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(n)[:, None], order.shape), axis=0)
    alive = ~own
    for depth in [*(d for d in (int(n * share) for share in DEPTHS) if d > k), n]:
        met_high, met_low = (rank >= n - depth).astype(kind), (rank < depth).astype(kind)  # read from the high, the low end
        seen = lambda high, low: (
            (plus @ high)[:, None] + plus @ ((values - high) * met_high).T + (minus @ low)[:, None] + minus @ ((values - low) * met_low).T)
        upper, lower = seen(lists[n - depth], lists[depth - 1]), seen(lists[0], lists[n - 1])
        if kind is np.float64:
            lower = np.where(own, -np.inf, lower)
            least = np.partition(lower, max(0, n - k), axis=1)[:, max(0, n - k)] if n > k else np.full(len(queries), -np.inf)
            alive = ~own & (upper >= least[:, None])
        else:
            least = [sorted(v for v, o in zip(r, w, strict=True) if not o)[-k:][:1] for r, w in zip(lower, own, strict=True)]
            alive = np.array([[not o and (not t or u >= t[0]) for u, o in zip(r, w, strict=True)] for r, w, t in zip(upper, own, least, strict=True)], bool).reshape(own.shape)
        if alive.sum() <= 8 * k * len(queries):
            break
    return np.nonzero(alive)


def exact_scores(queries: np.ndarray, rows: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    out = np.zeros(len(i), np.int64)
    for at in range(0, len(i), 65_536):
        part = slice(at, at + 65_536)
        out[part] = (queries[i[part]] * rows[j[part]]).sum(axis=1)
    return out


def search(embeddings: DataFrame, is_query: Column, k: int = 5, scale: int = 256, block: int = BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` rows of highest integer inner product."""
    whole = embeddings.filter(finite() & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(scale * x.cast("double")).cast("long")).alias("vector"))
    rows = stored(whole.groupBy("vec_id").agg(F.min("vector").alias("vector")), "whole-vectors")
    asked = rows.filter(is_query)
    count, width = rows.agg(F.count("*"), F.coalesce(F.max(F.size("vector")), F.lit(0))).first()
    questions = asked.count()
    lists = packed(rows, block, count, width)
    asks = packed(asked, QUERIES, questions, width)
    blocks, fit = -(-count // block), lambda size: max(1, GROUP_BYTES // (size * max(1, width) * 8))
    row_groups = max(1, -(-blocks // fit(block)), min(blocks, LEAST_GROUPS))
    ask_groups = max(1, -(-questions // (QUERIES * fit(QUERIES))))

    def best(i: np.ndarray, ids: np.ndarray, score: np.ndarray) -> np.ndarray:
        """Places of the k best of each query."""
        order = np.lexsort((ids, -score, i))
        sorted_i = i[order]
        return order[np.arange(len(i)) - np.searchsorted(sorted_i, sorted_i) < k]

    def meet(held: pd.DataFrame, posed: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype=np.int64)]
        for q_ids, q_cells in zip(posed["ids"], posed["cells"], strict=True):
            query_ids = np.frombuffer(q_ids, np.int64)
            queries = np.frombuffer(q_cells, np.int64).reshape(len(query_ids), width)
            found = [(np.zeros(0, np.int64),) * 3]
            for r_ids, r_cells in zip(held["ids"], held["cells"], strict=True):
                ids = np.frombuffer(r_ids, np.int64)
                cells = np.frombuffer(r_cells, np.int64).reshape(len(ids), width)
                i, j = best_of_block(queries, query_ids, cells, ids, k)
                score = exact_scores(queries, cells, i, j)
                keep = best(i, ids[j], score)
                found.append((i[keep], ids[j[keep]], score[keep]))
            i, ids, score = map(np.concatenate, zip(*found, strict=True))
            keep = best(i, ids, score)
            out.append(pd.DataFrame({"query_id": query_ids[i[keep]], "vec_id": ids[keep], "score": score[keep]}))
        return pd.concat(out)

    # Both sides are dealt by group: a join would be free to broadcast the queries' copies, whose size Spark cannot foresee.
    every = lambda groups: F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    held = lists.select(F.pmod("block", F.lit(row_groups)).alias("row_group"), every(ask_groups).alias("ask_group"), "ids", "cells")
    posed = asks.select(every(row_groups).alias("row_group"), F.pmod("block", F.lit(ask_groups)).alias("ask_group"), "ids", "cells")
    hits = held.groupBy("row_group", "ask_group").cogroup(posed.groupBy("row_group", "ask_group")).applyInPandas(meet, HIT)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
