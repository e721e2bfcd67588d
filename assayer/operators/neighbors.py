"""Exact nearest-neighbour join without forming all pairs.

The points of each group are cut into boxes by a k-d tree that is built from a
bounded sample. A query first searches its own box, which gives an upper bound
on its k-th distance; it then visits only the boxes that its ball touches.
Boxes that hold many rows, or that many queries visit, are worked off in blocks,
so no task ever sees more than one block of points and one of queries. Copies of
one vector are cut to the few that can be among the neighbours before the join.

In many dimensions boxes and bounds use a shorter image of each vector: its
coordinates on the leading principal axes and its distance from the space they
span. Images never lie further apart than the vectors, so whatever they rule out
is ruled out. Inside a block a matrix product gives all distances up to a known
rounding error; those that may be among the nearest are then worked out exactly.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.hashing import hash_uniform, row_hash
from ..functions.stats import q
from ..session import cut_lineage

LEAF_ROWS = 1024       # points aimed at per box
BLOCK = 4096           # rows of either side in one task's block
BUNDLE = 128           # boxes that are first tested as one larger box
MAX_LEAVES = 16_384    # boxes over all groups; their bounds are sent to every task
SAMPLE_PER_LEAF = 32
GROUP_LIMIT = 10_000
AXES = 12              # principal axes of an image; vectors up to this length are their own image
WIDE = 16              # so many times as many rows a box and a block, where vectors are longer: each row sent is compared with more
ROUNDING = 1e-12       # slack of bounds, as a share of the largest coordinate


def knn_join(
    queries: DataFrame, points: DataFrame, cols: list[str], k: int, row_id: str = "row_id",
    by: str | None = None, exclude_self: bool = False, leaf_rows: int | None = None, carry: Column | None = None,
) -> DataFrame:
    """``<row_id>, neighbor, distance, rank`` of the ``k`` nearest points of every query row.

    With ``by`` only points of the same group count. Ties go to the smaller id.
    Rows with a null, NaN or infinite coordinate are no neighbours and have none.
    ``carry``, an array of doubles over the points, comes along as a column of that
    name; a join on ``neighbor`` afterwards would send a pile of copies to one task.
    """
    raw = _prepare(points, cols, row_id, by, F.array().cast("array<double>") if carry is None else carry)
    trees, image = _build_trees(raw, len(cols), leaf_rows or LEAF_ROWS * _wide(len(cols)))
    leaf_of, image_of = _leaf_udf(trees), _image_udf(image)
    # Of equal vectors only the k + 1 smallest ids can matter; the filter on the
    # row number is applied before the shuffle as well, so copies do not pile up.
    same_vector = Window.partitionBy("g", "v").orderBy("id")
    p = raw.withColumn("__n", F.row_number().over(same_vector)).filter(F.col("__n") <= k + 1).drop("__n")
    p = cut_lineage(p.withColumn("w", image_of("v")).withColumn("leaf", leaf_of("g", "w")))
    boxes = _boxes(p, image.width if image else len(cols))
    qs = _prepare(queries, cols, row_id, by).withColumn("w", image_of("v")).withColumn("leaf", leaf_of("g", "w")).filter("leaf >= 0")
    found = _block_join(qs.withColumn("d2", F.lit(float("inf"))), p, boxes, k, exclude_self, len(cols))
    if len(boxes) > len(trees):
        found = cut_lineage(found)
        reach = found.groupBy("qid").agg(F.max("d2").alias("far"), F.count(F.lit(1)).alias("have"))
        wide = qs.join(reach, qs.id == reach.qid, "left").withColumn(
            "d2", F.when(F.col("have") >= k, F.col("far")).otherwise(F.lit(float("inf"))))
        visit = _visit_udf(trees, boxes)
        guests = cut_lineage(wide.select("id", "v", "d2", visit("g", "w", "leaf", "d2").alias("leaf"))).withColumn("leaf", F.explode("leaf"))
        found = _top_k(found.unionByName(_block_join(guests, p, boxes, k, exclude_self, len(cols))), k)
    ranked = Window.partitionBy("qid").orderBy("d2", "neighbor")
    return found.select(
        F.col("qid").alias(row_id), "neighbor", F.sqrt("d2").alias("distance"), F.row_number().over(ranked).alias("rank"),
        *([] if carry is None else [F.col("c").alias("carry")]))


def _wide(dims: int) -> int:
    return WIDE if dims > AXES else 1


def _prepare(df: DataFrame, cols: list[str], row_id: str, by: str | None, carry: Column | None = None) -> DataFrame:
    group = F.col(by).cast("string") if by else F.lit("")
    return df.filter(complete(cols)).select(
        group.alias("g"), F.col(row_id).alias("id"), F.array(*[q(c).cast("double") for c in cols]).alias("v"),
        *([] if carry is None else [carry.alias("c")]))


class Image:
    """Vectors on the leading principal axes of a sample, and the length of what the axes leave out.

    By the triangle inequality two vectors are at least as far apart as their images. The sample affects work only.
    """

    def __init__(self, sample: np.ndarray) -> None:
        self.mean = sample.mean(axis=0)
        _, vectors = np.linalg.eigh(np.cov(sample - self.mean, rowvar=False))
        self.axes = vectors[:, ::-1][:, :AXES]
        self.width = self.axes.shape[1] + 1

    def of(self, x: np.ndarray) -> np.ndarray:
        z = x - self.mean
        lead = z @ self.axes
        rest = z - lead @ self.axes.T
        return np.column_stack([lead, np.sqrt((rest * rest).sum(axis=1))])


def complete(cols: list[str]) -> Column:
    """Whether all coordinates are finite numbers; NaN is above infinity in Spark's order."""
    return reduce(and_, [F.coalesce(F.abs(q(c).cast("double")) < float("inf"), F.lit(False)) for c in cols])


def _top_k(found: DataFrame, k: int) -> DataFrame:
    nearest = Window.partitionBy("qid").orderBy("d2", "neighbor")
    return found.withColumn("__n", F.row_number().over(nearest)).filter(F.col("__n") <= k).drop("__n")


def _build_trees(p: DataFrame, dims: int, leaf_rows: int) -> tuple[dict, Image | None]:
    """A tree per group over the images of a sample, and how to form images; None where vectors are short or none were drawn."""
    sizes = {r["g"]: r["count"] for r in p.groupBy("g").count().limit(GROUP_LIMIT + 1).collect()}
    if len(sizes) > GROUP_LIMIT:
        raise ValueError(f"more than {GROUP_LIMIT} groups in a nearest-neighbour join")
    wanted = {g: max(1, -(-n // leaf_rows)) for g, n in sizes.items()}
    total = sum(wanted.values())
    if total > MAX_LEAVES:
        wanted = {g: max(1, w * MAX_LEAVES // total) for g, w in wanted.items()}
    samples: dict = {}
    split = {g: w for g, w in wanted.items() if w > 1}
    if split:
        share = F.create_map(*[x for g, w in split.items() for x in (F.lit(g), F.lit(min(1.0, SAMPLE_PER_LEAF * _wide(dims) * w / sizes[g])))])
        drawn = p.filter(hash_uniform(row_hash("tree", "id")) < F.try_element_at(share, F.col("g"))).select("g", "v")
        for r in drawn.collect():
            samples.setdefault(r["g"], []).append(r["v"])
    every = [v for part in samples.values() for v in part]
    image = Image(np.array(every, dtype=float)) if dims > AXES and len(every) > 1 else None
    trees, offset = {}, 0
    for g, w in wanted.items():
        drawn = np.array(samples.get(g, []), dtype=float).reshape(-1, dims)
        tree = _kd_tree(image.of(drawn) if image else drawn, w)
        tree["offset"] = offset
        offset += tree["leaves"]
        trees[g] = tree
    return trees, image


def _kd_tree(sample: np.ndarray, leaves: int) -> dict:
    """Arrays ``dim, cut, left, right``; a negative child ``-1 - i`` is leaf ``i``."""
    dim, cut, child = [], [], []
    count = 0

    def grow(rows: np.ndarray, want: int) -> int:
        nonlocal count
        widest = int(np.argmax(np.ptp(rows, axis=0))) if want > 1 and len(rows) > 1 else -1
        middle = float(np.median(rows[:, widest])) if widest >= 0 else 0.0
        right_side = rows[:, widest] > middle if widest >= 0 else None
        if widest < 0 or not right_side.any():
            count += 1
            return -count
        node = len(dim)
        dim.append(widest)
        cut.append(middle)
        child.append([0, 0])
        child[node][0] = grow(rows[~right_side], want - want // 2)
        child[node][1] = grow(rows[right_side], want // 2)
        return node

    root = grow(sample, leaves)
    return {"root": root, "dim": np.array(dim, dtype=int), "cut": np.array(cut), "child": np.array(child, dtype=int).reshape(-1, 2), "leaves": count}


def _descend(tree: dict, x: np.ndarray) -> np.ndarray:
    at = np.full(len(x), tree["root"])
    while True:
        inner = np.flatnonzero(at >= 0)
        if not len(inner):
            return -1 - at
        node = at[inner]
        side = (x[inner, tree["dim"][node]] > tree["cut"][node]).astype(int)
        at[inner] = tree["child"][node, side]


def _matrix(v: pd.Series) -> np.ndarray:
    return np.stack(v.to_numpy()) if len(v) else np.zeros((0, 0))


def _image_udf(image: Image | None):
    if image is None:
        return F.col

    @F.pandas_udf("array<double>")
    def image_of(v: pd.Series) -> pd.Series:
        return pd.Series(list(image.of(_matrix(v)))) if len(v) else pd.Series([], dtype=object)

    return image_of


def _leaf_udf(trees: dict):
    @F.pandas_udf("int")
    def leaf_of(g: pd.Series, v: pd.Series) -> pd.Series:
        x, out = _matrix(v), np.full(len(g), -1)
        for name, rows in g.groupby(g, dropna=False).indices.items():
            tree = trees.get(name)
            if tree is not None:
                out[rows] = tree["offset"] + _descend(tree, x[rows])
        return pd.Series(out)

    return leaf_of


def _boxes(p: DataFrame, dims: int) -> dict[int, tuple[int, list, list]]:
    """Row count, lower and upper corner of the points in each leaf (at most MAX_LEAVES rows)."""
    lows = F.array(*[F.min(F.col("w")[i]) for i in range(dims)])
    highs = F.array(*[F.max(F.col("w")[i]) for i in range(dims)])
    rows = p.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), lows.alias("lo"), highs.alias("hi")).collect()
    return {r["leaf"]: (r["n"], r["lo"], r["hi"]) for r in rows}


def _visit_udf(trees: dict, boxes: dict):
    by_group = {}
    for g, tree in trees.items():
        mine = [i for i in range(tree["offset"], tree["offset"] + tree["leaves"]) if i in boxes]
        by_group[g] = (np.array(mine, dtype=int), np.array([boxes[i][1:] for i in mine], dtype=float))

    @F.pandas_udf("array<int>")
    def visit(g: pd.Series, v: pd.Series, leaf: pd.Series, d2: pd.Series) -> pd.Series:
        x, own = _matrix(v), leaf.to_numpy()
        size = max((np.abs(corner).max() for _, corner in by_group.values() if len(corner)), default=0.0)
        reach = _slack(d2.to_numpy(), x, size)
        out = [[] for _ in range(len(g))]
        for name, rows in g.groupby(g, dropna=False).indices.items():
            ids, corner = by_group[name]
            # Leaves are numbered along the tree, so runs of them lie close together.
            for start in range(0, len(ids), BUNDLE):
                part_ids, part = ids[start:start + BUNDLE], corner[start:start + BUNDLE]
                hull = np.stack([part[:, 0].min(axis=0), part[:, 1].max(axis=0)])[None]
                hit = rows[_gap(x[rows], hull)[:, 0] <= reach[rows]]
                for i in range(0, len(hit), 1024):
                    some = hit[i:i + 1024]
                    near = (_gap(x[some], part) <= reach[some][:, None]) & (part_ids[None, :] != own[some][:, None])
                    for row, box in zip(*np.nonzero(near)):
                        out[some[row]].append(int(part_ids[box]))
        return pd.Series(out)

    return visit


def _slack(d2: np.ndarray, x: np.ndarray, size: float) -> np.ndarray:
    """A little more than ``d2``: rounding of bounds must never hide what the ball touches."""
    most = np.maximum(np.abs(x).max(axis=1), size) if x.size else np.zeros(len(d2))
    return (np.sqrt(d2) * (1 + 1e-9) + ROUNDING * most) ** 2


def _gap(x: np.ndarray, corner: np.ndarray) -> np.ndarray:
    """Squared distance of every row to every box (0 inside)."""
    gap = np.zeros((len(x), len(corner)))
    for d in range(x.shape[1]):
        c = x[:, d][:, None]
        gap += np.maximum(np.maximum(corner[None, :, 0, d] - c, c - corner[None, :, 1, d]), 0.0) ** 2
    return gap


def _block_join(qs: DataFrame, p: DataFrame, boxes: dict, k: int, exclude_self: bool, dims: int) -> DataFrame:
    """The k nearest points among those of the same leaf, worked off block by block."""
    spark = p.sparkSession
    id_type = p.schema["id"].dataType.simpleString()
    n_q = {r["leaf"]: r["count"] for r in qs.groupBy("leaf").count().collect()}
    most = BLOCK * _wide(dims)
    rows = [(leaf, -(-n // most), -(-boxes[leaf][0] // most)) for leaf, n in n_q.items() if leaf in boxes]
    parts = F.broadcast(spark.createDataFrame(rows, "leaf int, q_blocks int, p_blocks int"))  # at most MAX_LEAVES rows
    many = max([b for _, _, b in rows], default=1) > 1

    def block(n):
        return F.pmod(F.xxhash64("id"), F.col(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    left = qs.join(parts, "leaf").withColumn("qb", block("q_blocks")).withColumn("pb", every("p_blocks")).select("leaf", "qb", "pb", "id", "v", "d2")
    right = p.join(parts, "leaf").withColumn("pb", block("p_blocks")).withColumn("qb", every("q_blocks")).select("leaf", "qb", "pb", "id", "v", "c")
    keys = ["leaf", "qb", "pb"]

    def nearest(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"qid": [], "neighbor": [], "d2": [], "c": []})
        b = b.sort_values("id")
        qid, pid, carried = a["id"].to_numpy(), b["id"].to_numpy(), b["c"].to_numpy()
        rows, places, d2 = _nearest(qid, _matrix(a["v"]), a["d2"].to_numpy(), pid, _matrix(b["v"]), k, exclude_self)
        return pd.DataFrame({"qid": qid[rows], "neighbor": pid[places], "d2": d2, "c": carried[places]})

    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        nearest, f"qid {id_type}, neighbor {id_type}, d2 double, c array<double>")
    return _top_k(found, k) if many else found


def _nearest(qid, x, far, pid, y, k, exclude_self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of x, row of y, squared distance) of the ``k`` nearest at most ``far`` away; ``pid`` ascends, so rows of y break ties."""
    take_q, take_p, take_d = [], [], []
    kk = min(k, len(pid))
    shared = pd.Series(qid).isin(pid).to_numpy() if exclude_self else np.zeros(len(qid), bool)
    centred = _Centred(y) if y.shape[1] > AXES else None
    for start in range(0, len(qid), 256):
        part = slice(start, min(start + 256, len(qid)))
        own = qid[part][:, None] == pid[None, :] if shared[part].any() else None
        r, c = centred.open_pairs(x[part], far[part], kk, own) if centred else (None, None)
        if r is None or 4 * len(r) > len(far[part]) * len(y):  # most pairs are left: whole columns are faster
            dist = _distances(x[part], y)
            if own is not None:
                dist[own] = np.inf
            limit = np.minimum(np.partition(dist, kk - 1, axis=1)[:, kk - 1], far[part])
            r, c = np.nonzero((dist <= limit[:, None]) & np.isfinite(dist))
            d2 = dist[r, c]
        else:
            gap = x[start + r] - y[c]
            gap *= gap
            d2 = np.zeros(len(r))
            for d in range(x.shape[1]):
                d2 += gap[:, d]
            near = (d2 <= far[start + r]) & np.isfinite(d2)
            r, c, d2 = r[near], c[near], d2[near]
        order = np.lexsort((c, d2, r))
        r, c, d2 = r[order], c[order], d2[order]
        keep = np.arange(len(r)) - np.searchsorted(r, r) < k
        take_q.append(start + r[keep])
        take_p.append(c[keep])
        take_d.append(d2[keep])
    return np.concatenate(take_q), np.concatenate(take_p), np.concatenate(take_d)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    dist = np.zeros((len(x), len(y)))
    for d in range(x.shape[1]):
        dist += (x[:, d][:, None] - y[:, d][None, :]) ** 2
    return dist


class _Centred:
    """Points less their mean, ready for distances by a matrix product."""

    def __init__(self, y: np.ndarray) -> None:
        self.mean = y.mean(axis=0)
        self.y = y - self.mean
        self.squares = (self.y * self.y).sum(axis=1)
        self.length = np.sqrt(self.squares.max())

    def open_pairs(self, x: np.ndarray, far: np.ndarray, kk: int, own: np.ndarray | None) -> tuple:
        """Pairs that may be among the ``kk`` nearest points of a row of x and at most ``far`` away; (None, None) where numbers overflow.

        The product's distances are off by less than ``slack``, a generous bound of its rounding, that of centring and that of exact distances.
        """
        x = x - self.mean
        squares = (x * x).sum(axis=1)
        slack = 4 * (x.shape[1] + 16) * np.finfo(float).eps * (np.sqrt(squares) + self.length) ** 2
        low = x @ self.y.T
        low *= -2
        low += squares[:, None]
        low += self.squares
        if not np.isfinite(slack).all() or not np.isfinite(low.sum()):
            return None, None
        if own is not None:
            low[own] = np.inf
        limit = far + slack
        near = low <= limit[:, None]
        if np.count_nonzero(near) > 4 * kk * len(x):  # the kk nearest give a closer limit
            least = low.min(axis=1) if kk == 1 else np.partition(low, kk - 1, axis=1)[:, kk - 1]
            near = low <= np.minimum(limit, least + 2 * slack)[:, None]
        r, c = np.nonzero(near)
        there = np.isfinite(low[r, c])
        return r[there], c[there]


def _candidates(x, wx, far, y, wy, kk, own) -> tuple:
    """The open pairs of x and y, whose images are wx and wy; (None, None) where vectors are their own images."""
    return (None, None) if wx.shape[1] >= x.shape[1] else _Centred(y).open_pairs(x, far, kk, own)


def knn_regress(train: DataFrame, test: DataFrame, cols: list[str], label: str, k: int = 5, row_id: str = "row_id") -> DataFrame:
    """``test`` with ``prediction``: the mean label of the ``k`` nearest training rows, null where a coordinate is missing."""
    y = F.col(label).cast("double")
    # The second number tells a missing label from NaN.
    near = knn_join(test, train, cols, k, row_id, carry=F.array(F.coalesce(y, F.lit(0.0)), y.isNotNull().cast("double")))
    means = near.groupBy(row_id).agg(F.avg(F.when(F.col("carry")[1] == 1, F.col("carry")[0])).alias("prediction"))
    return test.join(means, row_id, "left")
