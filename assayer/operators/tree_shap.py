"""Shapley values of tree models, exact for the trees' own expectation.

The value of a set of known columns is the prediction averaged over the rows of a background table that reach each node: an unknown
column sends a row down both sides, by the shares of background rows there (the trees' covers, counted in one distributed pass).
A leaf then is a product over the columns on its path, and a column's Shapley value a weighted sum of the coefficients of the
other columns' product. It depends on which of these columns let the row through, so it is worked out once for every such state of a
few neighbouring leaves, and a row looks its values up. The tables travel to the tasks; the rows never leave them.

Values and the base value (the mean over the background) add up to the prediction for every row. Works for forest regressors and
for boosted models (of a boosted classifier: one output's margin). A missing value goes to the side that the model sends it to.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import q
from .boosting import BoostModel


STATES = 512  # states of a group of leaves at most
CELLS = 4_000_000  # numbers in the tables of all groups, which are sent to every task


@dataclass
class FlatTree:
    """Nodes as arrays; ``column`` is -1 at leaves. Values up to ``threshold`` go left."""

    column: np.ndarray
    threshold: np.ndarray
    missing_left: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    cover: np.ndarray | None = None

    def sides(self, node: int, edges: np.ndarray) -> np.ndarray:
        """Whether the values of each bin go left at a node; the last bin is the missing values'."""
        return np.append(np.arange(len(edges) + 1) <= np.searchsorted(edges, self.threshold[node]), self.missing_left[node])

    def open_bins(self, edges: list[np.ndarray]) -> dict[int, dict[int, np.ndarray]]:
        """For each leaf and each column on its path, the bins whose values may come there."""
        found: dict[int, dict] = {0: {}}
        for node, c in enumerate(self.column):  # children have larger numbers
            if c >= 0:
                path, left = found.pop(node), self.sides(node, edges[c])
                for child, goes in ((self.left[node], left), (self.right[node], ~left)):
                    found[int(child)] = path | {int(c): path[c] & goes if c in path else goes}
        return found

    def counter(self, edges: list[np.ndarray]) -> Callable[[np.ndarray], np.ndarray]:
        """A function of the binned columns that gives the number of rows at each leaf, and 0 at inner nodes.

        A word has a bit for each of 64 leaves; a bin's word tells which of them it leaves open, and all columns leave one leaf open.
        """
        opened = self.open_bins(edges)
        leaves, used = sorted(opened), sorted({int(c) for c in self.column if c >= 0})
        blocks = [leaves[i : i + 64] for i in range(0, len(leaves), 64)]
        words = [[(c, reduce(np.bitwise_or, [np.where(opened[leaf].get(c, True), np.uint64(1 << i), np.uint64(0)) * np.ones(len(edges[c]) + 2, np.uint64)
                                            for i, leaf in enumerate(block)])) for c in used] for block in blocks]

        def count(bins: np.ndarray) -> np.ndarray:
            total = np.zeros(len(self.column), np.int64)
            if not used:
                total[0] = bins.shape[1]
                return total
            for block, tables in zip(blocks, words, strict=True):
                here = reduce(np.bitwise_and, [table[bins[c]] for c, table in tables])
                if len(blocks) > 1:
                    here = here[here > 0]
                total[block] += np.bincount(np.bitwise_count(here - np.uint64(1)), minlength=len(block))
            return total

        return count

    def set_cover(self, at_leaves: np.ndarray) -> None:
        """Note the rows of all nodes, given those of the leaves."""
        self.cover = at_leaves
        for node in range(len(self.column) - 1, -1, -1):
            if self.column[node] >= 0:
                self.cover[node] = self.cover[self.left[node]] + self.cover[self.right[node]]

    def leaves(self) -> Iterator[tuple[int, list[tuple[int, bool]]]]:
        """Each leaf with the nodes on its path and the side taken there."""
        open_nodes: list[tuple[int, list]] = [(0, [])]
        while open_nodes:
            node, path = open_nodes.pop()
            if self.column[node] < 0:
                yield node, path
            else:
                open_nodes += [(int(self.left[node]), [*path, (node, True)]), (int(self.right[node]), [*path, (node, False)])]

    def shares(self, path: list[tuple[int, bool]]) -> dict[int, float]:
        """Per column on a path, the share of background rows that its splits let through."""
        share: dict[int, float] = {}
        for node, side in path:
            c, child = int(self.column[node]), self.left[node] if side else self.right[node]
            share[c] = share.get(c, 1.0) * (self.cover[child] / self.cover[node] if self.cover[node] else 0.0)
        return share


def leaf_values(value: float, share: dict[int, float], taken: dict[int, np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """Each column's part in one leaf; ``taken`` says per column which rows it lets through."""
    columns, d = list(share), len(share)
    weight = np.array([math.factorial(s) * math.factorial(d - 1 - s) / math.factorial(d) for s in range(d)])
    for c in columns:
        product = np.zeros((d, len(taken[c])))  # coefficients by how many of the other columns are known
        product[0] = 1.0
        for k, other in enumerate(o for o in columns if o != c):
            for size in range(k + 1, 0, -1):
                product[size] = product[size] * share[other] + product[size - 1] * taken[other]
            product[0] = product[0] * share[other]
        yield c, value * (taken[c] - share[c]) * (weight @ product)


@dataclass
class Group:
    """Some leaves of one tree whose values depend on few states of a row, worked out for every state beforehand.

    ``steps`` gives each column's share in the state's number, by bin; ``table`` the values, a row a column.
    """

    steps: list[tuple[int, np.ndarray]]
    table: dict[int, np.ndarray]

    def add(self, bins: np.ndarray, out: np.ndarray) -> None:
        state = reduce(np.add, [step[bins[c]] for c, step in self.steps])
        for c, values in self.table.items():
            out[c] += values[state]


@dataclass
class Single:
    """A leaf with too many states, worked out row by row."""

    value: float
    share: dict[int, float]
    opened: dict[int, np.ndarray]

    def add(self, bins: np.ndarray, out: np.ndarray) -> None:
        for c, values in leaf_values(self.value, self.share, {c: o[bins[c]] for c, o in self.opened.items()}):
            out[c] += values


def parts_of(tree: FlatTree, edges: list[np.ndarray], room: int) -> tuple[list[Group | Single], float, int]:
    """The tree's leaves in groups of neighbours, its base value, and the cells of its tables, at most ``room``."""
    opened, paths = tree.open_bins(edges), dict(tree.leaves())
    share = {leaf: tree.shares(path) for leaf, path in paths.items()}
    base = float(sum(tree.value[leaf] * math.prod(s.values()) for leaf, s in share.items()))
    below: dict[int, list[int]] = {leaf: [leaf] for leaf in opened}
    for node in range(len(tree.column) - 1, -1, -1):
        if tree.column[node] >= 0:
            below[node] = below[int(tree.left[node])] + below[int(tree.right[node])]
    parts: list[Group | Single] = []
    used, open_nodes = 0, [0] if tree.column[0] >= 0 else []
    while open_nodes:
        node = open_nodes.pop()
        leaves = below[node]
        columns = sorted({c for leaf in leaves for c in opened[leaf]})
        # Bins that the same leaves let through are one state of a column.
        seen = {c: np.unique(np.stack([opened[leaf][c] for leaf in leaves if c in opened[leaf]]), axis=1, return_inverse=True) for c in columns}
        states = math.prod(kinds.shape[1] for kinds, _ in seen.values())
        if states > STATES or states * len(columns) > room - used:
            if len(leaves) > 1:
                open_nodes += [int(tree.right[node]), int(tree.left[node])]
            else:
                parts.append(Single(float(tree.value[node]), share[node], opened[node]))
            continue
        used += states * len(columns)
        grid, stride, steps = np.arange(states), 1, []
        taken: dict[int, dict[int, np.ndarray]] = {leaf: {} for leaf in leaves}
        for c, (kinds, kind_of) in seen.items():
            steps.append((c, kind_of.reshape(-1) * stride))
            at = grid // stride % kinds.shape[1]
            for i, leaf in enumerate(leaf for leaf in leaves if c in opened[leaf]):
                taken[leaf][c] = kinds[i][at]
            stride *= kinds.shape[1]
        table = {c: np.zeros(states) for c in columns}
        for leaf in leaves:
            for c, values in leaf_values(float(tree.value[leaf]), share[leaf], taken[leaf]):
                table[c] += values
        parts.append(Group(steps, table))
    return parts, base, used


def edges_of(trees: list[FlatTree], width: int) -> list[np.ndarray]:
    """The thresholds of each column in all trees."""
    return [np.unique([t for tree in trees for t in tree.threshold[tree.column == c]]) for c in range(width)]


def bins_of(columns: list[np.ndarray], edges: list[np.ndarray]) -> np.ndarray:
    """Per column and row the number of edges below the value; missing values have the last bin."""
    return np.stack([np.where(np.isnan(x), len(cuts) + 1, np.searchsorted(cuts, x, "left")) for x, cuts in zip(columns, edges, strict=True)])


def _nested(lines: list[str]) -> FlatTree:
    """A tree from its printed form, an indented line a node."""
    at, rows = 0, []

    def read() -> int:
        nonlocal at
        node, line = len(rows), lines[at].strip()
        rows.append(None)
        at += 1
        if line.startswith("Predict:"):
            rows[node] = (-1, 0.0, False, 0, 0, float(line.split(":")[1]))
            return node
        found = re.match(r"If \(feature (\d+) <= (\S+)\)", line)
        if not found:
            raise ValueError(f"a split that is no threshold: {line}")
        left = read()
        at += 1  # the line of the other side
        right = read()
        rows[node] = (int(found[1]), float(found[2]), False, left, right, 0.0)
        return node

    read()
    return FlatTree(*(np.array(x) for x in zip(*rows, strict=True)))


def flat_trees(model, output: int = 0) -> tuple[list[FlatTree], float]:
    """The trees of a forest regressor or boosted model, with leaf values as they enter the sum, and the constant beside them."""
    if isinstance(model, PipelineModel):
        model = model.stages[-1]
    if isinstance(model, BoostModel):
        state, trees = model.content(), []
        for round_ in model.trees:
            t = round_[output]
            cut = [math.inf if c < 0 or b >= len(state["edges"][c]) else state["edges"][c][b] for c, b in zip(t.column, t.cut, strict=True)]
            trees.append(FlatTree(np.array(t.column), np.array(cut), np.array(t.missing_left), np.array(t.left), np.array(t.right),
                                  np.where(np.array(t.column) < 0, t.value, 0.0)))
        return trees, float(state["base"][output])
    parts = re.split(r"\n\s*Tree \d+ \(weight ([^)]*)\):\n", model.toDebugString)[1:]
    weights, texts = [float(w) for w in parts[::2]], parts[1::2]
    trees = [_nested([line for line in text.split("\n") if line.strip()]) for text in texts]
    for tree, weight in zip(trees, weights, strict=True):
        tree.value = tree.value * weight / sum(weights)
    return trees, 0.0


def covered(trees: list[FlatTree], background: DataFrame, cols: list[str]) -> list[FlatTree]:
    """The trees with the number of background rows at each node."""
    first, edges = np.cumsum([0, *(len(t.column) for t in trees)]), edges_of(trees, len(cols))
    counters = [t.counter(edges) for t in trees]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(first[-1], np.int64)
        for batch in batches:
            bins = bins_of([batch.column(j).to_numpy(zero_copy_only=False).astype(float) for j in range(len(cols))], edges)
            total += np.concatenate([c(bins) for c in counters])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total))), pa.array(total)], names=["node", "n"])

    if trees:
        rows = background.select(*[q(c).cast("double").alias(f"x{i}") for i, c in enumerate(cols)])
        total = np.zeros(first[-1])
        for r in rows.mapInArrow(count, "node long, n long").groupBy("node").agg(F.sum("n").alias("n")).collect():  # a row a node
            total[r["node"]] = r["n"]
        for t, a, b in zip(trees, first[:-1], first[1:], strict=True):
            t.set_cover(total[a:b])
    return trees


def tree_shap(model, df: DataFrame, cols: list[str], background: DataFrame | None = None, output: int = 0) -> DataFrame:
    """``df`` with ``shap_<column>`` for every column and ``shap_base``; ``background`` defaults to ``df``."""
    trees, base = flat_trees(model, output)
    trees, width = covered(trees, df if background is None else background, cols), len(cols)
    edges, parts, room = edges_of(trees, width), [], CELLS
    for tree in trees:
        some, value, cells = parts_of(tree, edges, room)
        parts, base, room = parts + some, base + value, room - cells

    @F.pandas_udf("array<double>")
    def values(rows: pd.Series) -> pd.Series:
        if not len(rows):
            return pd.Series([], dtype=object)
        bins, out = bins_of(list(np.stack(rows.to_numpy()).astype(float).T), edges), np.zeros((width + 1, len(rows)))
        for part in parts:
            part.add(bins, out)
        out[-1] = base
        return pd.Series(list(out.T))

    scored = df.withColumn("__shap", values(F.array(*[F.coalesce(q(c).cast("double"), F.lit(math.nan)) for c in cols])))
    names = [*(f"shap_{c}" for c in cols), "shap_base"]
    return scored.withColumns({n: F.col("__shap")[i] for i, n in enumerate(names)}).drop("__shap")


def shap_summary(shapped: DataFrame, cols: list[str]) -> DataFrame:
    """``feature, mean_abs_shap, mean_shap``."""
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.avg(F.abs(f"shap_{c}")).alias("mean_abs_shap"), F.avg(f"shap_{c}").alias("mean_shap")) for c in cols])
    return shapped.agg(rows.alias("__rows")).select(F.inline("__rows"))
