"""Gradient boosting over histograms of binned columns, for squared error and for the softmax of any number of classes.

Columns are cut at quantiles into at most 254 bins; a missing value has a bin of its own, and each split learns which side missing
values go to. The binned rows are stored once, as blocks of one byte a cell. A tree level is one pass: tasks work out gradients
and hessians of their blocks from the rows' margins, add them up per (class, node, column, bin), Spark sums the parts, and the
driver, which sees these sums only, takes the best split of every node. All classes' trees of a round grow in the same passes.
Margins are stored with the rows every ``KEEP`` rounds; between, a pass applies the few trees since.

Gradients are rounded to fixed-point numbers before they are summed, so the sums, and with them the trees, do not depend on how
rows are dealt to tasks. Without row sampling a round that would raise the training loss is halved until it does not.

Rows with a null label or a null or zero weight take no part. Without rows, or with one class, the model is its base value.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.stats import collect_aggs
from ..session import cut_lineage

MISSING, ROWS, KEEP, LOSS_SCALE = 255, 16_384, 10, 2.0**20
#: Cells that a task of a pass works on: at least, while cores are idle, and about, once all have work.
CELLS, FULL_CELLS = 1 << 20, 1 << 23
#: Leaves that fit the bits of a byte.
BITS = 8


@dataclass
class Tree:
    """Nodes as lists; ``column`` is -1 at leaves. A bin up to ``cut`` goes left."""

    column: list[int] = field(default_factory=lambda: [-1])
    cut: list[int] = field(default_factory=lambda: [0])
    missing_left: list[bool] = field(default_factory=lambda: [False])
    left: list[int] = field(default_factory=lambda: [0])
    right: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    depth: int = 0

    def split(self, node: int, column: int, cut: int, missing_left: bool, left: float, right: float) -> tuple[int, int]:
        self.column[node], self.cut[node], self.missing_left[node] = column, cut, missing_left
        self.left[node], self.right[node] = len(self.column), len(self.column) + 1
        for value in (left, right):
            for part, start in ((self.column, -1), (self.cut, 0), (self.missing_left, False), (self.left, 0), (self.right, 0), (self.value, value)):
                part.append(start)
        return self.left[node], self.right[node]

    def lookup(self) -> Callable[[np.ndarray, list], np.ndarray]:
        """A function of binned columns and a value per node that gives each row the value of the node it has come to.

        Up to ``BITS`` leaves, a table of 256 bytes per column tells which leaves a bin leaves open, a bit a leaf; what all columns
        leave open is one leaf. Tables are made once, so a task should ask once per tree.
        """
        if self.column.count(-1) > BITS:
            return lambda bins, values: np.array(values)[self.walk(bins)]
        open_bins, leaves, node_of = {0: {}}, [], np.zeros(256, np.int64)
        for node, column in enumerate(self.column):  # children come after their parent
            if column < 0:
                node_of[1 << len(leaves)] = node
                leaves.append(open_bins[node])
                continue
            goes_left = np.arange(256) <= self.cut[node]
            goes_left[MISSING] = self.missing_left[node]
            for child, goes in ((self.left[node], goes_left), (self.right[node], ~goes_left)):
                open_bins[child] = open_bins[node] | {column: open_bins[node].get(column, True) & goes}
        tables = [
            (column, sum(np.where(leaf.get(column, True), np.uint8(1 << i), np.uint8(0)) for i, leaf in enumerate(leaves)).astype(np.uint8).tobytes())
            for column in sorted({c for c in self.column if c >= 0})]

        def find(bins: np.ndarray, values: list) -> np.ndarray:
            if not tables:
                return np.full(bins.shape[1], values[0])
            parts = (np.frombuffer(bins[column].tobytes().translate(table), np.uint8) for column, table in tables)
            return np.take(np.array(values)[node_of], reduce(np.bitwise_and, parts))

        return find

    def walk(self, bins: np.ndarray) -> np.ndarray:
        """The node that each row (a column of ``bins``) has come to."""
        column, cut, side = np.array(self.column), np.array(self.cut), np.array(self.missing_left)
        left, right, row = np.array(self.left), np.array(self.right), np.arange(bins.shape[1])
        at = np.zeros(bins.shape[1], np.int64)
        for _ in range(self.depth):
            value = bins[np.maximum(column[at], 0), row]
            to = np.where(np.where(value == MISSING, side[at], value <= cut[at]), left[at], right[at])
            at = np.where(column[at] >= 0, to, at)
        return at


def lookups(rounds: list[list[Tree]]) -> list[list[tuple[Callable, list]]]:
    """What ``raised`` needs of each tree."""
    return [[(t.lookup(), t.value) for t in trees] for trees in rounds]


def raised(margins: np.ndarray, bins: np.ndarray, ready: list[list[tuple[Callable, list]]]) -> np.ndarray:
    """The margins after some more rounds."""
    for trees in ready:
        margins = margins + np.stack([find(bins, value) for find, value in trees])
    return margins


def bins_of(values: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """One byte a cell, columns first: the number of edges below the value, or ``MISSING``."""
    out = np.empty((len(edges), len(values)), np.uint8)
    for j, cuts in enumerate(edges):
        out[j] = np.where(np.isnan(values[:, j]), MISSING, np.searchsorted(cuts, values[:, j], "left"))
    return out


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(lists), width)


def powers(margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Largest margin of each row, exp of the margins less it, and the sum of these; margins have a row a class."""
    top = margins.max(axis=0)
    e = np.exp(margins - top)
    return top, e, e.sum(axis=0)


def losses(margins: np.ndarray, label: np.ndarray, classes: int, of: tuple | None = None) -> np.ndarray:
    if not classes:
        return (label - margins[0]) ** 2
    top, _, total = of or powers(margins)
    return top + np.log(total) - margins[label.astype(int), np.arange(len(label))]


def gradients(margins: np.ndarray, label: np.ndarray, classes: int, of: tuple | None = None) -> tuple[np.ndarray, np.ndarray]:
    if not classes:
        return margins - label, np.ones_like(margins)
    _, e, total = of or powers(margins)
    p = e / total
    h = p * (1 - p)
    p[label.astype(int), np.arange(len(label))] -= 1
    return p, h


@dataclass
class Block:
    """Some rows: binned cells, labels, weights, a hash each, and the margins that are stored."""

    bins: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    hash: np.ndarray
    margins: np.ndarray

    FIELDS = "bins binary, label binary, weight binary, hash binary, margins binary"

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([getattr(self, k).tobytes()], pa.binary()) for k in ("bins", "label", "weight", "hash", "margins")],
                                          names=["bins", "label", "weight", "hash", "margins"])

    @staticmethod
    def read(batches: Iterator[pa.RecordBatch], width: int, outputs: int) -> Iterator[Block]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = [batch.column(j)[i].as_buffer() for j in range(5)]
                yield Block(np.frombuffer(raw[0], np.uint8).reshape(width, -1), np.frombuffer(raw[1]), np.frombuffer(raw[2]),
                            np.frombuffer(raw[3], np.uint64), np.frombuffer(raw[4]).reshape(outputs, -1))

    def drawn(self, number: int, share: float, seed: int) -> np.ndarray:
        """True for the rows of a round's sample."""
        if share >= 1:
            return np.ones(len(self.label), bool)
        x = self.hash + np.uint64((number * 0x9E3779B97F4A7C15 + seed * 0xC2B2AE3D27D4EB4F) % 2**64)
        for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
            x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
        return (x >> np.uint64(11)).astype(float) * 2.0**-53 < share


def occurrence(hashes: np.ndarray) -> np.ndarray:
    """How many equal hashes stand before each."""
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    first = np.searchsorted(ordered, ordered)
    out = np.empty(len(hashes), np.uint64)
    out[order] = (np.arange(len(hashes)) - first).astype(np.uint64)
    return out


SUMS = "output int, loss long, slot binary, sums binary"


def packed_sums(parts: list[tuple[int, int, np.ndarray]]) -> pa.RecordBatch:
    """A row an output: its share of the loss, and the places and (gradient, hessian, rows) of the bins that hold rows."""
    used = [np.flatnonzero(sums[2]) for _, _, sums in parts]
    return pa.RecordBatch.from_arrays(
        [pa.array([k for k, _, _ in parts], pa.int32()), pa.array([loss for _, loss, _ in parts], pa.int64()),
         pa.array([at.tobytes() for at in used], pa.binary()), pa.array([sums[:, at].tobytes() for (_, _, sums), at in zip(parts, used, strict=True)], pa.binary())],
        names=["output", "loss", "slot", "sums"])


def unpacked_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    for batch in batches:
        for row in batch.to_pylist():
            yield row["output"], row["loss"], np.frombuffer(row["slot"], np.int64), np.frombuffer(row["sums"], np.int64).reshape(3, -1)


@dataclass
class Settings:
    rounds: int = 100
    rate: float = 0.1
    depth: int = 3
    leaf_rows: int = 1
    split_rows: int = 2
    leaf_weight: float = 0.0
    l2: float = 0.0
    gain: float = 0.0
    rows: float = 1.0
    columns: float = 1.0
    bins: int = 128
    seed: int = 42


class Booster:
    """The driver's side of a fit."""

    def __init__(self, rows: DataFrame, classes: int, settings: Settings) -> None:
        """``rows``: features array<double>, label double, weight double; ``classes`` is 0 for a regression."""
        self.settings, self.classes, self.outputs = settings, classes, max(1, classes)
        self.rounds: list[list[Tree]] = []
        self.losses: list[float] = []
        clean = rows.filter("label is not null and weight > 0")
        stats = clean.agg(
            F.count(F.lit(1)).alias("n"), F.max(F.size("features")).alias("width"), F.sum("weight").alias("weight"), F.max("weight").alias("most"),
            F.sum(F.col("label") * F.col("weight")).alias("total"), F.min("label").alias("low"), F.max("label").alias("high")).first()
        self.n, self.width = stats["n"], stats["width"] or 0
        self.total_weight = float(stats["weight"] or 0)
        self.importance = np.zeros(self.width)
        if not self.n:
            self.base, self.edges = [0.0] * self.outputs, []
            return
        if classes:
            mass = {int(r["label"]): r["w"] for r in clean.groupBy("label").agg(F.sum("weight").alias("w")).collect()}  # a row a class
            self.base = [math.log(max(mass.get(k, 0.0), 1e-12) / self.total_weight) for k in range(classes)]
        else:
            self.base = [float(stats["total"]) / self.total_weight]
        self.edges = self.cuts(clean)
        largest = max(1.0, 0.0 if classes else float(stats["high"] - stats["low"])) * float(stats["most"])
        bits = min(36, 61 - max(1, self.n).bit_length())  # sums of n numbers stay below 2^62
        self.scale = 2.0 ** (bits - math.ceil(math.log2(largest)))
        self.store(clean)

    def cuts(self, rows: DataFrame) -> list[np.ndarray]:
        """Bin edges of each column at its quantiles."""
        share = [i / self.settings.bins for i in range(1, self.settings.bins)]
        value = lambda j: F.element_at("features", j + 1)
        found = collect_aggs(rows, {f"{j}": F.percentile_approx(F.when(~F.isnan(value(j)), value(j)), share, 10_000) for j in range(self.width)}, 40)
        return [np.unique(np.array(found[f"{j}"] or [], float)) for j in range(self.width)]

    def store(self, rows: DataFrame) -> None:
        edges, base, width = self.edges, np.array(self.base), self.width

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    part = batch.slice(at, ROWS)
                    values = [part.column(part.schema.get_field_index(c)) for c in ("features", "label", "weight", "hash")]
                    hashes = values[3].to_numpy(zero_copy_only=False).view(np.uint64)
                    margins = np.repeat(base[:, None], part.num_rows, axis=1)
                    yield Block(bins_of(matrix(values[0], width), edges), values[1].to_numpy(zero_copy_only=False), values[2].to_numpy(zero_copy_only=False),
                                hashes + occurrence(hashes), margins).batch()

        packed = rows.select("features", "label", "weight", F.xxhash64("features", "label").alias("hash")).mapInArrow(pack, Block.FIELDS)
        cells, cores = self.n * self.width * self.outputs, rows.sparkSession.sparkContext.defaultParallelism
        self.parts = max(1, cells // FULL_CELLS, min(cells // CELLS, cores))
        # A checkpoint keeps its partitions; reading files would pack them by size, which leaves cores without work.
        self.blocks, self.applied = cut_lineage(packed.repartition(self.parts)), 0

    def keep_margins(self) -> None:
        pending, width, outputs = self.rounds[self.applied :], self.width, self.outputs

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ready = lookups(pending)
            for block in Block.read(batches, width, outputs):
                block.margins = raised(block.margins, block.bins, ready)
                yield block.batch()

        self.blocks, self.applied = cut_lineage(self.blocks.mapInArrow(add, Block.FIELDS)), len(self.rounds)

    def sums(self, growing: list[Tree], nodes: list[list[int]], columns: np.ndarray) -> tuple[dict[int, np.ndarray], float]:
        """Sums (gradient, hessian, rows) of class k's open nodes as array (node, column, bin, 3), and, as long as all trees are roots, the loss before this round."""
        pending, classes, width, outputs, scale = self.rounds[self.applied :], self.classes, self.width, self.outputs, self.scale
        number, share, seed, bins = len(self.rounds), self.settings.rows, self.settings.seed, MISSING + 1
        sizes = [len(open_nodes) * len(columns) * bins for open_nodes in nodes]
        begin = np.cumsum([0, *sizes])

        def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, loss = np.zeros((3, begin[-1]), np.int64), 0
            parts = [total[:, a:b].reshape(3, -1, len(columns), bins) for a, b in zip(begin[:-1], begin[1:], strict=True)]
            ready, finds = lookups(pending), [t.lookup() for t in growing]
            places = [np.full(len(t.column), -1) for t in growing]
            for place, open_nodes in zip(places, nodes, strict=True):
                place[open_nodes] = np.arange(len(open_nodes)) * bins
            for block in Block.read(batches, width, outputs):
                margins = raised(block.margins, block.bins, ready)
                shared = powers(margins) if classes else None
                if not any(t.depth for t in growing):
                    loss += int(np.rint(losses(margins, block.label, classes, shared) * block.weight * LOSS_SCALE).sum())
                if not any(nodes):
                    continue
                gradient, hessian = gradients(margins, block.label, classes, shared)
                drawn = block.drawn(number, share, seed)
                cells = block.bins[columns].astype(np.int64)
                for k, open_nodes in enumerate(nodes):
                    if not open_nodes:
                        continue
                    first = finds[k](block.bins, places[k])
                    rows = drawn & (first >= 0)
                    mine, g, h = cells, gradient[k] * block.weight, hessian[k] * block.weight
                    if not rows.all():
                        rows = np.flatnonzero(rows)
                        mine, first, g, h = mine[:, rows], first[rows], g[rows], h[rows]
                    g, h = np.rint(g * scale), np.rint(h * scale)
                    for j in range(len(columns)):
                        slot = mine[j] + first
                        for out, weights in zip(parts[k][:, :, j], (g, h, None), strict=True):  # whole numbers: doubles add them exactly
                            out += np.bincount(slot, weights, len(open_nodes) * bins).astype(np.int64).reshape(-1, bins)
            yield packed_sums([(k, loss if k == 0 else 0, part.reshape(3, -1)) for k, part in enumerate(parts)])

        def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found: dict[int, list] = {}
            for k, loss, slot, values in unpacked_sums(batches):
                entry = found.setdefault(k, [0, np.zeros((3, sizes[k]), np.int64)])
                entry[0] += loss
                entry[1][:, slot] += values
            if found:
                yield packed_sums([(k, loss, part) for k, (loss, part) in found.items()])

        sums = self.blocks.mapInArrow(add_up, SUMS)
        if self.parts > 1:  # an output's sums, whose size does not depend on the rows, are merged in one task
            sums = sums.repartition(self.outputs, "output").mapInArrow(merge, SUMS)
        found, loss = {k: np.zeros((size, 3)) for k, size in enumerate(sizes) if size}, 0
        for k, part_loss, slot, values in unpacked_sums(sums.toArrow().to_batches()):
            loss += part_loss
            if len(slot):
                found[k][slot] = values.T / [scale, scale, 1]
        return {k: whole.reshape(-1, len(columns), bins, 3) for k, whole in found.items()}, loss / LOSS_SCALE

    def grow(self) -> bool:
        """One round; false if no tree could be split."""
        s = self.settings
        rng = np.random.default_rng((s.seed, len(self.rounds)))
        columns = np.sort(rng.permutation(self.width)[: max(1, round(s.columns * self.width))])
        growing, nodes = [Tree() for _ in range(self.outputs)], [[0] for _ in range(self.outputs)]
        for level in range(s.depth):
            sums, loss = self.sums(growing, nodes, columns)
            if level == 0:
                while self.settle(loss):
                    sums, loss = self.sums(growing, nodes, columns)
            for k in range(self.outputs):
                nodes[k] = self.split(growing[k], nodes[k], sums[k], columns) if nodes[k] else []
            if not any(nodes):
                break
        if not any(t.depth for t in growing):
            return False
        self.rounds.append(growing)
        if len(self.rounds) - self.applied >= KEEP + 1:  # the last round may still be halved
            last = self.rounds.pop()
            self.keep_margins()
            self.rounds.append(last)
        return True

    def settle(self, loss: float) -> bool:
        """Note the loss after the last round; true if that round was halved because it had risen."""
        before = self.losses[-1] if self.losses else math.inf
        if self.settings.rows < 1 or not self.rounds or loss <= before + 1e-9 * abs(before) + self.n / LOSS_SCALE:
            self.losses.append(loss)
            return False
        for tree in self.rounds[-1]:
            tree.value = [v / 2 if abs(v) > 1e-12 else 0.0 for v in tree.value]
        return True

    def split(self, tree: Tree, nodes: list[int], sums: np.ndarray, columns: np.ndarray) -> list[int]:
        """Split the open nodes of a tree where that gains; the new nodes."""
        s, grown = self.settings, []
        for node, hist in zip(nodes, sums, strict=True):  # (column, bin, 3)
            whole = hist[0].sum(axis=0)
            if whole[2] < max(2, s.split_rows):
                continue
            below = np.cumsum(hist[:, :MISSING], axis=1)
            lost = hist[:, MISSING][:, None]
            sides = np.stack([below, below + lost])  # missing values go right, or left
            other = whole - sides
            worth = lambda x: x[..., 0] ** 2 / np.maximum(x[..., 1] + s.l2, 1e-12)
            gain = worth(sides) + worth(other) - worth(whole)
            small = np.minimum(sides[..., 2], other[..., 2]) < max(1, s.leaf_rows)
            light = np.minimum(sides[..., 1], other[..., 1]) < max(s.leaf_weight, 1e-9)
            gain = np.where(small | light, -np.inf, gain)
            best = int(gain.argmax())
            if not gain.flat[best] > s.gain + 1e-9:
                continue
            side, j, cut = np.unravel_index(best, gain.shape)
            step = lambda x: float(-s.rate * x[0] / max(x[1] + s.l2, 1e-12))
            a, b = sides[side, j, cut], other[side, j, cut]
            grown += tree.split(node, int(columns[j]), int(cut), bool(side), step(a), step(b))
            self.importance[columns[j]] += gain.flat[best]
        tree.depth += bool(grown)
        return grown

    def run(self) -> None:
        if not self.n or not self.width or self.classes == 1:
            return
        while len(self.rounds) < self.settings.rounds and self.grow():
            pass
        while len(self.losses) <= len(self.rounds) and self.settle(self.sums([Tree()] * self.outputs, [[]] * self.outputs, np.arange(1))[1]):
            pass


class BoostModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``prediction``, and for classes ``probability``; ``losses`` are mean training losses before the first and after each round."""

    state = Param(Params._dummy(), "state", "edges, base values and trees as JSON", TypeConverters.toString)

    def __init__(self, state: str = "{}") -> None:
        super().__init__()
        self._set(state=state)

    def content(self) -> dict:
        return json.loads(self.getOrDefault("state"))

    @property
    def losses(self) -> list[float]:
        return self.content()["losses"]

    @property
    def trees(self) -> list[list[Tree]]:
        return [[Tree(**t) for t in trees] for trees in self.content()["rounds"]]

    @property
    def featureImportances(self):
        values = self.content()["importance"]
        total = sum(values)
        return Vectors.dense([v / total if total else 0.0 for v in values])

    def margins(self, features):
        """Column of margins, one per output, of a column of arrays."""
        state, rounds = self.content(), self.trees
        edges, base, width = [np.array(e) for e in state["edges"]], np.array(state["base"]), len(state["edges"])

        @F.pandas_udf("array<double>")
        def score(rows: pd.Series) -> pd.Series:
            out = np.repeat(base[:, None], len(rows), axis=1)
            if width and len(rows):
                bins = bins_of(np.stack(rows.to_numpy()).astype(float), edges)
                out = raised(out, bins, lookups(rounds))
            return pd.Series(list(out.T))

        return score(features)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        scored = dataset.withColumn("__margins", self.margins(vector_to_array("features")))
        if not self.content()["classes"]:
            return scored.withColumn("prediction", F.col("__margins")[0]).drop("__margins")
        power = F.transform("__margins", lambda m: F.exp(m - F.array_max("__margins")))
        total = F.aggregate("__powers", F.lit(0.0), lambda a, x: a + x)
        top = (F.array_position(F.col("__margins"), F.array_max("__margins")) - 1).cast("double")  # of equal ones the smaller class
        ready = scored.withColumn("__powers", power).withColumn("__total", total)
        return ready.withColumns({"probability": array_to_vector(F.transform("__powers", lambda x: x / F.col("__total"))), "prediction": top}).drop(
            "__margins", "__powers", "__total")


class Boost(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees on the columns ``features`` and ``label`` (classes 0, 1, ... or any number)."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    weightCol = Param(Params._dummy(), "weightCol", "weight column", TypeConverters.toString)
    classes = Param(Params._dummy(), "classes", "whether the label is a class", TypeConverters.toBoolean)
    settings = Param(Params._dummy(), "settings", "settings as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, labelCol: str = "label", weightCol: str = "", classes: bool = False, settings: str = "{}") -> None:
        super().__init__()
        self._set(**self._input_kwargs)
        self._setDefault(labelCol="label", weightCol="", classes=False, settings="{}")

    def _fit(self, dataset: DataFrame) -> BoostModel:
        label, weight = F.col(self.getOrDefault("labelCol")).cast("double"), self.getOrDefault("weightCol")
        rows = dataset.select(
            vector_to_array("features").alias("features"), label.alias("label"), (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"))
        classes = 0
        if self.getOrDefault("classes"):
            classes = int(rows.agg(F.max("label")).first()[0] or 0) + 1
        booster = Booster(rows, classes, Settings(**json.loads(self.getOrDefault("settings"))))
        booster.run()
        state = {
            "classes": classes, "edges": [e.tolist() for e in booster.edges], "base": booster.base, "importance": booster.importance.tolist(),
            "rounds": [[vars(t) for t in trees] for trees in booster.rounds], "losses": [x / booster.total_weight for x in booster.losses]}
        return BoostModel(json.dumps(state))
