"""Exact (linearly interpolated) quantiles, any number of them, whose state never outgrows one task.

The built-in ``percentile`` keeps a map of all distinct values of a group in one aggregation buffer. It serves groups of a bounded
number of rows, however many such groups there are. Each larger group (there are fewer than ``MOST_BIG``) is cut into cells at the
marks of a bounded sketch. One pass counts the cells, which tells the cell of every wanted order statistic and its place there;
a second pass sends on the values of those cells alone, equal ones merged with their count, and each cell is sorted in a task of
its own. A value that a third of all rows share is one value with a count. The result is the same number on both ways, for
any number of probabilities, groups and rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL_LIMIT = 4_000_000    # rows x columns of a group that the built-in aggregate may hold
GROUP_LIMIT = 10_000      # groups whose quantiles may come to the driver
MOST_BIG = 16_384         # groups beyond the built-in aggregate; each has more than 1 / MOST_BIG of the rows
CELLS = 65_536            # most sketch marks of a column, over all large groups
CELL_ROWS = 100_000       # rows that a cell is meant to hold
ACCURACY = 10_000         # sketch accuracy: rank error at most n / ACCURACY


def column_quantiles(
    df: DataFrame, cols: list[str], probs: list[float], by: str | None = None, exact: bool = True, cell_limit: int | None = None,
) -> dict:
    """``{group: {column: [quantile per prob]}}``; the only group is ``None`` without ``by``."""
    table = quantile_table(df, cols, probs, by, exact, cell_limit)
    rows = table.groupBy("group").agg(F.collect_list(F.struct("feature", "quantiles")).alias("found")).limit(GROUP_LIMIT + 1).collect()
    if len(rows) > GROUP_LIMIT:
        raise ValueError(f"more than {GROUP_LIMIT} groups; use quantile_table")
    none = {c: [None] * len(probs) for c in cols}
    found = {r["group"] if by else None: none | {f["feature"]: list(f["quantiles"]) for f in r["found"] if f["quantiles"]} for r in rows}
    return found if by or found else {None: none}


def quantile_table(
    df: DataFrame, cols: list[str], probs: list[float], by: str | None = None, exact: bool = True, cell_limit: int | None = None,
) -> DataFrame:
    """``group, feature, quantiles``, a row per group and column; quantiles are null for a column without values.

    Without ``by`` the only group is 0. ``exact=False`` takes the sketch's values (rank error n / 10,000).
    """
    probs, names = [float(p) for p in probs], [f"c{i}" for i in range(len(cols))]
    group = F.col(by) if by else F.lit(0)
    work = df.select(group.alias("__g"), *[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(cols, names, strict=True)])
    if not exact:
        return _long(work.groupBy("__g").agg(*[F.percentile_approx(n, probs, ACCURACY).alias(n) for n in names]), cols, names)
    rows = work.count()
    limit = max((CELL_LIMIT if cell_limit is None else cell_limit) // max(1, len(cols)), rows // MOST_BIG)
    direct = lambda part: _long(part.groupBy("__g").agg(*[F.percentile(n, probs).alias(n) for n in names]), cols, names)
    if rows <= limit or not cols:
        return direct(work)
    kind = work.schema["__g"].dataType.simpleString()
    big = [(r["__g"], r["count"]) for r in work.groupBy("__g").count().filter(F.col("count") > limit).collect()] if by else [(0, rows)]  # below MOST_BIG
    if not big:
        return direct(work)
    ids = F.broadcast(df.sparkSession.createDataFrame([(g, i) for i, (g, _) in enumerate(big)], f"__big {kind}, __id int"))
    same = F.col("__g").eqNullSafe(F.col("__big"))
    chosen = work.join(ids, same).select("__id", *names)
    found = _select(chosen, names, probs, [n for _, n in big]).join(ids, "__id")
    features = F.array(*[F.lit(c) for c in cols])
    out = found.select(F.col("__big").alias("group"), F.element_at(features, F.col("column") + 1).alias("feature"), "quantiles")
    return out.unionByName(direct(work.join(ids, same, "left_anti"))) if by else out


def _long(wide: DataFrame, cols: list[str], names: list[str]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(n).alias("quantiles")) for c, n in zip(cols, names, strict=True)])
    return wide.select(F.col("__g").alias("group"), F.inline(rows))


class Marks:
    """Ascending marks of every (column, group) that cut its values into cells: cell i holds values above mark i - 1, up to mark i."""

    def __init__(self, marks: list[list[np.ndarray]]) -> None:
        sizes = np.array([[len(m) for m in of_column] for of_column in marks])
        self.first = np.cumsum(np.append(0, sizes.ravel()))
        self.shape, self.flat = sizes.shape, np.concatenate([m for of_column in marks for m in of_column])
        #: number of the first cell of each (column, group); a group has a cell more than marks
        self.cell = self.first[:-1] + np.arange(sizes.size)
        self.cells = int(self.first[-1] + sizes.size)

    def cells_of(self, column: int, groups: np.ndarray, values: np.ndarray) -> np.ndarray:
        """The cell of each value, by a binary search in the marks of its group; NaN comes last."""
        at = column * self.shape[1] + groups
        low, high = self.first[at], self.first[at + 1]
        while (low < high).any():
            middle = (low + high) // 2
            above = (low < high) & ~(self.flat[np.minimum(middle, len(self.flat) - 1)] >= values) if len(self.flat) else low < high
            low, high = np.where(above, middle + 1, low), np.where(above | (low >= high), high, middle)
        return self.cell[at] + low - self.first[at]


def _values(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column that are not null, and where they are."""
    column = batch.column(batch.schema.get_field_index(name))
    there = np.flatnonzero(column.is_valid().to_numpy(zero_copy_only=False))
    return column.drop_null().to_numpy(zero_copy_only=False), there


def _select(work: DataFrame, names: list[str], probs: list[float], sizes: list[int]) -> DataFrame:
    """``__id, column, quantiles`` of the rows (__id, *names); group i has ``sizes[i]`` rows."""
    groups = len(sizes)
    wanted_cells = [max(1, min(CELLS // groups, n // CELL_ROWS)) for n in sizes]
    finest = max(wanted_cells)
    by_id: dict = {}
    if finest > 1:
        share = [i / finest for i in range(1, finest)]
        sketch = work.groupBy("__id").agg(*[F.percentile_approx(F.when(~F.isnan(n), F.col(n)), share, ACCURACY).alias(n) for n in names])
        by_id = {r["__id"]: r for r in sketch.collect()}

    def marks_of(i: int, name: str) -> np.ndarray:
        found = np.array((by_id[i][name] if i in by_id else None) or [], float)
        take = np.linspace(0, len(found) - 1, wanted_cells[i] - 1).round().astype(int) if len(found) else []
        return np.unique(found[take])

    marks = Marks([[marks_of(i, n) for i in range(groups)] for n in names])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(marks.cells, np.int64)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for j, name in enumerate(names):
                values, there = _values(batch, name)
                total += np.bincount(marks.cells_of(j, ids[there], values), minlength=marks.cells)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["cell", "rows"])

    rows = np.zeros(marks.cells, np.int64)
    for r in work.mapInArrow(counted, "cell long, rows long").groupBy("cell").agg(F.sum("rows").alias("rows")).collect():
        rows[r["cell"]] = r["rows"]
    owner = np.searchsorted(marks.cell, np.arange(marks.cells), "right") - 1  # the (column, group) of each cell
    running = np.cumsum(rows) - rows
    size = np.bincount(owner, rows, len(marks.cell)).astype(np.int64)
    before = running - running[marks.cell][owner]
    wanted = np.zeros(marks.cells, bool)
    for k in np.flatnonzero(size):
        ranks = _ranks(probs, int(size[k]))
        first, last = marks.cell[k], marks.cell[k + 1] if k + 1 < len(marks.cell) else marks.cells
        wanted[first + np.searchsorted(before[first:last] + rows[first:last], ranks, "right")] = True

    def sent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for j, name in enumerate(names):
                values, there = _values(batch, name)
                cells = marks.cells_of(j, ids[there], values)
                kept = wanted[cells]
                merged = pd.DataFrame({"cell": cells[kept], "v": values[kept]}).groupby(["cell", "v"], dropna=False).size().reset_index(name="rows")
                yield pa.RecordBatch.from_pandas(merged.astype({"cell": np.int64, "v": float, "rows": np.int64}), preserve_index=False)

    def picked(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        cell = key[0]
        frame = frame.sort_values("v")
        ends = before[cell] + frame["rows"].cumsum().to_numpy()
        ranks = np.unique(_ranks(probs, int(size[owner[cell]])))
        ranks = ranks[(ranks >= before[cell]) & (ranks < before[cell] + rows[cell])]
        return pd.DataFrame({"owner": owner[cell], "rank": ranks, "v": frame["v"].to_numpy()[np.searchsorted(ends, ranks, "right")]})

    def joined(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        known = dict(zip(frame["rank"], frame["v"], strict=True))
        out = []
        for p in probs:
            place = p * (int(size[key[0]]) - 1)
            low, high, part = known[math.floor(place)], known[math.ceil(place)], place - math.floor(place)
            out.append(low if low == high else (1 - part) * low + part * high)  # the weighted mean that the built-in percentile forms
        return pd.DataFrame({"owner": [key[0]], "quantiles": [out]})

    values = work.mapInArrow(sent, "cell long, v double, rows long").groupBy("cell", "v").agg(F.sum("rows").alias("rows"))
    order = values.groupBy("cell").applyInPandas(picked, "owner long, rank long, v double")
    found = order.groupBy("owner").applyInPandas(joined, "owner long, quantiles array<double>")
    return found.select((F.col("owner") % groups).cast("int").alias("__id"), F.floor(F.col("owner") / groups).cast("int").alias("column"), "quantiles")


def _ranks(probs: list[float], size: int) -> np.ndarray:
    place = np.array(probs) * (size - 1)
    return np.concatenate([np.floor(place), np.ceil(place)]).astype(np.int64)
