"""Line dedup by a deletion-neighbourhood join, with an edit bound of one character.

A line is dropped if the same line, or one within one inserted, deleted or replaced character, stands earlier in the
corpus (by doc_id, then line number). Lines of fewer than ``MIN_CHARS`` characters are dropped for an equal line only: short forms
differ by one character without being copies. Blank lines (nothing but spaces, tabs and other ASCII white space) always stay.

1. Every line becomes a hash; equal lines become one, with its first place.
2. *Windows.* If two lines are one edit apart and the edit lies in the w-th of W windows of the longer one, all before and
   after that window is equal. So a line can have a neighbour only if it shares such a window-less key with another line.
   This holds for every pair; it leaves few lines for the next step. It is applied with few, then with many windows.
3. *Deletion neighbourhood.* Each line left emits its hash and the hash of every variant with one character deleted, with
   and without the place of the deletion. Equal (variant, place): one character replaced. A line equal to a variant: one
   inserted or deleted. Only the earliest line of each key is passed on, so a key that very many lines share costs one row
   per line and no pairs.
4. The edit distance of each line to the earliest partner found is verified on the texts.

Null texts stay null and empty texts empty; repeated rows of a doc_id keep and lose the same lines; other columns are
untouched. Lines end at line feeds only. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, column, mix, powers, release, stored, texts_of

MIN_CHARS, WINDOWS = 20, (2, 16)
#: Characters worked on at a time inside a task.
BLOCK = 1 << 19
SALT = np.uint64(0xA0761D6478BD642F)


class LineHasher:
    """Hashes of lines, of their parts and of their deletion variants, by sums of character values times powers."""

    def __init__(self) -> None:
        self.up, self.down = np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def load(self, text: str) -> None:
        """Take a text whose lines are to be hashed; ``start`` and ``end`` are its lines' places."""
        self.chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(self.chars)
        if n + 2 > len(self.up):
            self.up, self.down = powers(BASE, n + n // 4 + 2), powers(pow(BASE, -1, 2**64), n + n // 4 + 2)
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(self.chars.astype(np.uint64) + SALT) * self.up[:n], out=self.total[1:])
        breaks = np.flatnonzero(self.chars == 10)
        self.start, self.end = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [n]])

    def filled(self) -> np.ndarray:
        """Numbers of the lines that are not blank."""
        ink = np.concatenate([[0], np.cumsum((self.chars != 32) & ((self.chars < 9) | (self.chars > 13)))])
        return np.flatnonzero(ink[self.end] > ink[self.start])

    def part(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.total[end] - self.total[start]) * self.down[start]

    def whole(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix(self.part(start, end) + (end - start).astype(np.uint64) * SALT)

    def without(self, start: np.ndarray, end: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of the line ``start:end`` less its part ``a:b``, equal to ``whole`` of the shorter line."""
        joined = self.part(start, a) + self.part(b, end) * self.up[a - start]
        return mix(joined + (end - start - (b - a)).astype(np.uint64) * SALT)

    def window_keys(self, start: np.ndarray, end: np.ndarray, windows: int) -> np.ndarray:
        """2 * windows keys per line: it may be the longer or the shorter of a pair."""
        out = []
        for longer in (0, 1):
            n = end - start + longer
            for w in range(windows):
                a, b = w * n // windows, n - (w + 1) * n // windows
                b = np.minimum(b, end - start)
                a = np.minimum(a, end - start - b)
                shape = (n * windows + w).astype(np.uint64) * np.uint64(BASE)
                out.append(mix(mix(self.part(start, start + a) + shape) + self.part(end - b, end)))
        return np.stack(out, axis=1) if len(start) else np.zeros((0, 2 * windows), np.uint64)


def line_table(docs: DataFrame, min_chars: int) -> DataFrame:
    """(line, doc_id, number, keys) per line that is not blank; lines under ``min_chars`` characters have no keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            hasher = LineHasher()
            for batch in batches:
                found = []
                for doc, text in zip(column(batch, "doc_id").to_pylist(), column(batch, "text").to_pylist(), strict=True):
                    hasher.load(text)
                    number = hasher.filled()
                    start, end = hasher.start[number], hasher.end[number]
                    near = end - start >= min_chars
                    keys = hasher.window_keys(start[near], end[near], WINDOWS[0]).view(np.int64)
                    found.append((hasher.whole(start, end).view(np.int64), np.full(len(number), doc), number, near, keys.reshape(-1)))
                if found:
                    line, doc, number, near, keys = (np.concatenate(x) for x in zip(*found, strict=True))
                    ends = np.concatenate([[0], np.cumsum(near * (2 * WINDOWS[0]))]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(line), pa.array(doc, pa.int64()), pa.array(number.astype(np.int32)), pa.ListArray.from_arrays(pa.array(ends), pa.array(keys))],
                        names=["line", "doc_id", "number", "keys"])

    return texts_of(docs).filter("doc_id is not null").mapInArrow(run, "line long, doc_id long, number int, keys array<long>")


def shared(keyed: DataFrame) -> DataFrame:
    """Lines that share a key with another line; ``keyed`` has line and keys."""
    rows = keyed.select("line", F.explode("keys").alias("key"))
    common = rows.groupBy("key").agg(F.min("line").alias("low"), F.max("line").alias("high")).filter("low <> high").select("key")
    return rows.join(common, "key").select("line").distinct()


def candidate_texts(docs: DataFrame, places: DataFrame) -> DataFrame:
    """(line, doc_id, number, text, keys) of the lines at the given places, with the finer window keys."""
    wanted = places.groupBy("doc_id").agg(F.collect_list(F.struct("number", "line")).alias("wanted"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            hasher = LineHasher()
            for batch in batches:
                rows = []
                for doc, text, lines in zip(*(column(batch, c).to_pylist() for c in ("doc_id", "text", "wanted")), strict=True):
                    hasher.load(text)
                    numbers = np.array([x["number"] for x in lines])
                    ok = numbers < len(hasher.start)
                    numbers, names = numbers[ok], np.array([x["line"] for x in lines])[ok]
                    start, end = hasher.start[numbers], hasher.end[numbers]
                    keys = hasher.window_keys(start, end, WINDOWS[1]).view(np.int64)
                    rows += [(int(n), doc, int(k), text[s:e], ks.tolist()) for n, k, s, e, ks in zip(names, numbers, start, end, keys, strict=True)]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)],
                    names=["line", "doc_id", "number", "text", "keys"])

    one = texts_of(docs).join(wanted, "doc_id").select("doc_id", "text", "wanted")
    return one.mapInArrow(run, "line long, doc_id long, number int, text string, keys array<long>")


def variants(lines: DataFrame) -> DataFrame:
    """The deletion neighbourhood: (key, role, line, place); role 0 replaced, 1 variant, 2 the line itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            hasher = LineHasher()
            for batch in batches:
                for line, doc, number, text in zip(*(column(batch, c).to_pylist() for c in ("line", "doc_id", "number", "text")), strict=True):
                    hasher.load(text)
                    n = len(hasher.chars)
                    at = np.flatnonzero(np.concatenate([[True], hasher.chars[1:] != hasher.chars[:-1]]))  # the first of a run stands for it
                    zero, end = np.zeros(len(at), np.int64), np.full(len(at), n)
                    gone = hasher.without(zero, end, at, at + 1)
                    # A replaced character may stand next to an equal one, so every place counts there.
                    every = np.arange(n)
                    placed = mix(hasher.without(np.zeros(n, np.int64), np.full(n, n), every, every + 1) + (every + 1).astype(np.uint64) * SALT)
                    key = np.concatenate([placed, gone, hasher.whole(zero[:1], end[:1])])
                    role = np.repeat(np.array([0, 1, 2], np.int8), [n, len(at), 1])
                    m = len(key)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), pa.array(role), pa.array(np.full(m, line)), pa.array(np.full(m, doc)), pa.array(np.full(m, number, np.int32))],
                        names=["key", "role", "line", "doc_id", "number"])

    return lines.select("line", "doc_id", "number", "text").mapInArrow(run, "key long, role byte, line long, doc_id long, number int")


def earlier_neighbours(lines: DataFrame) -> DataFrame:
    """Lines with an earlier line within one edit; ``lines`` has line, doc_id, number and text."""
    place = F.struct("doc_id", "number", "line")
    rows = stored(variants(lines), "deletion-variants")
    first = rows.groupBy("key", "role").agg(F.min(place).alias("first"), F.max("line").alias("high"), F.min("line").alias("low"))
    swapped = first.filter("role = 0 and low <> high").select("key", F.lit(0).cast("byte").alias("role"), "first")
    # A line that equals a variant: each side is shown the first of the other.
    ends = first.filter("role > 0").select("key", (3 - F.col("role")).cast("byte").alias("role"), "first")
    both = ends.groupBy("key").agg(F.count("*").alias("roles")).filter("roles = 2").select("key")
    met = swapped.unionByName(ends.join(both, "key"))
    found = rows.join(met, ["key", "role"]).filter(F.col("first") < place).groupBy("line").agg(F.min("first.line").alias("any"), F.min("first").alias("first"))
    named = lines.select("line", "text")
    checked = found.select("line", F.col("first.line").alias("partner")).join(named, "line").join(
        named.select(F.col("line").alias("partner"), F.col("text").alias("other")), "partner")
    return checked.filter(F.levenshtein("text", "other", 1) >= 0).select("line")


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(doc_id, dropped, near): numbers of the lines to drop, and how many of them are inexact copies."""
    every = stored(line_table(docs, min_chars), "lines")
    place = F.struct("doc_id", "number")
    distinct = stored(every.groupBy("line").agg(F.min(place).alias("first"), F.count("*").alias("m"), F.min("keys").alias("keys")), "distinct-lines")
    coarse = shared(distinct)
    places = distinct.join(coarse, "line").select("line", "first.doc_id", "first.number")
    texts = stored(candidate_texts(docs, places), "line-texts")
    release(docs.sparkSession)
    fine = stored(texts.join(shared(texts), "line", "left_semi").drop("keys"), "close-lines")
    near = stored(earlier_neighbours(fine).withColumn("near", F.lit(1)), "near-lines")
    release(docs.sparkSession)
    marked = distinct.select("line", "first", "m").join(near, "line", "left").filter("m > 1 or near = 1")
    gone = every.select("line", "doc_id", "number").join(marked, "line").filter(F.col("near").isNotNull() | (place > F.col("first")))
    return gone.groupBy("doc_id").agg(F.collect_set("number").alias("dropped"), F.count_distinct(F.when(F.col("near") == 1, F.col("number"))).alias("near"))


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """All rows and columns of ``docs``, with repeated lines gone from ``text``, and ``__lines``, ``__removed``, ``__near``."""
    gone = dropped_lines(docs, min_chars).select(F.col("doc_id").alias("__id"), F.col("dropped").alias("__numbers"), F.col("near").alias("__inexact"))
    joined = docs.join(gone, F.col("doc_id").cast("long") == F.col("__id"), "left")
    split = F.split("text", "\n", -1)
    kept = F.array_join(F.filter("__split", lambda x, i: ~F.array_contains("__dropped", i)), "\n")
    return joined.withColumn("__split", split).withColumn("__dropped", F.coalesce("__numbers", F.array().cast("array<int>"))).select(
        *[F.when(F.size("__dropped") > 0, kept).otherwise(F.col("text")).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns],
        F.coalesce(F.size("__split"), F.lit(0)).cast("long").alias("__lines"),
        F.size("__dropped").cast("long").alias("__removed"), F.coalesce("__inexact", F.lit(0)).cast("long").alias("__near"))
