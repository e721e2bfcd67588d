"""How filters on documents overlap, with a counting-Bloom prepass for the filter on repeated texts.

``flags`` gives each document its failed filters as a bit mask, by expressions over the whole text. The filter on repeats (E)
needs all other texts; instead of shuffling every text, a counting Bloom filter over 64-bit text hashes is made first: each task
counts its hashes in counters of 0, 1 or "more" (two bitmaps), sketches are merged chunk by chunk, and a text one of whose
counters stands at 1 occurs once in the table, for certain. Only the other texts, the possible repeats, are shuffled, for the
exact smallest doc_id of each full text; equal texts meet in a task only after each task has reduced them to one row.

Masks are additive: every document adds one to its mask without E, and a document found repeated moves one from there to the mask
with E. Labels join the documents' counts by doc_id, and the counts of (part, mask, quality, toxicity) answer every order of the
filters: a document is removed at the first filter of the order in its mask.

The sketch has 16 counters a document, at most ``COUNTERS`` (64 MB in all), which proves the size of what is sent to the tasks. Up
to some 50 million documents it clears nearly all unique texts; beyond, it clears fewer and more texts are shuffled; the result
is the same at any size.

A null text counts as empty, and empty texts are equal to each other. A null source counts as the empty string. A document
without doc_id fails E never and makes no other fail; repeated rows count each, and rows that share doc_id and text do not make
each other fail. Labels are joined by doc_id; a doc_id labelled more than once has a label if any of its rows gives it. An empty
table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import column, mix, stored

FILTERS = "ABCDE"
#: Most counters of a sketch, counters a document, hash functions, and bytes of a chunk of one bitmap.
COUNTERS, EACH, HASHES, CHUNK = 1 << 28, 16, 4, 1 << 16
BLANKS = r"[\x20\x09-\x0D]+"


def failed_on_text(text: str = "text") -> dict[str, Column]:
    """Filters A to D on a text column and its column ``__words``; true where the document fails."""
    words, distinct, t = F.size("__words"), F.size(F.array_distinct("__words")), F.col(text)
    capitals = F.length(t) - F.length(F.regexp_replace(t, "[A-Z]", ""))
    return {"A": words < 50, "B": 100 * distinct < 65 * words, "C": 100 * capitals > 5 * F.length(t), "D": t.rlike("[#$%&*|]")}


def flags(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask (bits of A to D), hash and sha of each document's text."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("source"), F.lit("")).alias("part"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"))
    rows = rows.withColumn("__words", F.array_remove(F.split("text", BLANKS), ""))
    mask = sum((F.when(failed, 1 << i).otherwise(0) for i, failed in enumerate(failed_on_text().values())), F.lit(0))
    return rows.select("doc_id", "part", mask.alias("mask"), F.xxhash64("text").alias("hash"), F.sha2("text", 256).alias("sha"))


class CountingBloom:
    """Counters of 0, 1 and more, as two bitmaps; what is added in parts and merged is what is added at once."""

    def __init__(self, counters: int) -> None:
        self.mask, self.once, self.more = np.uint64(counters - 1), np.zeros(counters // 64, np.uint64), np.zeros(counters // 64, np.uint64)

    def places(self, hashes: np.ndarray) -> np.ndarray:
        """Different counters of each hash: an odd step never meets a counter twice."""
        first = mix(hashes.astype(np.int64).view(np.uint64))
        step = mix(first + np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        return (first[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) & self.mask

    def add(self, hashes: np.ndarray) -> None:
        place, count = np.unique(self.places(hashes).ravel(), return_counts=True)
        for some, bits in ((count > 1, self.more), (count > 0, None)):
            word, bit = (place[some] >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place[some] & np.uint64(63))
            if not len(word):
                continue
            lead = np.flatnonzero(np.diff(word, prepend=-1))
            value, word = np.bitwise_or.reduceat(bit, lead), word[lead]
            if bits is None:
                self.more[word] |= self.once[word] & value
                self.once[word] |= value
            else:
                bits[word] |= value

    def repeated(self, hashes: np.ndarray) -> np.ndarray:
        """False for hashes that were added once at most, for certain."""
        place = self.places(hashes)
        return ((self.more[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)).all(axis=1)


def counters_for(count: int, most: int = COUNTERS) -> int:
    return min(most, max(1 << 15, 1 << (EACH * max(1, count) - 1).bit_length()))


def sketch(hashes: DataFrame, counters: int) -> CountingBloom:
    """The counting Bloom filter over the column ``hash``; a task sends the chunks that it has touched."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = CountingBloom(counters)
        for batch in batches:
            own.add(column(batch, "hash").to_numpy(zero_copy_only=False))
        yield from chunks({k: (o, m) for k, (o, m) in enumerate(zip(cut(own.once), cut(own.more), strict=True)) if o.any()})

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for k, o, m in zip(*(column(batch, name).to_pylist() for name in ("chunk", "once", "more")), strict=True):
                once, more = np.frombuffer(o, np.uint64), np.frombuffer(m, np.uint64)
                if k in held:
                    a, b = held[k]
                    once, more = a | once, b | more | (a & once)
                held[k] = once, more
        yield from chunks(held)

    def cut(bits: np.ndarray) -> Iterator[np.ndarray]:
        return (bits[at : at + CHUNK // 8] for at in range(0, len(bits), CHUNK // 8))

    def chunks(held: dict) -> Iterator[pa.RecordBatch]:
        for k, (once, more) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([k], pa.int32()), pa.array([once.tobytes()], pa.binary()), pa.array([more.tobytes()], pa.binary())], names=["chunk", "once", "more"])

    schema = "chunk int, once binary, more binary"
    out = CountingBloom(counters)
    for row in hashes.select("hash").mapInArrow(build, schema).repartition("chunk").mapInArrow(merge, schema).toLocalIterator():
        at = row["chunk"] * (CHUNK // 8)  # all rows together are two bitmaps of ``counters`` bits
        out.once[at : at + CHUNK // 8], out.more[at : at + CHUNK // 8] = np.frombuffer(row["once"], np.uint64), np.frombuffer(row["more"], np.uint64)
    return out


def repeats(docs: DataFrame, rows: DataFrame, counters: int) -> DataFrame:
    """The rows of ``rows`` (made by ``flags``) whose text is also that of a smaller doc_id."""
    sent = docs.sparkSession.sparkContext.broadcast(sketch(rows, counters))

    @F.pandas_udf("boolean")
    def maybe(hashes: pd.Series) -> pd.Series:
        return pd.Series(sent.value.repeated(hashes.to_numpy(np.int64)))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    first = texts.filter(maybe(F.xxhash64("text"))).groupBy("text").agg(F.min("doc_id").alias("__id")).select("__id", F.sha2("text", 256).alias("__sha"))
    possible = rows.filter(maybe("hash") & F.col("doc_id").isNotNull())
    return possible.join(first, (F.col("doc_id") == F.col("__id")) & (F.col("sha") == F.col("__sha")), "left_anti")


def mask_counts(docs: DataFrame, labels: DataFrame, counters: int | None = None) -> DataFrame:
    """part, mask, good, toxic, n: how many documents of a part fail exactly the filters of a mask."""
    rows = stored(flags(docs), "flags")
    counters = counters or counters_for(rows.count())
    bit = 1 << FILTERS.index("E")
    plain = rows.select("doc_id", "part", "mask", F.lit(1).alias("n"))
    moved = repeats(docs, rows, counters).select(
        "doc_id", "part", F.explode(F.array(
            F.struct(F.col("mask"), F.lit(-1).alias("n")), F.struct(F.col("mask").bitwiseOR(F.lit(bit)).alias("mask"), F.lit(1).alias("n")))).alias("m"),
    ).select("doc_id", "part", "m.mask", "m.n")
    by_id = plain.unionByName(moved).groupBy("doc_id", "part", "mask").agg(F.sum("n").alias("n")).filter("n <> 0")
    marked = labels.filter("quality = 1 or toxic = 1").groupBy(F.col("doc_id").cast("long").alias("__id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("__good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("__toxic"))
    joined = by_id.join(marked, F.col("doc_id") == F.col("__id"), "left")
    none = F.lit(False)
    return joined.groupBy("part", "mask", F.coalesce("__good", none).alias("good"), F.coalesce("__toxic", none).alias("toxic")).agg(F.sum("n").alias("n"))


def audit(docs: DataFrame, labels: DataFrame, counters: int | None = None) -> DataFrame:
    """One row per part, order of the filters and step, with what the step's filter does there.

    kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley: see ``queries``; all count documents of the part.
    """
    # A part has at most 2^5 masks, each with 4 label marks.
    parts = mask_counts(docs, labels, counters).groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("__rows"))
    orders = F.array(*(F.lit("".join(p)) for p in permutations(FILTERS)))
    ordered = parts.withColumn("filter_order", F.explode(orders)).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    bits = {f: 1 << i for i, f in enumerate(FILTERS)}
    place = {f: F.instr("filter_order", f) for f in FILTERS}
    steps = ordered.withColumns({
        "__own": sum((F.when(place[f] == F.col("step"), b).otherwise(0) for f, b in bits.items()), F.lit(0)),
        "__before": sum((F.when(place[f] < F.col("step"), b).otherwise(0) for f, b in bits.items()), F.lit(0))})

    def total(weight) -> Column:
        return F.aggregate("__rows", F.lit(0).cast("long"), lambda a, r: a + weight(r).cast("long"))

    def counted(condition, of=lambda r: r["n"]) -> Column:
        return total(lambda r: F.when(condition(r), of(r)).otherwise(0))

    own, before = F.col("__own"), F.col("__before")
    fails, gone = lambda r: r["mask"].bitwiseAND(own) != 0, lambda r: r["mask"].bitwiseAND(before) != 0
    here = lambda r: fails(r) & ~gone(r)
    # Of all orders, a document with b failed filters is removed by each of them equally often.
    share = lambda r: r["n"] * (F.lit(120) / F.bit_count(r["mask"])).cast("long")
    return steps.select(
        "part", "filter_order", "step", counted(lambda r: ~fails(r) & ~gone(r)).alias("kept"), counted(here).alias("removed"),
        counted(lambda r: fails(r) & gone(r)).alias("redundant"), counted(lambda r: r["mask"] == own).alias("unique_fails"),
        counted(lambda r: here(r) & r["good"]).alias("good_lost"), counted(lambda r: here(r) & r["toxic"]).alias("toxic_lost"),
        counted(fails, share).alias("shapley"))
