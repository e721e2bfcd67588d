"""Suffix-array dedup: bytes covered by a ``LENGTH``-byte string that also starts elsewhere.

*Sharding.* Every window of ``LENGTH`` bytes is keyed by the least hash of the ``GRAM``-byte strings in it, so equal windows have
equal keys; windows in a row with one key make a segment. Keys met once, whose string stands once in its text, cannot repeat
and go no further. Equal segments are
counted and become one; a segment met twice is repeated throughout. Keys with several different segments, or one
that may repeat within itself, are left, and a shard
holds the segments of some of these keys: all places of a window are in one shard, and no other text is.

*Oversized keys.* A passage of ``GRAM`` bytes or more, but fewer than ``LENGTH``, gives each document that holds it a different
segment under one key. The windows of a key of more than ``SHARD`` bytes are split again by their own digests: they are counted per
digest before the shuffle, and only digests met twice go back to their places, so no such key meets in one task.

*Induced sorting.* A shard's text is suffix-sorted by induction: the strings between local minima (LMS) get names in their order, the
suffixes at the minima are ranked over the reduced text of these names, and in one ascending and one descending pass over the byte values each sorted suffix puts the suffix before
it at the end of its value's queue. Queues keep at most ``IN_MEMORY`` entries in memory and the rest in the task's temporary
folder. The reduced text is ranked by doubling, up to the window length. Neighbours in this order whose windows are equal mark
both windows as repeated.

Null and empty texts have nothing to remove; matches never cross documents; rows without doc_id are left out; rows that repeat
a doc_id are one document each if their texts are equal, and none may differ. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BASE, SEED, column, mix, powers, release, stored, text_chunks, texts_of

LENGTH, GRAM, SHARD, IN_MEMORY = 400, 128, 3_000_000, 400_000
#: Windows of an oversized key handed over at a time, and places from which a digest's join is by broadcast.
WINDOWS, COMMON = 1 << 18, 10_000


RUNS = "d1 long, d2 long, runs array<struct<first:long,n:long>>"


class ByteHasher:
    """Hashes of all strings of one length, and digests of any parts, of a byte array."""

    def __init__(self) -> None:
        self.up, self.down = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.value = np.random.default_rng(SEED + 1).integers(1, 2**63, (2, 256), dtype=np.uint64)

    def load(self, data: np.ndarray) -> None:
        n = len(data)
        if n + 1 > len(self.up):
            self.up, self.down = powers(BASE, n + n // 4 + 1), powers(pow(BASE, -1, 2**64), n + n // 4 + 1)
        self.total = np.zeros((2, n + 1), np.uint64)
        for k in (0, 1):
            np.cumsum(self.value[k][data] * self.up[:n], out=self.total[k, 1:])

    def parts(self, start: np.ndarray, end: np.ndarray, k: int = 0) -> np.ndarray:
        return mix((self.total[k][end] - self.total[k][start]) * self.down[start])

    def strings(self, start: int, end: int, size: int) -> np.ndarray:
        """Hash of each string of ``size`` bytes inside ``start:end``."""
        at = np.arange(start, end - size + 1)
        return mix((self.total[0][start + size : end + 1] - self.total[0][start : end - size + 1]) * self.down[at])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` values in a row, from running minima of blocks in both directions."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).reshape(-1)
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def segment_table(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """(doc_id, start, windows, again, key, d1, d2) for all runs of windows with one key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            hasher = ByteHasher()
            for batch in batches:
                doc = column(batch, "doc_id").to_numpy()
                for row, offsets, data in text_chunks(column(batch, "text")):
                    hasher.load(data)
                    out = []
                    for k, (low, high) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
                        if high - low < length:
                            continue
                        strings, width = hasher.strings(low, high, gram), length - gram + 1
                        keys = sliding_min(strings, width)
                        start = np.flatnonzero(np.diff(keys, prepend=~keys[:1]))
                        windows = np.diff(start, append=len(keys))
                        a, b = low + start, low + start + windows + length - 1
                        # A key whose string stands twice in this text may repeat inside one segment.
                        padded = np.concatenate([np.zeros(width - 1, np.uint64), keys, np.zeros(width - 1, np.uint64)])
                        least = np.sort(strings[strings == ~sliding_min(~padded, width)])
                        again = np.isin(keys[start], least[1:][least[1:] == least[:-1]]).astype(np.int64)
                        out.append((np.full(len(start), doc[row + k]), start, windows, again, keys[start].view(np.int64), hasher.parts(a, b).view(np.int64), hasher.parts(a, b, 1).view(np.int64)))
                    if out:
                        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c), pa.int64()) for c in zip(*out, strict=True)], names=["doc_id", "start", "windows", "again", "key", "d1", "d2"])

    return docs.mapInArrow(run, "doc_id long, start long, windows long, again long, key long, d1 long, d2 long")


class Queue:
    """First in, first out, of suffix places; beyond ``limit`` entries of all queues the entries wait on disk.

    Each queue gathers up to a 256th of ``limit`` more entries before it writes a file.
    """

    held = 0

    def __init__(self, folder: str, limit: int) -> None:
        self.folder, self.limit, self.parts, self.last, self.waiting = folder, limit, deque(), [], 0

    def push(self, places: np.ndarray) -> None:
        if not self.last and Queue.held + len(places) <= self.limit:
            Queue.held += len(places)
            self.parts.append(places)
            return
        self.last.append(places)
        self.waiting += len(places)
        if self.waiting >= max(1, self.limit // 256):
            handle, path = tempfile.mkstemp(dir=self.folder)
            with os.fdopen(handle, "wb") as file:
                file.writelines(p.tobytes() for p in self.last)
            self.parts.append(path)
            self.last, self.waiting = [], 0

    def take(self) -> np.ndarray:
        """The oldest part."""
        if not self.parts:
            part, self.last, self.waiting = np.concatenate(self.last), [], 0
            return part
        part = self.parts.popleft()
        if isinstance(part, str):
            path, part = part, np.fromfile(part, np.int32)
            os.unlink(path)
        else:
            Queue.held -= len(part)
        return part

    def pop(self) -> Iterator[np.ndarray]:
        """All entries in order, those that are pushed meanwhile included; about ``limit`` at a time, as few parts as possible."""
        while self.parts or self.last:
            gathered, size = [], 0
            while (self.parts or self.last) and size < max(1, self.limit):
                gathered.append(self.take())
                size += len(gathered[-1])
            yield np.concatenate(gathered)


def induced(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, folder: str, limit: int) -> np.ndarray:
    """All suffixes in order, from the order of those at local minima; ``text`` ends with its only 0, ``small`` marks S suffixes."""
    values = int(text.max()) + 1
    Queue.held = 0

    def deal(queues: list[Queue], places: np.ndarray) -> None:
        if not len(places):
            return
        keys = text[places]
        order = np.argsort(keys, kind="stable")
        places, keys = places[order], keys[order]
        cuts = np.flatnonzero(np.diff(keys, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(keys)], strict=True):
            queues[keys[a]].push(places[a:b])

    seeds = seeds.astype(np.int32)
    seeds = seeds[np.argsort(text[seeds], kind="stable")]
    at = np.searchsorted(text[seeds], np.arange(values + 1))
    rising, large = [Queue(folder, limit) for _ in range(values)], [[] for _ in range(values)]
    for c in range(values):
        for places in rising[c].pop():
            large[c].append(places)
            before = places[places > 0] - 1
            deal(rising, before[~small[before]])
        minima = seeds[at[c] : at[c + 1]]
        before = minima[minima > 0] - 1
        deal(rising, before[~small[before]])
    # The second pass fills the order from its end.
    falling, out, top = [Queue(folder, limit) for _ in range(values)], np.empty(len(text), np.int32), len(text)
    for c in reversed(range(1, values)):
        for places in falling[c].pop():
            out[top - len(places) : top] = places[::-1]
            top -= len(places)
            before = places[places > 0] - 1
            deal(falling, before[small[before]])
        while large[c]:
            places = large[c].pop()
            out[top - len(places) : top] = places
            top -= len(places)
            before = places[::-1][places[::-1] > 0] - 1
            deal(falling, before[small[before]])
    out[0] = len(text) - 1
    return out


def local_minima(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(S marks, LMS places) of a text that ends with its least value."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int64)))
    change = np.where(step != 0, np.arange(n - 1), n)
    nearest = np.minimum.accumulate(change[::-1])[::-1]  # a run of equal values has the kind of its end
    small = np.ones(n, bool)
    small[:-1] = step[np.minimum(nearest, n - 2)] > 0
    return small, np.flatnonzero(small[1:] & ~small[:-1]) + 1


def suffix_order(data: np.ndarray, reach: int, limit: int = IN_MEMORY) -> np.ndarray:
    """Suffixes of ``data`` in the order of their first ``reach`` bytes at least."""
    text = np.append(data.astype(np.int16) + 1, np.int16(0))
    if len(data) < 2:
        return np.arange(len(data))
    small, lms = local_minima(text)
    seeds = lms[np.argsort(reduced_ranks(lms_names(text, small, lms, reach), reach), kind="stable")]
    with tempfile.TemporaryDirectory() as folder:
        order = induced(text, small, seeds, folder, limit)
    return order[1:]  # without the end mark


def lms_names(text: np.ndarray, small: np.ndarray, lms: np.ndarray, reach: int) -> np.ndarray:
    """For each string from one local minimum to the next, both included, how many are less.

    Strings are compared by (value, kind), six places at a time; those already told apart or at their end are left out of the
    next six. Strings that agree in ``reach`` places count as equal.
    """
    n, m = len(text), len(lms)
    signs = text * np.int16(2) + small + np.int16(1)
    end = np.append(lms[1:] + 1, n)
    names, left = np.zeros(m, np.int64), np.arange(m)
    for done in range(0, reach, 6):
        code = np.zeros(len(left), np.uint64)
        for k in range(done, done + 6):
            place = lms[left] + k
            code = code << np.uint64(10) | np.where(place < end[left], signs[np.minimum(place, n - 1)], 0).astype(np.uint64)
        order = np.lexsort((code, names[left]))
        left, code, group = left[order], code[order], names[left[order]]
        opens = np.append(True, group[1:] != group[:-1])
        differs = opens | np.append(True, code[1:] != code[:-1])
        at = np.arange(len(left))
        first = at[differs][np.cumsum(differs) - 1]
        names[left] = group + first - at[opens][np.cumsum(opens) - 1]
        alone = differs & np.append(differs[1:], True)
        left = left[~alone & (lms[left] + done + 6 < end[left])]
        if not len(left):
            break
    return names


def reduced_ranks(names: np.ndarray, reach: int) -> np.ndarray:
    """Ranks of the suffixes of the reduced text of names, by doubling; a name stands for two places of the text or more."""
    n, size = len(names), 1
    kinds, ranks = np.unique(names, return_inverse=True)
    while len(kinds) < n and 2 * size < reach:
        ahead = np.zeros(n, np.int64)
        ahead[: max(0, n - size)] = ranks[size:] + 1
        kinds, ranks = np.unique(ranks * (n + 1) + ahead, return_inverse=True)
        size *= 2
    return ranks


def repeated_windows(segments: list[bytes], length: int, limit: int = IN_MEMORY) -> list[list[tuple[int, int]]]:
    """Of each segment the runs (first window, windows) that also start elsewhere in the shard."""
    with np.errstate(over="ignore"):
        sizes = np.array([len(s) for s in segments], np.int64)
        data = np.frombuffer(b"\xff".join(segments), np.uint8)
        first = np.cumsum(sizes + 1) - sizes - 1
        opens = np.zeros(len(data) + 1, np.int64)
        counts = np.maximum(sizes - length + 1, 0)
        np.add.at(opens, first, 1)
        np.add.at(opens, first + counts, -1)
        is_window = np.cumsum(opens[:-1]) > 0
        order = suffix_order(data, length, limit)
        order = order[is_window[order]]
        hasher = ByteHasher()
        hasher.load(data)
        found = np.zeros(len(data) + 1, bool)
        for low in range(0, len(order) - 1, WINDOWS):
            part = order[low : low + WINDOWS + 1]
            same = np.ones(len(part) - 1, bool)
            for k in (0, 1):
                digest = hasher.parts(part, part + length, k)
                same &= digest[1:] == digest[:-1]
            found[part[1:][same]] = True
            found[part[:-1][same]] = True
    out = []
    for low, n in zip(first.tolist(), counts.tolist(), strict=True):
        own = np.diff(np.concatenate([[0], found[low : low + n].astype(np.int8), [0]]))
        out.append(list(zip(np.flatnonzero(own == 1).tolist(), (np.flatnonzero(own == -1) - np.flatnonzero(own == 1)).tolist(), strict=True)))
    return out


def shard_runs(pieces: DataFrame, length: int, shard: int) -> DataFrame:
    """(d1, d2, runs) of the segments (key, d1, d2, data), suffix-sorted in shards of about ``shard`` bytes."""
    shards = max(1, -(-(pieces.agg(F.coalesce(F.sum(F.length("data")), F.lit(0))).first()[0]) // shard))

    def sort_shard(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates(["d1", "d2"])
        runs = repeated_windows(list(frame["data"]), length)
        return pd.DataFrame({"d1": frame["d1"], "d2": frame["d2"], "runs": [[{"first": a, "n": n} for a, n in r] for r in runs]})

    dealt = pieces.withColumn("shard", F.pmod("key", F.lit(shards)))
    return dealt.groupBy("shard").applyInPandas(sort_shard, RUNS)


def window_runs(pieces: DataFrame, length: int) -> DataFrame:
    """(d1, d2, runs) of the segments of oversized keys that have any: windows whose digest stands twice."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            hasher = ByteHasher()
            for batch in batches:
                for d1, d2, data in zip(*(column(batch, c).to_pylist() for c in ("d1", "d2", "data")), strict=True):
                    for low in range(0, len(data) - length + 1, WINDOWS):
                        part = np.frombuffer(data[low : low + WINDOWS + length - 1], np.uint8)
                        hasher.load(part)
                        at = np.arange(len(part) - length + 1)
                        w1, w2 = (hasher.parts(at, at + length, k).view(np.int64) for k in (0, 1))
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (np.full(len(at), d1), np.full(len(at), d2), low + at, w1, w2)], names=["d1", "d2", "at", "w1", "w2"])

    one = pieces.select("d1", "d2", "data").dropDuplicates(["d1", "d2"])
    windows = stored(one.mapInArrow(run, "d1 long, d2 long, at long, w1 long, w2 long"), "key-windows")
    counted = stored(windows.groupBy("w1", "w2").agg(F.count("*").alias("m")).filter("m > 1"), "window-counts")
    # Digests that very many places share would meet in one task; there are few of them.
    common, others = (counted.filter(c).select("w1", "w2") for c in (F.col("m") > COMMON, F.col("m") <= COMMON))
    found = windows.join(F.broadcast(common), ["w1", "w2"]).unionByName(windows.join(others, ["w1", "w2"]))

    def gather(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        at = np.sort(frame["at"].to_numpy(np.int64))
        cuts = np.flatnonzero(np.diff(at, prepend=-2) != 1)
        sizes = np.diff(cuts, append=len(at))
        return pd.DataFrame({"d1": [key[0]], "d2": [key[1]], "runs": [[{"first": int(a), "n": int(n)} for a, n in zip(at[cuts], sizes, strict=True)]]})

    return found.select("d1", "d2", "at").groupBy("d1", "d2").applyInPandas(gather, RUNS)


def repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard: int = SHARD) -> DataFrame:
    """(doc_id, spans): byte ranges covered by repeated windows, as structs (start, end), possibly overlapping."""
    spark = docs.sparkSession
    every = stored(segment_table(docs, length, gram), "segments")
    kinds = every.groupBy("key", "d1", "d2").agg(F.count("*").alias("m"), F.max("again").alias("again"), F.min(F.struct("doc_id", "start", "windows")).alias("least"))
    keys = kinds.groupBy("key").agg(F.count("*").alias("kinds"), F.sum("m").alias("places"), F.max("again").alias("twice"),
        (F.sum(F.col("least.windows") + length - 1) > shard).alias("large")).filter("places > 1 or twice = 1")
    kinds = stored(kinds.join(keys.select("key", "kinds", "twice", "large"), "key"), "segment-kinds")
    release(spark)
    wanted = kinds.filter("kinds > 1 or twice = 1").select("key", "large", "d1", "d2", "m", "least.*").groupBy("doc_id").agg(F.collect_list(F.struct("key", "large", "d1", "d2", "start", "windows")).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, parts in zip(column(batch, "text").to_pylist(), column(batch, "wanted").to_pylist(), strict=True):
                data = text.encode()
                rows += [(x["key"], x["large"], x["d1"], x["d2"], data[x["start"] : x["start"] + x["windows"] + length - 1]) for x in parts]
            kinds_of = (pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds_of, strict=True)], names=["key", "large", "d1", "d2", "data"])

    pieces = stored(docs.join(wanted, "doc_id").select("text", "wanted").mapInArrow(cut, "key long, large boolean, d1 long, d2 long, data binary"), "segment-bytes")
    release(spark)
    found = stored(shard_runs(pieces.filter("not large"), length, shard), "sorted-shards")
    large = pieces.filter("large")
    if not large.isEmpty():
        found = found.unionByName(stored(window_runs(large, length), "window-runs"))
        release(spark)
    whole = kinds.filter("m > 1").select("d1", "d2", F.lit(True).alias("whole"))
    marked = found.join(whole, ["d1", "d2"], "full").filter(F.coalesce("whole", F.lit(False)) | (F.size("runs") > 0))
    at = every.select("doc_id", "start", "windows", "d1", "d2").join(marked, ["d1", "d2"])
    all_of = F.array(F.struct(F.lit(0).cast("long").alias("first"), F.col("windows").alias("n")))
    spans = F.transform(F.when(F.col("whole"), all_of).otherwise(F.col("runs")), lambda r: F.struct(
        (F.col("start") + r["first"]).alias("start"), (F.col("start") + r["first"] + r["n"] + length - 1).alias("end")))
    return stored(at.groupBy("doc_id").agg(F.flatten(F.collect_list(spans)).alias("spans")), "spans")


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept): sizes and the bytes left, per document."""
    texts = texts_of(docs).filter("doc_id is not null")
    spans = repeats(texts, length)
    release(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, found in zip(*(column(batch, c).to_pylist() for c in ("doc_id", "text", "spans")), strict=True):
                data, kept, at, removed, runs = text.encode(), [], 0, 0, 0
                for a, b in sorted((x["start"], x["end"]) for x in found or ()):
                    if b <= at:
                        continue
                    if a > at or not runs:
                        kept.append(data[at:a])
                        runs += 1
                    removed += b - max(a, at)
                    at = b
                rows.append((doc, len(data), removed, runs, hashlib.sha256(b"".join([*kept, data[at:]])).hexdigest()))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 5, kinds, strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return texts.join(spans, "doc_id", "left").mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
