"""Packing by cutting-stock column generation.

A document's ids (its tokens and an end id) are cut into full pieces and one rest. Pieces are counted by length, in
steps of ``step`` ids. Over this histogram, at most ``capacity / step`` numbers at any input size, the driver solves the
linear program "fewest sequences": each column is a pattern (how many pieces of each length one sequence takes), a
knapsack dynamic program prices new columns by the duals, and a simplex step takes the best one in. Whole parts of the
solution are patterns to be used so many times; the few pieces left over are packed first-fit decreasing. Pieces are
ranked within their length, and a rank gives pattern, copy and slot by arithmetic over the pattern table.

Null texts count as empty; an empty document is its end id alone. Repeated rows are packed as documents of their own.
An empty table gives no rows.
"""

from __future__ import annotations

import gc
import json
import os
import unicodedata
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assayer.functions.ranks import hash_rank

from .common import column, stored, texts_of, tidy

CAPACITY, STEP, END_ID = 2048, 8, 1
#: Share of the sequences by which the linear program may miss its lower bound.
GAP = 1e-5
#: Entries that a task keeps at most of each kind, words and the tokenizer's own parts of words, in either of two generations.
REMEMBERED = 160_000
#: New words, or new parts, that are encoded as one text.
TOGETHER = 100
#: Words of these characters alone: composing leaves them as they are, and their case and class are the same in every Unicode version.
SIMPLE = regex.compile(r"[!-~\u00c0-\u012f\u0131-\u024f\u4e00-\u9fa5]+")
SIMPLE_TEXT = regex.compile(SIMPLE.pattern.replace("!-~", " -~"))


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Memory:
    """A bounded map: what was used since the last turn outlives it, the rest goes."""

    def __init__(self, limit: int = REMEMBERED) -> None:
        self.limit, self.now, self.before = limit, {}, {}

    def turn(self) -> None:
        if len(self.now) > self.limit:
            self.now, self.before = {}, self.now

    def missing(self, keys: set[str]) -> list[str]:
        """The keys that are new; those of the last generation are taken over."""
        new = keys.difference(self.now)
        if self.before:
            old = self.before.keys() & new  # goes through the smaller of the two
            self.now.update(zip(old, map(self.before.__getitem__, old)))
            new -= old
        return list(new)


class WordEncoder:
    """Ids of whole texts under a tokenizer that never joins across blanks, with the ids of each word kept.

    A tokenizer that lower-cases and marks the end of each part it cuts a word into has the ids of parts kept as well,
    which repeat far more often than words with their case and marks.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.words, self.parts = Tokenizer.from_file(path), Memory(), Memory()
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        steps = [n.get("type") for n in (settings.get("normalizer") or {}).get("normalizers", [])]
        cuts = (settings.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        pattern = cuts[0].get("pattern", {}).get("Regex")
        suffix = settings["model"].get("end_of_word_suffix")
        known = steps == ["NFC", "Replace", "Lowercase"] and [c.get("type") for c in cuts] == ["Split", "ByteLevel"] and pattern and suffix
        self.cut = regex.compile(pattern).findall if known and cuts[0].get("invert") and cuts[0].get("behavior") == "Removed" else None
        if self.cut:
            vocab = self.tokenizer.get_vocab()
            self.last = np.zeros(max(vocab.values()) + 1, bool)
            self.last[[i for token, i in vocab.items() if token.endswith(suffix)]] = True

    def learn_parts(self, parts: list[str]) -> None:
        """Encode new parts, ``TOGETHER`` in one text; the last token of each is marked."""
        groups = [parts[at : at + TOGETHER] for at in range(0, len(parts), TOGETHER)]
        for group, found in zip(groups, self.tokenizer.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False), strict=True):
            ids = np.array(found.ids, "<u4")
            ends = 4 * (np.flatnonzero(self.last[ids]) + 1)
            data, cuts = ids.tobytes(), [0, *ends.tolist()]
            self.parts.now.update(zip(group, [data[a:b] for a, b in zip(cuts[:-1], cuts[1:])], strict=True))

    def learn(self, words: list[str]) -> None:
        if self.cut:
            simple = words if SIMPLE_TEXT.fullmatch(" ".join(words)) else [w for w in words if SIMPLE.fullmatch(w)]
            cut = self.cut
            # Letters alone are one part, as is one sign behind them.
            split = [[w] if w.isalpha() else [w[:-1], w[-1]] if w[-1:] in ".,;:!?" and w[:-1].isalpha() else cut(w)
                     for w in [w.lower() for w in simple]]
            self.learn_parts(self.parts.missing(set(chain.from_iterable(split))))
            known = self.parts.now
            self.words.now.update(zip(simple, [b"".join([known[p] for p in parts]) for parts in split], strict=True))
            if len(simple) == len(words):
                return
            words = [w for w in words if not SIMPLE.fullmatch(w)]
        self.learn_words(words)

    def learn_words(self, words: list[str]) -> None:
        """Encode new words, ``TOGETHER`` in one text, as an object for each would cost more than its encoding.

        Offsets tell the words' ids apart. They are sure where composing characters changes nothing; other words go alone.
        """
        plain = [w for w in words if unicodedata.is_normalized("NFC", w)]
        alone = [w for w in words if not unicodedata.is_normalized("NFC", w)] if len(plain) < len(words) else []
        groups = [plain[at : at + TOGETHER] for at in range(0, len(plain), TOGETHER)]
        found = self.tokenizer.encode_batch([" ".join(g) for g in groups] + alone, add_special_tokens=False)
        known = self.words.now
        for group, ids in zip(groups, found):
            begins = np.cumsum([0, *[len(w) + 1 for w in group[:-1]]])
            at = np.array(ids.offsets, np.int64).reshape(-1, 2)[:, 0]
            cuts = (4 * np.append(np.searchsorted(at, begins), len(at))).tolist()
            data = np.array(ids.ids, "<u4").tobytes()
            known.update(zip(group, [data[a:b] for a, b in zip(cuts[:-1], cuts[1:])], strict=True))
        for word, ids in zip(alone, found[len(groups) :], strict=True):
            known[word] = np.array(ids.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of each text as little-endian unsigned 32-bit numbers."""
        self.words.turn()
        self.parts.turn()
        split = [text.replace("\n", " ").split(" ") for text in texts]
        self.learn(self.words.missing(set().union(*split)))
        known = self.words.now
        for words in split:
            yield b"".join([known[w] for w in words])


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens."""
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end = WordEncoder(path), np.array([END_ID], "<u4").tobytes()
        gc.disable()  # the encoder makes millions of small objects, and no cycles to search for
        try:
            for batch in batches:
                rows = []
                for at in range(0, batch.num_rows, 64):
                    part = batch.slice(at, 64)
                    for doc, ids in zip(column(part, "doc_id").to_pylist(), encoder.encode(column(part, "text").to_pylist()), strict=True):
                        ids += end
                        total = len(ids) // 4
                        for start in range(0, total, capacity):
                            cut = ids[4 * start : 4 * (start + capacity)]
                            rows.append((doc, start, len(cut) // 4, zlib.crc32(cut), total))
                columns = zip(*rows, strict=True) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])
        finally:
            gc.enable()

    return texts_of(docs).mapInArrow(tidy(run), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def best_pattern(value: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming over the capacity: the dearest pattern under the prices ``value``.

    ``sizes`` ascend.
    """
    best, took = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), "right")
    for c in range(1, capacity + 1):
        best[c], fits = best[c - 1], fitting[c]
        if fits:
            gain = best[c - sizes[:fits]] + value[:fits]
            k = int(gain.argmax())
            if gain[k] > best[c] + 1e-12:
                best[c], took[c] = gain[k], k
    pattern, c = np.zeros(len(sizes), np.int64), capacity
    while c > 0:
        if took[c] < 0:
            c -= 1
        else:
            pattern[took[c]] += 1
            c -= sizes[took[c]]
    return float(best[capacity]), pattern


def cutting_stock(sizes: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 5000, gap: float = GAP) -> list[tuple[int, np.ndarray]]:
    """(copies, pattern) pairs that hold the whole ``demand``; patterns count pieces per entry of ``sizes``, which ascend.

    No pattern is worth more than the dearest one, so the duals over its worth are prices of a solution that cannot be
    undercut. The search ends where this bound is within ``gap`` of the sequences used, or the same after rounding up.
    """
    n = len(sizes)
    if not n:
        return []
    columns = np.diag(capacity // sizes).astype(float)  # the basis, a column a pattern
    inverse, least = np.diag(1 / np.diag(columns)), 0.0
    for _ in range(rounds):
        duals = inverse.sum(axis=0)
        worth, pattern = best_pattern(duals, sizes, capacity)
        used = float(duals @ demand)
        least = max(least, used / max(worth, 1.0))
        if worth <= 1 + 1e-9 or used - least <= gap * used or np.ceil(used - 1e-6) <= np.ceil(least - 1e-6):
            break
        direction, level = inverse @ pattern, inverse @ demand
        ratio = np.where(direction > 1e-10, level / np.where(direction > 1e-10, direction, 1), np.inf)
        out = int(ratio.argmin())
        columns[:, out] = pattern
        row = inverse[out] / direction[out]
        inverse = inverse - np.outer(direction, row)
        inverse[out] = row
    use = np.floor(np.maximum(np.linalg.solve(columns, demand), 0) + 1e-9).astype(np.int64)
    patterns = columns.round().astype(np.int64)
    chosen = [(int(use[j]), patterns[:, j]) for j in range(n) if use[j]]
    left = demand - patterns @ use
    open_bins: list[list] = []  # first-fit decreasing of what rounding left
    for k in np.argsort(-sizes):
        for _ in range(max(0, int(left[k]))):
            place = next((b for b in open_bins if b[0] >= sizes[k]), None)
            if place is None:
                open_bins.append(place := [capacity, np.zeros(n, np.int64)])
            place[0] -= sizes[k]
            place[1][k] += 1
    return chosen + [(1, pattern) for _, pattern in open_bins]


def slot_table(sizes: np.ndarray, solution: list[tuple[int, np.ndarray]]) -> list[tuple[int, int, int, int, int]]:
    """(size, first rank, rank after the last, first sequence, pieces of this size in a sequence)."""
    rows, used, sequence = [], np.zeros(len(sizes), np.int64), 0
    for copies, pattern in solution:
        for k in np.flatnonzero(pattern):
            rows.append((int(sizes[k]), int(used[k]), int(used[k] + copies * pattern[k]), sequence, int(pattern[k])))
            used[k] += copies * pattern[k]
        sequence += copies
    return rows


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, step: int = STEP) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``; sequences take at most ``capacity`` ids."""
    spark = docs.sparkSession
    cut = stored(pieces(docs, tokenizer, capacity).withColumn("size", F.ceil(F.col("length") / step).cast("int")), "pieces")
    histogram = {r["size"]: r["count"] for r in cut.groupBy("size").count().collect()}  # at most capacity / step rows
    sizes = np.array(sorted(histogram), np.int64)
    demand = np.array([histogram[int(s)] for s in sizes], np.int64)
    slots = spark.createDataFrame(
        slot_table(sizes, cutting_stock(sizes, demand, capacity // step)),
        "size int, first long, after long, sequence long, each long")
    ranked = hash_rank(cut, ["doc_id", "start"], by="size", out="rank").withColumn("rank", F.col("rank") - 1)
    placed = ranked.join(F.broadcast(slots), "size").filter("rank >= first and rank < after").withColumn(
        "sequence_id", F.col("sequence") + ((F.col("rank") - F.col("first")) / F.col("each")).cast("long"))
    before = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "rank").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
