"""Katz backoff: Good-Turing discounted n-gram counts with exactly normalised backoff weights.

The corpus is turned into *groups* of about ``GROUP`` tokens, stored once as numbers. N-grams are 64-bit hashes. A group
asks for the facts it needs about its distinct n-grams: it sends their hashes, with its own training counts, to the
*buckets*, ranges of the hash space. A bucket adds up what all groups sent for a hash and answers each group in the order of
its request; the answers are tables partitioned by order and bucket. Counts and then, per context, sums over the distinct n-grams
(each counted by the one group that owns it) are exchanged in this way, so a group sends one number per distinct n-gram
however often that occurs, and no n-gram or context is gathered in one place.

    P(w)       = d c(w) / N;                   the rest of the mass is that of one unknown word
    P(w | h)   = d c(h w) / c(h)               if h w was seen in training
               = a(h) P(w | h less its first)  else, and without a(h) if h was not seen
    a(h)       = (1 - sum of P(w | h) over seen w) / (1 - sum of P(w | h less its first) over seen w)

d discounts counts up to ``GOOD_TURING`` by Katz's formula (by one half where the counts of counts do not allow it). A context
without any discounted count keeps one count back, so that a(h) is positive. So the probabilities of all words and the unknown
one add up to 1 in every context.

Null texts count as empty: they have their end token. Rows without doc_id are left out; repeated rows count and are scored one
by one. Without training documents every token has the probability 1 of the unknown word. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WordHasher, column, mix, release, stored, text_chunks, texts_of

ORDER, GROUP, BUCKET, GOOD_TURING = 2, 1_000_000, 750_000, 5
STEP, END, START = np.uint64(0xD6E8FEB86659FD93), np.uint64(0x9B97A5D1F2C3E4B7), np.uint64(0x5851F42D4C957F2D)
ROW = "g long, kind string, idx int, data binary"


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as compressed bytes, bytes of equal rank side by side."""
    import zstandard

    head = ";".join(f"{a.dtype.str},{len(a)}" for a in arrays).encode()
    body = b"".join(np.ascontiguousarray(np.frombuffer(np.ascontiguousarray(a).tobytes(), np.uint8).reshape(len(a), a.dtype.itemsize).T).tobytes() for a in arrays)
    return zstandard.ZstdCompressor(level=1).compress(len(head).to_bytes(4, "little") + head + body)


def unpacked(data: bytes) -> list[np.ndarray]:
    import zstandard

    data = zstandard.ZstdDecompressor().decompress(data)
    size = int.from_bytes(data[:4], "little")
    out, at = [], 4 + size
    for part in data[4 : 4 + size].decode().split(";"):
        kind, n = part.split(",")
        n, width = int(n), np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, n * width, at).reshape(width, n)
        out.append(np.frombuffer(np.ascontiguousarray(planes.T).tobytes(), kind))
        at += n * width
    return out


def grouped_tokens(docs: DataFrame, held_out: Column, size: int) -> DataFrame:
    """(g, kind, idx, data): each group's words as numbers of its own word list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            hasher, number = WordHasher(), TaskContext.get().partitionId() << 32
            hashes, ids, sizes, held = [], [], [], []

            def flush() -> pa.RecordBatch:
                nonlocal number
                words, at, counts = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
                by_count = np.argsort(-counts, kind="stable")  # frequent words get small numbers
                place = np.empty_like(by_count)
                place[by_count] = np.arange(len(words))
                data = packed(place[at].astype(np.uint32), words[by_count], np.concatenate(ids), np.concatenate(sizes), np.concatenate(held))
                number += 1
                for kept in (hashes, ids, sizes, held):
                    kept.clear()
                return pa.RecordBatch.from_arrays([pa.array([number - 1]), pa.array(["T"]), pa.array([0], pa.int32()), pa.array([data])], names=["g", "kind", "idx", "data"])

            for batch in batches:
                doc, out = column(batch, "doc_id").to_numpy(), column(batch, "held").to_numpy(zero_copy_only=False)
                for row, offsets, data in text_chunks(column(batch, "text")):
                    found, before = hasher.words(offsets, data)
                    n = len(offsets) - 1
                    hashes.append(found)
                    ids.append(doc[row : row + n])
                    sizes.append(np.diff(before).astype(np.int64))
                    held.append(out[row : row + n].astype(bool))
                    if sum(map(len, hashes)) >= size:
                        yield flush()
            if ids:
                yield flush()

    return docs.select("doc_id", "text", held_out.alias("held")).mapInArrow(run, ROW)


class Group:
    """A group's tokens: n-gram hashes, distinct n-grams and contexts by order."""

    def __init__(self, data: bytes, order: int) -> None:
        words, vocabulary, self.doc_ids, sizes, self.held = unpacked(data)
        self.n_docs = len(sizes)
        lead = order - 1  # start marks before each document, an end mark after it
        length = sizes + lead + 1
        first = np.cumsum(length) - length
        line = np.full(int(length.sum()), START)
        mark = np.ones(len(line), bool)
        ends = first + length - 1
        mark[ends] = False
        for k in range(lead):
            mark[first + k] = False
        line[mark] = vocabulary[words]
        line[ends] = END
        self.real = mark
        self.real[ends] = True
        self.doc = np.repeat(np.arange(self.n_docs), length)[self.real]
        self.train = ~self.held[self.doc]
        keys, self.keys, contexts = line, [], []
        for k in range(1, order + 1):
            if k > 1:
                before = np.concatenate([line[:1], keys[:-1]])
                contexts.append(before[self.real])
                keys = mix(before * STEP + line)
            self.keys.append(np.unique(keys[self.real], return_inverse=True))
        self.contexts = [np.unique(c, return_inverse=True) for c in contexts]


def slices(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, slice]]:
    """The part of ascending ``keys`` that each bucket, a range of the hash space, holds."""
    cuts = np.array([(b << 64) // buckets for b in range(1, buckets)], np.uint64)
    at = [0, *np.searchsorted(keys, cuts), len(keys)]
    return ((b, slice(at[b], at[b + 1])) for b in range(buckets) if at[b] < at[b + 1])


def asked(group: Group, g: int, kind: str, keys: np.ndarray, values: list[np.ndarray], buckets: int) -> list[tuple]:
    return [(g, kind, b, packed(keys[s], *(v[s] for v in values))) for b, s in slices(keys, buckets)]


def frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["g", "kind", "idx", "data"])


def met(parts: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Of a bucket's requests: each entry's key number, whether it is its key's first entry, and all columns' sums per key."""
    _, first, at = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_inverse=True)
    owner = np.zeros(len(at), bool)
    owner[first] = True
    return at, owner, [np.bincount(at, np.concatenate([p[c] for p in parts]), len(first)) for c in range(1, len(parts[0]))]


def answered(requests: pd.DataFrame, parts: list[list[np.ndarray]], columns: list[np.ndarray]) -> list[tuple]:
    ends = np.cumsum([len(p[0]) for p in parts])
    return [(g, kind, idx, packed(*(c[end - len(p[0]) : end] for c in columns)))
            for g, kind, idx, p, end in zip(requests["g"], requests["kind"], requests["idx"], parts, ends, strict=True)]


def count_bucket(requests: pd.DataFrame) -> pd.DataFrame:
    """Training counts of the bucket's n-grams for each group, and their counts of counts."""
    parts = [unpacked(d) for d in requests["data"]]
    at, owner, (sums,) = met(parts)
    counts = sums.round().astype(np.int64)
    seen = counts[counts > 0]
    tally = np.concatenate([[len(seen), seen.sum()], np.bincount(np.minimum(seen, GOOD_TURING + 2), minlength=GOOD_TURING + 3)[1 : GOOD_TURING + 2]])
    answer = frame(answered(requests, parts, [counts[at].astype(np.uint32) if not len(counts) or counts.max() < 2**32 else counts[at], owner]))
    answer["tally"] = [tally.tolist() if i == 0 else None for i in range(len(answer))]
    return answer


def context_bucket(requests: pd.DataFrame) -> pd.DataFrame:
    """Backoff weight and count of the bucket's contexts for each group."""
    parts = [unpacked(d) for d in requests["data"]]
    at, _, (count, kept, lower) = met(parts)
    whole = np.where((count > 0) & (kept >= count - 1e-9), count + 1, count)  # keep one back where nothing is discounted
    weight = np.where(count > 0, (1 - kept / np.maximum(whole, 1)) / np.maximum(1 - lower, 1e-300), 1.0)
    return frame(answered(requests, parts, [weight[at], whole.round().astype(np.int64)[at]]))


def discounts(tally: np.ndarray) -> np.ndarray:
    """Good-Turing factors for counts 0 .. GOOD_TURING (the first is unused); 1 beyond."""
    k, n = GOOD_TURING, np.concatenate([[0], tally[2:]]).astype(float)
    factor = np.array([1.0, *((r - 0.5) / r for r in range(1, k + 1))])
    if n[1] > 0 and (shared := (k + 1) * n[k + 1] / n[1]) < 1:
        for r in range(1, k + 1):
            if n[r] > 0:
                d = ((r + 1) * n[r + 1] / (r * n[r]) - shared) / (1 - shared)
                if 0 < d < 1:
                    factor[r] = d
    return factor


class Facts:
    """What a group knows: its answers by kind, put together in key order."""

    def __init__(self, rows: pd.DataFrame, order: int, model: dict) -> None:
        rows = rows.sort_values(["kind", "idx"])
        self.group = Group(rows.loc[rows["kind"] == "T", "data"].iloc[0], order)
        self.model = model
        found: dict[str, list] = {}
        for kind, data in zip(rows["kind"], rows["data"], strict=True):
            if kind != "T":
                found.setdefault(kind, []).append(unpacked(data))
        self.answers = {kind: [np.concatenate(c) for c in zip(*parts, strict=True)] for kind, parts in found.items()}

    def counts(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        counts, owner = self.answers[f"C{k}"]
        return counts.astype(np.int64), owner

    def discounted(self, k: int, counts: np.ndarray) -> np.ndarray:
        factor = self.model["factor"][k - 1]
        return counts * np.where(counts <= GOOD_TURING, factor[np.minimum(counts, GOOD_TURING)], 1.0)

    def probability(self, k: int) -> np.ndarray:
        """P of each token given the k - 1 before it."""
        counts, _ = self.counts(k)
        mine = self.discounted(k, counts)
        if k == 1:
            n = max(1, self.model["tokens"])
            return np.where(counts > 0, mine / n, self.model["unknown"])[self.group.keys[0][1]]
        weight, whole = (x[self.group.contexts[k - 2][1]] for x in self.answers[f"A{k}"])
        at = self.group.keys[k - 1][1]
        return np.where(counts[at] > 0, mine[at] / np.maximum(whole, 1), weight * self.probability(k - 1))


def context_asker(k: int, order: int, model: dict, buckets: int):
    """A group's part of the sums per context of the order ``k``, over the n-grams that it owns."""

    def ask(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        with np.errstate(over="ignore"):
            facts = Facts(rows, order, model)
            own = facts.group
            (keys, at), (contexts, of) = own.keys[k - 1], own.contexts[k - 2]
            counts, owner = facts.counts(k)
            example = np.empty(len(keys), np.int64)
            example[at] = np.arange(len(at))
            mine = owner & (counts > 0)
            context = of[example]
            kept = np.bincount(context[mine], facts.discounted(k, counts)[mine], len(contexts))
            lower = np.bincount(context[mine], facts.probability(k - 1)[example][mine], len(contexts))
            return frame(asked(own, key[0], f"A{k}", contexts, [np.bincount(of, own.train, len(contexts)).astype(np.uint32), kept, lower], buckets))

    return ask


def score(docs: DataFrame, held_out: Column, order: int = ORDER, group: int = GROUP, bucket: int = BUCKET) -> DataFrame:
    """Per document its tokens, the known ones, base score and the model's log10 probability; learns from the others than ``held_out``."""
    spark = docs.sparkSession
    texts = texts_of(docs).filter("doc_id is not null")
    tokens = stored(grouped_tokens(texts, held_out, group), "tokens")
    # Room for the distinct n-grams of a bucket: at most one per byte of two of the stored texts, in fact fewer.
    size = tokens.agg(F.coalesce(F.sum(F.length("data")), F.lit(0))).first()[0]
    buckets = max(1, -(-size // (2 * bucket)))

    def ask_counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with np.errstate(over="ignore"):
            for some in frames:
                for g, data in zip(some["g"], some["data"], strict=True):
                    own = Group(data, order)
                    for k, (keys, at) in enumerate(own.keys, 1):
                        mine = np.bincount(at, own.train, len(keys)).astype(np.uint32)
                        yield frame(asked(own, g, f"C{k}", keys, [mine], buckets))

    requests = tokens.mapInPandas(ask_counts, ROW)
    answers = stored(requests.groupBy("kind", "idx").applyInPandas(count_bucket, ROW + ", tally array<long>"), "ngram-counts")
    release(spark)
    cells = answers.filter("tally is not null").select("kind", F.posexplode("tally").alias("i", "n")).groupBy("kind", "i").agg(F.sum("n").alias("n")).collect()
    tally = np.zeros((order, GOOD_TURING + 3), np.int64)
    for kind, i, n in cells:  # a few numbers per order
        tally[int(kind[1:]) - 1, i] = n
    model = {"factor": [discounts(t) for t in tally], "types": int(tally[0, 0]), "tokens": int(tally[0, 1])}
    first = tally[0].astype(float)
    lost = sum(r * first[1 + r] * (1 - model["factor"][0][r]) for r in range(1, GOOD_TURING + 1))
    if lost == 0 and model["tokens"]:  # no rare word: one count is kept back
        model["tokens_base"], model["tokens"], lost = model["tokens"], model["tokens"] + 1, 1.0
    model["unknown"] = lost / model["tokens"] if model["tokens"] else 1.0
    n_tokens, n_types = model.get("tokens_base", model["tokens"]), model["types"]
    rows = [tokens, answers.drop("tally")]
    for k in range(2, order + 1):
        asking = context_asker(k, order, model, buckets)
        requests = reduce(DataFrame.unionByName, rows).groupBy("g").applyInPandas(asking, ROW)
        rows.append(stored(requests.groupBy("kind", "idx").applyInPandas(context_bucket, ROW), "backoff-weights"))
        release(spark)

    def finish(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
        with np.errstate(over="ignore"):
            facts = Facts(some, order, model)
            own, counts = facts.group, facts.counts(1)[0][facts.group.keys[0][1]]
            add = lambda x: np.bincount(own.doc, x, own.n_docs)
            return pd.DataFrame({
                "doc_id": own.doc_ids, "held_out": own.held, "n_tokens": add(None).astype(np.int64), "n_known": add(counts > 0).astype(np.int64),
                "train_tokens": n_tokens, "base_score": add(np.log10((counts + 0.1) / (n_tokens + 0.1 * (n_types + 1)))),
                "score": add(np.log10(facts.probability(order)))})

    return reduce(DataFrame.unionByName, rows).groupBy("g").applyInPandas(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
