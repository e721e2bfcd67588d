"""BPE encoding and decoding: greedy longest matches are proposed, every adjacent pair is verified, few words are merged.

A text is cut into words by the model's pattern; texts with characters that Python's Unicode tables do not know yet, about which
libraries differ, are cut by the tokenizers library. For words not met before, the longest token that matches at each byte is read
off a trie for all bytes of many words at once, and a word's proposal follows these matches from its start. A proposal is what
merging would give if each two neighbours keep apart when merged alone. That test is made for all pairs at once: the later made
of the two tokens at the border is taken apart, step by step back to single bytes, and the pair falls if at any time a merge
across the border would have come before the one that was taken apart. Only words with a fallen pair are merged exactly, from
their bytes, by rank. A special token of the model that stands in a text is its own id, as the tokenizers library reads it.

The tables come from the tokenizer's file, are built once on the driver and sent along; their size is that of the file. A task
remembers the ids of up to ``REMEMBERED`` short words in each of two generations.

Decoding puts the tokens' bytes together; bytes that are no UTF-8 become U+FFFD.

Null texts count as empty, empty ones have no ids. A null doc_id stays null. Repeated rows give repeated rows, empty tables empty
results; other columns are not read. Words of any length are handled, as stretches of ``STRETCH`` words of a text.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import column, texts_of
from .pieces import DoubleArray

#: The pattern that cuts words in front of byte-level merges, a fixed value of the format.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
REMEMBERED, SHORT, STRETCH, NEVER = 60_000, 64, 50_000, 2**31 - 1


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in files of this format: itself, or the next free one from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def has_rare(text: str) -> bool:
    """True if Python's Unicode tables give no meaning to a character of the text.

    Newer tables, which the tokenizers library and ``regex`` may have, can call such a character a letter, and not both the same way.
    """
    if text.isascii() or text.replace("\n", " ").isprintable():  # quick, and enough for nearly all texts
        return False
    return any(unicodedata.category(c) == "Cn" for c in set(text))


class BpeModel:
    """Tokens, merges and trie of a byte-level tokenizer file, as arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.cutter = json.dumps(spec | {"model": {"type": "BPE", "vocab": {}, "merges": []}, "added_tokens": []})
        model, cutter = spec["model"], spec["pre_tokenizer"]
        if model["type"] != "BPE" or cutter["type"] != "ByteLevel" or not cutter["use_regex"] or cutter["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("not a plain byte-level BPE file")
        if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            raise ValueError("BPE options beyond merges are not supported")
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("special tokens with options are not supported")
        vocab = {t: i for t, i in model["vocab"].items() if t not in self.special}
        size = max([*model["vocab"].values(), *self.special.values()]) + 1
        self.output = [b""] * size
        for token, i in vocab.items():
            self.output[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.output[i] = token.encode()
        self.byte_id = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_id[byte] = vocab[letter]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        a, b, whole = (np.array([vocab[x] for x in part], np.int64) for part in ([m[0] for m in merges], [m[1] for m in merges], [m[0] + m[1] for m in merges]))
        rank = np.arange(len(merges))
        order = np.argsort(a << 32 | b)
        self.pair, self.pair_rank = (a << 32 | b)[order], rank[order]
        self.merged = whole
        self.made, self.left, self.right = np.full(size, -1, np.int64), np.zeros(size, np.int64), np.zeros(size, np.int64)
        for side, value in ((self.made, rank), (self.left, a), (self.right, b)):
            side[whole[::-1]] = value[::-1]  # the first merge that makes a token counts
        if (np.maximum(self.made[a], self.made[b]) >= rank).any():
            raise ValueError("a merge stands before the merges that make its parts")
        # Tokens that merging their own bytes gives back; of others, and of those made in two ways, no proposal is trusted.
        tokens = np.flatnonzero(self.made >= 0)
        sound = np.ones(size, bool)
        sound[tokens] = self.apart(self.left[tokens], self.right[tokens], self.made[tokens])
        sound[np.flatnonzero(np.bincount(whole, minlength=size) > 1)] = False
        for i in tokens[np.argsort(self.made[tokens])].tolist():
            sound[i] &= sound[self.left[i]] & sound[self.right[i]]
        known = np.zeros(size, bool)
        known[self.byte_id], known[tokens] = True, True
        self.sound = sound & known
        self.trie = DoubleArray({self.output[i]: i for i in np.flatnonzero(known).tolist()})
        self.longest = max(len(self.output[i]) for i in np.flatnonzero(known).tolist())

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, ``NEVER`` where there is none."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.pair_rank[at], NEVER)

    def apart(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray | int = NEVER) -> np.ndarray:
        """True for pairs of tokens between which no merge of a rank below ``limit`` takes place.

        Ranks only rise while a word is merged, so going back the later made token is the one to take apart. A merge over the
        border comes first if its rank is below that of the left token's merge, or not above that of the right token's, as of
        equal merges the one further left goes first.
        """
        a, b, limit = a.copy(), b.copy(), np.broadcast_to(limit, len(a)).astype(np.int64)
        fine, at = np.ones(len(a), bool), np.arange(len(a))
        while len(at):
            crossed = self.rank(a, b) < limit
            fine[at[crossed]] = False
            older, newer = self.made[a], self.made[b]
            go = ~crossed & ((older >= 0) | (newer >= 0))
            at, a, b, older, newer = at[go], a[go], b[go], older[go], newer[go]
            of_left = older > newer
            limit = np.where(of_left, older, newer + 1)
            a, b = np.where(of_left, self.right[a], a), np.where(of_left, b, self.left[b])
        return fine

    def propose(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of greedy longest matches for all words, and each token's word."""
        length = np.array([len(w) for w in words], np.int64)
        text = np.frombuffer(b"".join(words), np.uint8)
        first = np.cumsum(length) - length
        room = np.repeat(first + length, length) - np.arange(len(text))
        at, state = np.arange(len(text)), np.zeros(len(text), np.int64)
        step, token = np.ones(len(text), np.int64), self.byte_id[text]
        for depth in range(self.longest):
            inside = room[at] > depth
            at, state = at[inside], state[inside]
            to = self.trie.base[state].astype(np.int64) + text[at + depth] + 1
            good = self.trie.check[to] == state
            at, state = at[good], to[good]
            if not len(at):
                break
            value = self.trie.value[state]
            ends = value >= 0
            step[at[ends]], token[at[ends]] = depth + 1, value[ends]
        taken = np.zeros(len(text), bool)
        place, end = first[length > 0], (first + length)[length > 0]
        while len(place) > 32:  # all words a token on
            taken[place] = True
            place = place + step[place]
            going = place < end
            place, end = place[going], end[going]
        if len(place):  # the few long words left, one by one
            steps = step.tolist()
            for p, e in zip(place.tolist(), end.tolist(), strict=True):
                chosen = []
                while p < e:
                    chosen.append(p)
                    p += steps[p]
                taken[chosen] = True
        return token[taken], np.repeat(np.arange(len(words)), length)[taken]

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: the lowest rank first, of equal ones the one furthest left."""
        ids = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        ranks = self.rank(np.array(ids[:-1], np.int64), np.array(ids[1:], np.int64)).tolist()
        queue = [(r, i, ids[i], ids[i + 1]) for i, r in enumerate(ranks) if r != NEVER]
        heapq.heapify(queue)
        pairs = self.pair_table()
        while queue:
            rank, i, a, b = heapq.heappop(queue)
            j = after[i] if ids[i] == a else n
            if j >= n or ids[j] != b:
                continue  # one of the two is gone
            ids[i], ids[j] = int(self.merged[rank]), -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = pairs.get((ids[i], ids[k]))
                if found is not None:
                    heapq.heappush(queue, (found, i, ids[i], ids[k]))
            h = before[i]
            if h >= 0:
                found = pairs.get((ids[h], ids[i]))
                if found is not None:
                    heapq.heappush(queue, (found, h, ids[h], ids[i]))
        return [x for x in ids if x >= 0]

    def merge_all(self, words: list[bytes]) -> list[bytes]:
        """``merge`` of many short words: each round carries out one merge in every word that has one left."""
        length = np.array([len(w) for w in words], np.int64)
        ids, whose = self.byte_id[np.frombuffer(b"".join(words), np.uint8)], np.repeat(np.arange(len(words)), length)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        rank = self.border_ranks(ids, whose, np.arange(len(ids)))
        while len(ids):
            start = np.flatnonzero(np.diff(whose, prepend=-1))
            size = np.diff(start, append=len(ids))
            least = np.minimum.reduceat(rank, start)
            over = np.repeat(least == NEVER, size)
            done.append((ids[over], whose[over]))
            first = np.flatnonzero(~over & (rank == np.repeat(least, size)))
            first = first[np.diff(whose[first], prepend=-1) > 0]
            ids[first] = self.merged[rank[first]]
            stay = ~over
            stay[first + 1] = False
            place = np.cumsum(stay) - 1
            ids, whose, rank, first = ids[stay], whose[stay], rank[stay], place[first]
            changed = np.concatenate([first, first[first > 0] - 1])
            rank[changed] = self.border_ranks(ids, whose, changed)
        ids, whose = (np.concatenate(x) for x in zip(*done, strict=True)) if done else (ids, whose)
        order = np.argsort(whose, kind="stable")
        return packed(ids[order], np.searchsorted(whose[order], np.arange(len(words) + 1)))

    def border_ranks(self, ids: np.ndarray, whose: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Rank of the merge of the ids at ``at`` with the next ones of their words."""
        out, inner = np.full(len(at), NEVER, np.int64), np.flatnonzero(at + 1 < len(ids))
        inner = inner[whose[at[inner]] == whose[at[inner] + 1]]
        out[inner] = self.rank(ids[at[inner]], ids[at[inner] + 1])
        return out

    def pair_table(self) -> dict[tuple[int, int], int]:
        if "_pairs" not in self.__dict__:
            self._pairs = {(k >> 32, k & 0xFFFFFFFF): r for k, r in zip(self.pair.tolist(), self.pair_rank.tolist(), strict=True)}
        return self._pairs

    def segment(self, words: list[bytes]) -> tuple[list[bytes], int]:
        """The ids of each word as little-endian unsigned 32-bit numbers, and how many words had to be merged."""
        token, whose = self.propose(words)
        joint = np.flatnonzero(whose[1:] == whose[:-1])
        pairs, which = np.unique(token[joint] << 32 | token[joint + 1], return_inverse=True)
        fine = self.apart(pairs >> 32, pairs & 0xFFFFFFFF)[which]
        failed = np.zeros(len(words), bool)
        failed[whose[joint[~fine]]] = True
        failed[whose[~self.sound[token]]] = True
        out = packed(token, np.searchsorted(whose, np.arange(len(words) + 1)))
        again = np.flatnonzero(failed).tolist()
        short = [i for i in again if len(words[i]) <= SHORT]
        for i, ids in zip(short, self.merge_all([words[i] for i in short]), strict=True):
            out[i] = ids
        for i in again:
            if len(words[i]) > SHORT:
                out[i] = np.array(self.merge(words[i]), "<u4").tobytes()
        return out, len(again)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.output.__getitem__, ids)).decode("utf-8", "replace")


def packed(ids: np.ndarray, cuts: np.ndarray) -> list[bytes]:
    """The ids between each two cuts as little-endian unsigned 32-bit numbers."""
    data, at = ids.astype("<u4").tobytes(), (4 * cuts).tolist()
    return [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


class BpeEncoder:
    """``encode`` of texts, with the ids of short words remembered."""

    def __init__(self, model: BpeModel) -> None:
        self.model, self.words = model, regex.compile(WORDS)
        special = "|".join(regex.escape(t) for t in sorted(model.special, key=len, reverse=True))
        self.cut = regex.compile(f"({special})") if special else None
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.merged = self.met = 0

    def learn(self, words: set[str]) -> None:
        """Put the ids of these words into ``young``; words not used for a whole generation are let go."""
        if len(self.young) > REMEMBERED:
            self.young, self.old = {}, self.young
        new = []
        for word in words - self.young.keys():
            ids = self.old.get(word)
            if ids is None:
                new.append(word)
            else:
                self.young[word] = ids
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            ids, merged = self.model.segment([w.encode() for w in part])
            self.merged, self.met = self.merged + merged, self.met + len(part)
            self.young.update(zip(part, ids, strict=True))

    def parts(self, text: str) -> Iterator[list[str] | int]:
        """Stretches of words, and ids of special tokens, in order."""
        for k, plain in enumerate(self.cut.split(text) if self.cut else [text]):
            if k % 2:
                yield self.model.special[plain]
            elif has_rare(plain):
                yield [plain[a:b] for a, b in self.library_cuts(plain)]
            elif len(plain) <= STRETCH:
                yield self.words.findall(plain)
            else:
                met = (m.group() for m in self.words.finditer(plain))
                while stretch := list(itertools.islice(met, STRETCH)):
                    yield stretch

    def library_cuts(self, text: str) -> list[tuple[int, int]]:
        """The words of a text with rare characters, cut by the tokenizers library itself."""
        if "_library" not in self.__dict__:
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_str(self.model.cutter).pre_tokenizer
        return [at for _, at in self._library.pre_tokenize_str(text)]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = [list(self.parts(text)) for text in texts]
        words = set().union(*(p for parts in split for p in parts if not isinstance(p, int)))
        self.learn(words)
        known, out = self.young, []
        for parts in split:
            data = [np.array([p], "<u4").tobytes() if isinstance(p, int) else b"".join(map(known.__getitem__, p)) for p in parts]
            out.append(np.frombuffer(b"".join(data), "<u4"))
        for word in [w for w in words if len(w) > SHORT]:
            del known[word]
        return out


def slices(batch: pa.RecordBatch, rows: int = 64, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch of at most ``rows`` rows and about ``size`` bytes of text, one row at least."""
    length = np.cumsum([0, *pa.compute.binary_length(column(batch, "text")).to_pylist()])
    at = 0
    while at < batch.num_rows:
        end = int(np.searchsorted(length, length[at] + size, "right")) - 1
        end = max(at + 1, min(end, at + rows, batch.num_rows))
        yield batch.slice(at, end - at)
        at = end


def _encode(docs: DataFrame, tokenizer: str | None, schema: str, columns) -> DataFrame:
    model = BpeModel(tokenizer or default_tokenizer())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BpeEncoder(model)
        for batch in batches:
            for part in slices(batch):
                made = columns(model, encoder.encode(column(part, "text").to_pylist()))
                yield pa.RecordBatch.from_arrays([column(part, "doc_id"), *made.values()], names=["doc_id", *made])

    return texts_of(docs).mapInArrow(run, schema)


def encoded(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and the whole text's ids."""

    def columns(model: BpeModel, found: list[np.ndarray]) -> dict[str, pa.Array]:
        return {"ids": pa.array([ids.astype(np.int32) for ids in found], pa.list_(pa.int32()))}

    return _encode(docs, tokenizer, "doc_id long, ids array<int>", columns)


def digests(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (decimal ids joined by commas) and decoded_sha256 (the text that the ids spell)."""

    def columns(model: BpeModel, found: list[np.ndarray]) -> dict[str, pa.Array]:
        number = [b"%d" % i for i in range(len(model.output))]
        found = [ids.tolist() for ids in found]
        hashed = lambda data: hashlib.sha256(data).hexdigest()
        return {
            "n_tokens": pa.array(map(len, found), pa.int64()),
            "ids_sha256": pa.array([hashed(b",".join(map(number.__getitem__, ids))) for ids in found], pa.string()),
            "decoded_sha256": pa.array([hashed(model.decode(ids).encode()) for ids in found], pa.string())}

    return _encode(docs, tokenizer, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", columns)


def decoded(ids: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """doc_id and the text that its ids spell; null ids give an empty text."""
    model = BpeModel(tokenizer or default_tokenizer())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                texts = [model.decode(x or []) for x in column(part, "ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([column(part, "doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
