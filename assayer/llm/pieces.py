"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie of pieces with log scores.

A text's blanks become the marker U+2581, one more marker goes before it, and the segmentation of highest total score is
taken; of equal ones that with the longer last piece, from the end. A character that is no piece of its own may be spelled by
its UTF-8 bytes at ``UNKNOWN`` below the least score. Decoding puts pieces and bytes together, turns markers into blanks and
takes the first away; it gives back every text exactly (a marker that stands in the text itself is spelled by bytes).

The trie over UTF-8 bytes is built once, on the driver, and sent along: its size is that of the model file. No piece holds a
marker after another character, nor a line feed, so a text falls into chunks that are segmented apart; a task remembers those it
has met and works the new ones of many texts out at a time, depth by depth of the trie and position by position of Viterbi.

Null and empty texts have no ids. Repeated rows give repeated rows, empty tables empty results; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import column, texts_of

MARK, UNKNOWN, REMEMBERED = "▁", 10.0, 300_000
#: A marker of the text itself is kept as this lone surrogate, which no text holds, until it is spelled by bytes.
OWN_MARK = "\udc81"


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class DoubleArray:
    """A trie in two arrays: ``base[state] + byte + 1`` is the next state if its ``check`` is ``state``."""

    def __init__(self, keys: dict[bytes, int]) -> None:
        tree: dict[int, dict[int, int]] = {0: {}}
        ends: dict[int, int] = {}
        for key, value in keys.items():
            node = 0
            for byte in key:
                if byte not in tree[node]:
                    tree[len(tree)] = {}
                    tree[node][byte] = len(tree) - 1
                node = tree[node][byte]
            ends[node] = value
        size = 2 * len(tree) + 1024
        self.base, self.check, self.value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        taken = bytearray(size)
        taken[0] = 1
        place, free, todo = {0: 0}, 1, [0]
        while todo:
            node = todo.pop()
            if node in ends:
                self.value[place[node]] = ends[node]
            children = tree[node]
            if not children:
                continue
            low = min(children)
            while taken[free]:
                free += 1
            at = free
            while True:
                base = at - low - 1
                if base >= 0 and not any(taken[base + b + 1] for b in children):
                    break
                at = taken.find(0, at + 1)
                if at < 0 or at + 257 >= len(taken):
                    grow = len(taken)
                    taken.extend(bytes(grow))
                    self.base, self.check, self.value = (np.concatenate([x, np.full(grow, fill, np.int32)]) for x, fill in ((self.base, 0), (self.check, -1), (self.value, -1)))
                    at = at if at >= 0 else grow
            self.base[place[node]] = base
            for byte, child in children.items():
                place[child] = base + byte + 1
                taken[base + byte + 1] = 1
                self.check[base + byte + 1] = place[node]
                todo.append(child)


class PieceModel:
    """Pieces, scores and trie of a model file; small enough to be sent to the tasks."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        count = model.get_piece_size()
        plain = [i for i in range(count) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        spelled = {i: int(model.id_to_piece(i)[3:-1], 16) for i in range(count) if model.is_byte(i)}
        self.score = np.full(count, -np.inf)
        self.score[plain] = [model.get_score(i) for i in plain]
        self.least = float(self.score[plain].min()) - UNKNOWN
        self.byte_id = np.zeros(256, np.int64)
        self.output = [b""] * count
        for i, byte in spelled.items():
            self.byte_id[byte], self.output[i] = i, bytes([byte])
        for i in plain:
            self.output[i] = model.id_to_piece(i).replace(MARK, " ").encode()
        pieces = {model.id_to_piece(i).encode(): i for i in reversed(plain)}
        self.trie, self.longest = DoubleArray(pieces), max(map(len, pieces))
        if any(MARK in p.decode().lstrip(MARK) or b"\n" in p for p in pieces):
            raise ValueError("pieces that reach over blanks or line feeds are not supported")

    def segment(self, chunks: list[bytes]) -> list[bytes]:
        """Best ids of each chunk as little-endian unsigned 16-bit or 32-bit numbers."""
        length = np.array([len(c) for c in chunks], np.int64)
        text = np.frombuffer(b"".join(chunks), np.uint8)
        n, first = len(text), np.cumsum(length) - length
        whose = np.repeat(np.arange(len(chunks)), length)
        stop = (first + length)[whose]
        start = np.flatnonzero((text & 0xC0) != 0x80)  # characters begin here
        nxt = np.append(start[1:], n)
        edges: list[tuple] = []
        at, state = start, np.zeros(len(start), np.int64)
        single = np.zeros(n, bool)
        width = np.zeros(n, np.int64)
        width[start] = nxt - start
        for depth in range(self.longest):
            inside = at + depth < stop[at]
            at, state = at[inside], state[inside]
            step = self.trie.base[state].astype(np.int64) + text[at + depth] + 1
            good = self.trie.check[step] == state
            at, state = at[good], step[good]
            if not len(at):
                break
            value = self.trie.value[state]
            ends = value >= 0
            edges.append((at[ends], at[ends] + depth + 1, value[ends], self.score[value[ends]]))
            alone = at[ends & (width[at] == depth + 1)]
            single[alone] = True
        lone = start[~single[start]]
        edges.append((lone, lone + width[lone], np.full(len(lone), -1), np.full(len(lone), self.least)))
        begin, end, piece, score = (np.concatenate(x) for x in zip(*edges, strict=True))
        chunk = whose[begin]
        order = np.lexsort((begin, chunk, end - first[chunk]))
        begin, end, piece, score, chunk = begin[order], end[order], piece[order], score[order], chunk[order]
        reach = end - first[chunk]
        best = np.full(n + len(chunks) + 1, -np.inf)  # a place more per chunk: its end
        shift = chunk
        best[first + np.arange(len(chunks))] = 0.0
        back_piece, back_from = np.full(len(best), -2, np.int64), np.zeros(len(best), np.int64)
        cuts = np.flatnonzero(np.diff(reach, prepend=-1))
        for a, b in zip(cuts, [*cuts[1:], len(reach)], strict=True):
            total = best[begin[a:b] + shift[a:b]] + score[a:b]
            target = end[a:b] + shift[a:b]
            groups = np.flatnonzero(np.diff(target, prepend=-1))
            top = np.maximum.reduceat(total, groups)
            winner = np.flatnonzero(total == np.repeat(top, np.diff([*groups, b - a])))
            _, lead = np.unique(target[winner], return_index=True)
            winner = winner[lead]
            best[target[winner]] = total[winner]
            back_piece[target[winner]], back_from[target[winner]] = piece[a:b][winner], begin[a:b][winner] + shift[a:b][winner]
        pieces, sources, out = back_piece.tolist(), back_from.tolist(), []
        for k, (chunk_bytes, low) in enumerate(zip(chunks, first.tolist(), strict=True)):
            place, bottom, ids = low + k + len(chunk_bytes), low + k, []
            while place > bottom:
                source = sources[place]
                if pieces[place] >= 0:
                    ids.append(pieces[place])
                else:
                    spelled = chunk_bytes[source - bottom : place - bottom].decode("utf-8", "surrogatepass").replace(OWN_MARK, MARK).encode()
                    ids += [int(self.byte_id[b]) for b in reversed(spelled)]
                place = source
            out.append(np.array(ids[::-1], "<u4").tobytes())
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.output.__getitem__, ids.tolist()))[1:]


class PieceEncoder:
    """``encode`` of many texts, with the ids of each chunk remembered."""

    def __init__(self, model: PieceModel) -> None:
        self.model, self.known = model, {}

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        if MARK in text:
            text = text.replace(MARK, OWN_MARK)
        if "  " in text or text[0] == " ":
            return re.findall(f"{MARK}+[^{MARK}\n]*|\n[^{MARK}\n]*", MARK + text.replace(" ", MARK))
        return text.replace("\n", " \n").split(" ")

    def encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known, split = self.known, [self.chunks(t) for t in texts]
        new = [c for c in set().union(*split) if c not in known]
        if new:
            marked = [(c if c[:1] in ("\n", MARK) else MARK + c).encode("utf-8", "surrogatepass") for c in new]
            known.update(zip(new, self.model.segment(marked), strict=True))
        for parts in split:
            yield np.frombuffer(b"".join([known[c] for c in parts]), "<u4")


def encoded(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id and the whole text's ids."""
    return _encode(docs, model_path, digest=False)


def digests(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id, n_ids, ids_crc32 (of unsigned 32-bit ids), n_bytes (ids that spell bytes) and whether decoding gives the text back."""
    return _encode(docs, model_path, digest=True)


def _encode(docs: DataFrame, model_path: str | None, digest: bool) -> DataFrame:
    model = PieceModel(model_path or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, spelled = PieceEncoder(model), np.isin(np.arange(len(model.output)), model.byte_id)
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                ids_of, texts = column(part, "doc_id"), column(part, "text").to_pylist()
                ids = list(encoder.encode(texts))
                if digest:
                    yield pa.RecordBatch.from_arrays(
                        [ids_of, pa.array([len(x) for x in ids], pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64()),
                         pa.array([int(spelled[x].sum()) for x in ids], pa.int64()),
                         pa.array([model.decode(x) == t.encode() for x, t in zip(ids, texts, strict=True)], pa.bool_())],
                        names=["doc_id", "n_ids", "ids_crc32", "n_bytes", "restored"])
                else:
                    yield pa.RecordBatch.from_arrays([ids_of, pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    schema = "doc_id long, n_ids long, ids_crc32 long, n_bytes long, restored boolean" if digest else "doc_id long, ids array<int>"
    return texts_of(docs).mapInArrow(run, schema)


def decoded(ids: DataFrame, model_path: str | None = None) -> DataFrame:
    """doc_id and the text that its ids spell; null ids give an empty text."""
    model = PieceModel(model_path or default_model())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [model.decode(np.array(x or [], np.int64)).decode("utf-8", "replace") for x in column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return ids.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")
