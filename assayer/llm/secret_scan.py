"""Secret scans: an Aho-Corasick pass over the text, anchored regular expressions at its hits, then checksums.

Kinds, in the order in which they are listed: ``assign``, ``access`` and ``hex`` (base kinds, leftmost and not
overlapping within a kind), then ``github`` and ``npm`` tokens, whose last six characters must be the base-62 CRC-32 of
the thirty before them, and ``jwt``, whose first part must decode to a JSON object with "alg".

The automaton holds the words that open an assignment, token prefixes, and all strings of four hexadecimal digits: a run
of 24 digits begins with one. No expression is searched for in the text; each is matched at the place of a hit only.

A null text counts as empty and has no spans; empty tables give empty results; repeated rows give repeated rows; other
columns are not read by ``scan`` and stay as they are in ``redact``.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import zlib
from collections.abc import Iterator
from itertools import product

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, texts_of

KINDS = ("assign", "access", "hex", "github", "npm", "jwt")
OPENERS = ("password", "passwd", "secret", "token", "apikey", "api_key")
#: Prefixes and alphabet of the tokens that carry a CRC-32.
GITHUB = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
MASK = "[SECRET]"
SCAN_SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def crc_base62(text: str) -> str:
    value, out = zlib.crc32(text.encode()), ""
    while value:
        value, digit = divmod(value, 62)
        out = BASE62[digit] + out
    return out.rjust(6, "0")


def valid_jwt(text: str) -> bool:
    head = text.split(".")[0]
    try:
        found = json.loads(base64.urlsafe_b64decode(head + "=" * (-len(head) % 4)))
    except ValueError:
        return False
    return isinstance(found, dict) and "alg" in found


class Scanner:
    """``spans(text)`` lists (kind number, start, end) in code points, by start and then kind."""

    def __init__(self) -> None:
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for digits in product("0123456789abcdef", repeat=4):
            self.automaton.add_word("".join(digits), ("hex", 4))
        for kind, words in (("assign", OPENERS), ("access", ("akia",)), ("github", GITHUB), ("npm", ("npm_",)), ("jwt", ("eyj",))):
            for word in words:
                self.automaton.add_word(word, (kind, len(word)))
        self.automaton.make_automaton()
        # Matched against the text with A-Z in lower case.
        self.assign = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""")
        self.access = re.compile(r"AKIA[A-Z0-9]+")
        self.hex = re.compile(r"[0-9a-f]+")
        self.github = re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
        self.npm = re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])")
        self.jwt = re.compile(r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
        self.lower = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        folded = text.encode("utf-8", "surrogatepass").translate(self.lower).decode("utf-8", "surrogatepass")
        hits: dict[str, list[int]] = {}
        for end, (kind, size) in self.automaton.iter(folded):
            hits.setdefault(kind, []).append(end - size + 1)
        found = []
        for number, kind in enumerate(KINDS):
            over = 0
            pattern, where = getattr(self, kind), folded if kind == "assign" else text
            for start in sorted(hits.get(kind, ())):
                if start < over or not (match := pattern.match(where, start)):
                    continue
                over = match.end()
                if self.holds(kind, match):
                    found.append((number, start, over))
        return sorted(found, key=lambda x: (x[1], x[0]))

    def holds(self, kind: str, match: re.Match) -> bool:
        if kind == "assign":
            return len(match[1]) >= 6
        if kind in ("access", "hex"):
            return len(match[0]) >= {"access": 20, "hex": 24}[kind]
        if kind == "jwt":
            return valid_jwt(match[0])
        body = match[0][4:]
        return crc_base62(body[:30]) == body[30:]


def listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{start}:{end}" for k, start, end in spans)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, a digest of the base spans and all spans as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            counts, digests, spans = [], [], []
            for text in column(batch, "text"):
                found = scanner.spans(text.as_py())
                kinds = [k for k, _, _ in found]
                counts.append([kinds.count(k) for k in range(3)])
                digests.append(hashlib.sha256(listed([x for x in found if x[0] < 3]).encode()).hexdigest())
                spans.append(listed(found))
            numbers = [pa.array([c[k] for c in counts], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [column(batch, "doc_id"), *numbers, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return texts_of(docs).mapInArrow(run, SCAN_SCHEMA)


def masked(text: str, spans: list[tuple[int, int, int]], mask: str = MASK) -> str:
    """``text`` with each maximal run of span characters replaced by ``mask``."""
    out, at = [], 0
    for _, start, end in spans:
        if end <= at:
            continue
        if start > at or not out:
            out += [text[at:start], mask]
        at = end
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs``; secrets in ``text`` become ``[SECRET]``. Rows without any keep their text."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner()
        for batch in batches:
            at = batch.schema.get_field_index(text)
            new = []
            for value in batch.column(at):
                value = value.as_py()
                found = scanner.spans(value) if value else []
                new.append(masked(value, found) if found else value)
            arrays = list(batch.columns)
            arrays[at] = pa.array(new, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

    return docs.mapInArrow(run, schema).select([F.col(f"`{c}`") for c in docs.columns])
