"""Toxicity by a noisy-channel model: restore disguised words, then score the restored text.

*Channel.* A word that mixes letters with look-alike signs, repeats a letter three times or more, or is spelled with
separators or blanks between its letters, is a lattice: each sign may stand for itself, for a letter it looks like, or
for nothing (separators and further repeats), at a price. A Viterbi search over the lattice finds the letters of highest
price-corrected probability under a character trigram model of the training texts.

*Score.* A restored word and its prefixes of four to six letters carry the log ratio of the shares of toxic and clean
training documents that hold them. The two weightiest words of the whole text are added up and a logistic curve turns the
sum into a score from 0 to 1.

Everything is learned from labelled rows only, from all of them but the held-out ones; tasks send on what they have counted
once it is ``COUNTED`` names, so memory does not grow with the rows. The model that is sent to the tasks holds at most
``MAX_FEATURES`` words and ``MAX_TRIGRAMS`` trigrams.

A null text counts as empty; an empty text has evidence 0. Without usable labels (no row, or one class only) every score
is 0. Repeated rows are scored one by one; repeated training texts count once. Labels that are null are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, crc_of_id, stored, texts_of, tidy

MAX_FEATURES, MAX_TRIGRAMS, THRESHOLD = 20_000, 50_000, 0.7
PREFIXES = (4, 5, 6)
#: Letters that a sign may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l", "¡": "i",
}
SEPARATORS = ".-_*~,'/\\"
SWAP_COST, DROP_COST, SEPARATOR_COST, REPEAT_COST = 0.5, 6.0, 0.2, 0.2
REMEMBERED, COUNTED = 80_000, 300_000

_LETTER = re.compile(r"[^\W\d_]")
_REPEAT = re.compile(r"(.)\1\1")
_EDGE = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "@$") + "¿¡«»„“”‘’…–—"


class CharModel:
    """log P(letter | two before), add-half smoothed; ``^`` opens and ``$`` closes a word."""

    def __init__(self, trigrams: dict[str, int]) -> None:
        self.count, self.context = trigrams, Counter()
        for gram, n in trigrams.items():
            self.context[gram[:2]] += n
        self.letters = len({g[2] for g in trigrams}) + 1

    def log(self, before: str, letter: str) -> float:
        return math.log((self.count.get(before + letter, 0) + 0.5) / (self.context.get(before, 0) + 0.5 * self.letters))


def trigrams_of(word: str) -> Iterator[str]:
    padded = f"^^{word}$"
    return (padded[i : i + 3] for i in range(len(padded) - 2))


def decode(source: str, model: CharModel) -> str:
    """The likeliest letters behind ``source``, in time and memory that grow with its length."""
    # A state, the last two letters, holds its score and (letters before, letter): a chain instead of a copy of the text.
    best: dict[str, tuple[float, tuple | None]] = {"^^": (0.0, None)}
    for i, sign in enumerate(source):
        options = []
        if _LETTER.match(sign):
            options.append((sign, 0.0))
            if i and source[i - 1] == sign:
                options.append(("", REPEAT_COST))
        else:
            options += [(letter, SWAP_COST) for letter in LOOKS_LIKE.get(sign, "")]
            options.append(("", SEPARATOR_COST if sign in SEPARATORS or sign.isspace() else DROP_COST))
            if i and source[i - 1] == sign:
                options.append(("", REPEAT_COST))
        step: dict[str, tuple[float, tuple | None]] = {}
        for before, (score, text) in best.items():
            for letter, cost in options:
                after = before[1] + letter if letter else before
                total = score - cost + (model.log(before, letter) if letter else 0.0)
                if after not in step or total > step[after][0]:
                    step[after] = (total, (text, letter) if letter else text)
        best = step
    ends = [(score + model.log(before, "$"), text) for before, (score, text) in best.items()]
    top = max(score for score, _ in ends)
    return max(_letters(text) for score, text in ends if score == top)


def _letters(chain: tuple | None) -> str:
    found = []
    while chain is not None:
        chain, letter = chain
        found.append(letter)
    return "".join(reversed(found))


def bare(token: str) -> str:
    return token.strip(_EDGE).rstrip("@$")


def disguised(word: str) -> bool:
    """Whether ``word`` (lower case, without marks at its ends) needs the lattice."""
    if not _LETTER.search(word):
        return False
    if not word.isalpha():
        letters = sum(c.isalpha() for c in word)
        signs = sum(c in LOOKS_LIKE for c in word)
        parted = sum(c in SEPARATORS for c in word)
        return bool(signs and letters >= 2 and signs <= letters + 1) or bool(parted >= 2 and 2 * parted >= letters - 1)
    return bool(_REPEAT.search(word))


def spelled_out(words: list[str]) -> Iterator[str]:
    """Runs of four or more one-character words, joined by blanks."""
    if sum(len(w) == 1 for w in words) < 4:
        return
    run: list[str] = []
    for w in [*words, "  "]:
        if len(w) == 1:
            run.append(w)
        else:
            if len(run) >= 4:
                yield " ".join(run)
            run = []


def features(word: str) -> Iterator[str]:
    yield word
    for n in PREFIXES:
        if len(word) > n:
            yield word[:n] + "*"


class Evidence(dict):
    """Weight of a word's restored form, worked out once per task."""

    def __init__(self, weights: dict[str, float], model: CharModel) -> None:
        super().__init__()
        self.weights, self.model = weights, model

    def __missing__(self, token: str) -> float:
        word = bare(token)
        if disguised(word):
            word = decode(word, self.model)
        found = max((self.weights.get(f, 0.0) for f in features(word)), default=0.0)
        if len(self) >= REMEMBERED:
            self.clear()  # frequent words come back at once
        self[token] = found
        return found

    def of(self, text: str) -> float:
        words = text.lower().split()
        found = [e for w in set(words) if (e := self[w])]
        for run in spelled_out(words):
            word = decode(run, self.model)
            found.append(max((self.weights.get(f, 0.0) for f in features(word)), default=0.0))
        return sum(sorted(found)[-2:])


def count_features(labelled: DataFrame) -> DataFrame:
    """(feature, toxic documents, clean documents); character trigrams start with a blank and count words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic, clean, words = Counter(), Counter(), Counter()

        def counted() -> Iterator[pa.RecordBatch]:
            for word, n in words.items():
                for gram in trigrams_of(word):
                    clean[" " + gram] += n
            names = list(toxic.keys() | clean.keys())
            for at in range(0, len(names), 50_000):
                part = names[at : at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(part, pa.string()), pa.array([toxic[f] for f in part], pa.int64()), pa.array([clean[f] for f in part], pa.int64())],
                    names=["feature", "toxic", "clean"])
            for counts in (toxic, clean, words):
                counts.clear()

        for batch in batches:
            for text, label in zip(column(batch, "text"), column(batch, "toxic").to_pylist(), strict=True):
                own = {bare(w) for w in text.as_py().lower().split()}
                words.update(w for w in own if w.isalpha())
                (toxic if label else clean).update({f for w in own if w for f in features(w)})
                if len(toxic) + len(clean) >= COUNTED:
                    yield from counted()
        yield from counted()

    parts = labelled.select("text", "toxic").mapInArrow(tidy(run), "feature string, toxic long, clean long")
    return parts.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def fit_curve(points: DataFrame) -> tuple[float, float]:
    """Slope and intercept of a lightly penalised logistic curve through (evidence, toxic, rows), by Newton steps of one pass each."""
    beta, penalty = np.zeros(2), np.diag([0.5, 0.05])
    x, y, n = F.col("evidence"), F.col("toxic"), F.col("rows")
    for _ in range(60):
        z = F.greatest(F.lit(-30.0), F.least(F.lit(30.0), F.lit(float(beta[0])) * x + F.lit(float(beta[1]))))
        p = 1 / (1 + F.exp(-z))
        pull, spread = n * (y - p), n * (p * (1 - p) + 1e-9)
        g0, g1, h00, h01, h11 = points.agg(*[F.sum(v) for v in (pull * x, pull, spread * x * x, spread * x, spread)]).first()
        step = np.linalg.solve(np.array([[h00, h01], [h01, h11]]) + penalty, np.array([g0, g1]) - penalty @ beta)
        beta += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(beta[0]), float(beta[1])


class ToxicModel:
    def __init__(self, weights: dict[str, float], trigrams: dict[str, int], slope: float, intercept: float) -> None:
        self.weights, self.trigrams, self.slope, self.intercept = weights, trigrams, slope, intercept

    def evidence(self) -> Evidence:
        return Evidence(self.weights, CharModel(self.trigrams))

    def score(self, evidence: float) -> float:
        if not self.weights:
            return 0.0
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.slope * evidence + self.intercept))))


def train(docs: DataFrame, labels: DataFrame) -> ToxicModel:
    """Learn from all labelled rows with crc32(doc_id as text) mod 3 other than 1."""
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).filter(
        F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & (crc_of_id() % 3 != 1))
    marked = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    given = texts_of(docs).filter(crc_of_id() % 3 != 1).withColumn("digest", F.sha2("text", 256))
    # Copies are found by their digests, so texts are shuffled once; the labels grow with the input and are not broadcast.
    chosen = given.select("doc_id", "digest").join(marked.hint("merge"), "doc_id").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.max("toxic").alias("toxic"))
    labelled = given.join(chosen.hint("merge"), ["doc_id", "digest"]).groupBy("doc_id", "digest").agg(
        F.first("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")
    labelled = stored(labelled, "labelled")
    sizes = dict(labelled.groupBy("toxic").count().collect())
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return ToxicModel({}, {}, 0.0, 0.0)
    counted = stored(count_features(labelled), "toxic-features")
    ratio = F.log((F.col("toxic") + 0.5) / (n_toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (n_clean + 1.0))
    support = max(3, math.ceil(0.005 * n_toxic))
    kept = counted.filter(~F.col("feature").startswith(" ") & (F.col("toxic") >= support)).withColumn("weight", ratio).filter("weight >= 2.5")
    weights = {r["feature"]: r["weight"] for r in kept.orderBy(F.desc("weight"), "feature").limit(MAX_FEATURES).collect()}
    grams = counted.filter(F.col("feature").startswith(" ")).orderBy(F.desc("clean"), "feature").limit(MAX_TRIGRAMS).collect()
    model = ToxicModel(weights, {r["feature"][1:]: r["clean"] for r in grams}, 0.0, 0.0)
    seen = labelled.select(F.lit(0).cast("long").alias("doc_id"), "text", "toxic")
    points = evidence_of(seen, model, "toxic").groupBy("toxic", "evidence").agg(F.count(F.lit(1)).alias("rows"))
    model.slope, model.intercept = fit_curve(stored(points, "toxic-points"))
    return model


def evidence_of(docs: DataFrame, model: ToxicModel, *keep: str) -> DataFrame:
    """``keep`` columns with ``evidence`` and ``score`` of ``text``."""
    fields = [f.simpleString().replace(":", " ", 1) for f in docs.select(*keep).schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = model.evidence()
        for batch in batches:
            found = [evidence.of(text.as_py() or "") for text in column(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [*(column(batch, k) for k in keep), pa.array(found, pa.float64()), pa.array([model.score(e) for e in found], pa.float64())],
                names=[*keep, "evidence", "score"])

    return docs.mapInArrow(tidy(run), ", ".join([*fields, "evidence double", "score double"]))


def classify(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted per document."""
    return evidence_of(texts_of(docs), model, "doc_id").select(
        "doc_id", (crc_of_id() % 3 == 1).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def reject(docs: DataFrame, model: ToxicModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not predicted toxic."""
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = model.evidence()
        for batch in batches:
            keep = [model.score(evidence.of(text.as_py() or "")) < threshold for text in column(batch, "text")]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(tidy(run), schema)
