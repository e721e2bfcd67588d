"""Centroid clustering, BPE and the filter audit against brute force, with nulls, long texts, ties and clashing columns."""

import hashlib
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from assayer.llm import audit, bpe, simplex
from assayer.llm.common import stored

VECTORS = "vec_id long, embedding array<float>, label int, vector string, apex string, cluster string, distance string"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, hash string, mask string, part string, ids string, n string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], None, "v", None, "c", "d") for i, v in rows], VECTORS)


def documents(spark, rows):
    return spark.createDataFrame([(i, t, None, s, None, "h", "m", "p", "i", "n") for i, t, s in rows], DOCS)


def lloyd(rows, k=8, rounds=10, width=64):
    kept = [(i, np.array([int(np.floor(1024 * float(np.float32(x)))) for x in v], object)) for i, v in rows
            if v is not None and len(v) == width and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted((r for r in kept if r[0] is not None), key=lambda r: (hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), r[1].tolist()))
    centres = [v for _, v in order[:k]]
    far = lambda v, c: int(((v - c) ** 2).sum())
    near = lambda v: min(range(len(centres)), key=lambda j: (far(v, centres[j]), j))
    for _ in range(rounds):
        own = [near(v) for _, v in kept]
        for j in range(len(centres)):
            mine = [v for (_, v), c in zip(kept, own) if c == j]
            if mine:
                centres[j] = np.array([int(sum(x)) // len(mine) for x in zip(*mine)], object)
    out = [(i, near(v), far(v, centres[near(v)])) for i, v in kept]
    inertia = Counter()
    for _, c, d in out:
        inertia[c] += d
    return sorted(((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, centres[c])).encode()).hexdigest()) for i, c, d in out), key=repr)


def clustered(spark, rows, **kw):
    got = simplex.report(simplex.fit(vectors(spark, rows), **kw)).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
    return sorted((tuple(r) for r in got.collect()), key=repr)


def test_clusters_equal_plain_rounds(spark):
    rng = np.random.default_rng(3)
    centre = rng.normal(size=(5, 64))
    rows = [(i, centre[i % 5] + 0.2 * rng.normal(size=64)) for i in range(200)]
    rows += [(1000 + i, rows[0][1]) for i in range(60)]  # a pile of copies
    rows += [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (500, None), (501, [None] * 64), (502, [float("nan")] * 64),
             (503, [float("inf")] * 64), (504, [1.0] * 63), (505, []), (506, [0.0] * 64), (507, [-0.0004] * 64)]
    assert clustered(spark, rows) == lloyd(rows)


def test_clusters_of_few_and_equal_vectors(spark):
    same = [(i, [0.25] * 64) for i in range(20)]
    assert clustered(spark, same) == lloyd(same)
    few = [(7, [1.0] * 64), (8, [-1.0] * 64), (9, [0.5, -0.5] * 32)]
    assert clustered(spark, few) == lloyd(few)
    assert clustered(spark, []) == [] and clustered(spark, [(1, None), (2, [1.0])]) == []
    large = [(i, [float(i * 2**21)] * 32 + [1.0] * 32) for i in range(-12, 12)]  # beyond what doubles hold exactly when squared
    assert [(r[0], r[1], r[5]) for r in clustered(spark, large)] == [(r[0], r[1], r[5]) for r in lloyd(large)]
    huge = [(i, [1e30 * i] * 64) for i in range(-9, 9)]
    assert len(clustered(spark, huge)) == 18


def test_bounds_hold_and_save_comparisons(spark):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(8, 64)) * 400
    points = (centre[rng.integers(0, 8, 3000)] + 100 * rng.normal(size=(3000, 64))).astype(np.int64)
    shape = simplex.Simplex(points[:12], 12)
    lower, upper = simplex.bounds(shape.apex(points[:500]), shape.apex(points[500:520]))
    exact = simplex.squares(points[:500], points[500:520])
    assert (lower <= exact).all() and (exact <= upper).all()
    fitted = simplex.fit(vectors(spark, [(i, p / 1024) for i, p in enumerate(points)]))
    assert fitted.met == 10 * 8 * 3000 and fitted.compared < 0.3 * fitted.met


@pytest.fixture(scope="module")
def coder():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(bpe.default_tokenizer())
    return bpe.BpeModel(bpe.default_tokenizer()), library


TEXTS = [
    None, "", " ", "\n\n  x", "Hello world", "Hello world", "don't we'll I'VE 's", "aaaaaaaaaaaaaaaaaaaaaaaaaa" * 40, "ab" * 70_000, " " * 500 + "end",
    "<|endoftext|>a<|endoftext|><|endoftext|> b<|endoftext|", "日本語のテキスト、全角。" * 30, "😀👩‍👩‍👧 ẞß ½²³ ١٢٣ ไทย", "x\u0085y z w　﻿​", "\x00\x01\x7f",
    "é é � ", "supercalifragilisticexpialidocious " * 20, "word " * 60_000, "1234567890" * 30, "!?!?----====<<<>>>" * 9]


def test_bpe_equals_the_library(spark, coder):
    model, library = coder
    docs = stored(documents(spark, [(i if i != 4 else None, t, "s") for i, t in enumerate(TEXTS)]), "bpe")
    want = [library.encode(t or "", add_special_tokens=False).ids for t in TEXTS]
    got = {r["doc_id"]: r["ids"] for r in bpe.encoded(docs).collect()}
    assert all(got[i if i != 4 else None] == ids for i, ids in enumerate(want))
    back = {r["doc_id"]: r["text"] for r in bpe.decoded(bpe.encoded(docs)).collect()}
    assert all(back[i if i != 4 else None] == library.decode(ids, skip_special_tokens=False) == (TEXTS[i] or "") for i, ids in enumerate(want))
    hashed = lambda s: hashlib.sha256(s.encode()).hexdigest()
    found = {r["doc_id"]: tuple(r)[1:] for r in bpe.digests(docs).collect()}
    assert all(found[i if i != 4 else None] == (len(ids), hashed(",".join(map(str, ids))), hashed(TEXTS[i] or "")) for i, ids in enumerate(want))
    assert bpe.digests(docs.limit(0)).count() == 0 and bpe.encoded(docs.limit(0)).count() == 0
    odd = spark.createDataFrame([(1, [169]), (2, None), (3, [50256, 0])], "doc_id long, ids array<int>")
    assert {r[0]: r[1] for r in bpe.decoded(odd).collect()} == {1: "�", 2: "", 3: "<|endoftext|>!"}


def test_bpe_on_the_given_table(spark, sf, coder):
    _, library = coder
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    texts = {r["doc_id"]: r["text"] or "" for r in docs.collect()}
    got = {r["doc_id"]: r["ids"] for r in bpe.encoded(docs).collect()}
    assert all(got[i] == library.encode(t, add_special_tokens=False).ids for i, t in texts.items())


def test_proposals_pairs_and_merging_agree(coder):
    model, library = coder
    rng = np.random.default_rng(0)
    words = [bytes(rng.choice(np.frombuffer(b"aaabetionsrth", np.uint8), rng.integers(1, 40))) for _ in range(4000)]
    ids, merged = model.segment(words)
    exact = [model.merge(w) for w in words]
    assert [np.frombuffer(x, "<u4").tolist() for x in ids] == exact == [np.frombuffer(x, "<u4").tolist() for x in model.merge_all(words)]
    assert 0 < merged < len(words)
    token, whose = model.propose(words)
    spelled = [b"".join(model.output[t] for t in token[whose == k]) for k in range(50)]
    assert spelled == words[:50]
    # A pair is apart if and only if the two tokens' bytes, merged alone, give the two tokens back.
    a, b = rng.choice(np.flatnonzero(model.sound), 3000), rng.choice(np.flatnonzero(model.sound), 3000)
    a, b = np.concatenate([a, token[:-1][:2000]]), np.concatenate([b, token[1:][:2000]])
    alone = [model.merge(model.output[x] + model.output[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist())]
    assert model.apart(a, b).tolist() == alone


def test_words_are_cut_as_the_library_cuts(coder):
    """Characters of all kinds, as letter, number, sign or blank, are cut from the same neighbours."""
    model, library = coder
    encoder = bpe.BpeEncoder(model)
    for first in range(0, 0x40000, 4096):
        some = [c for c in range(first, first + 4096, 23) if not 0xD800 <= c < 0xE000]
        text = lambda cs: "\n".join(f"a{chr(c)}a1{chr(c)}1!{chr(c)}! {chr(c)}" for c in cs)
        known = text(c for c in some if not bpe.has_rare(chr(c)))
        assert [at for _, at in library.pre_tokenizer.pre_tokenize_str(known)] == [m.span() for m in encoder.words.finditer(known)]
        rare = text(some)
        assert "".join(w for part in encoder.parts(rare) for w in part) == rare
        if first < 0x3000:
            assert [x.tolist() for x in encoder.encode([rare])] == [library.encode(rare, add_special_tokens=False).ids]


def test_remembered_words_are_let_go(coder, monkeypatch):
    model, library = coder
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    encoder = bpe.BpeEncoder(model)
    rng = np.random.default_rng(1)
    for _ in range(20):
        texts = [" ".join(f"w{x}" for x in rng.integers(0, 300, 40)) + "y" * 100 for _ in range(3)]
        assert [x.tolist() for x in encoder.encode(texts)] == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert max(map(len, encoder.young)) <= bpe.SHORT


def audited(rows, labels):
    first, marks = {}, {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, q, x in labels:
        good, toxic = marks.get(i, (False, False))
        marks[i] = good or q == 1, toxic or x == 1
    counts = Counter()
    for i, t, s in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = "".join(f for f, bad in zip("ABCDE", (
            len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", t)) > 5 * len(t), bool(re.search("[#$%&*|]", t)),
            i is not None and i > first[t])) if bad)
        counts[(s or "", fails, *(marks.get(i, (False, False)) if i is not None else (False, False)))] += 1
    out, shapley = [], Counter()
    for part in {k[0] for k in counts}:
        for order in map("".join, permutations("ABCDE")):
            for k, own in enumerate(order):
                row = Counter()
                for (p, fails, good, toxic), n in counts.items():
                    if p != part:
                        continue
                    gone, bad = set(fails) & set(order[:k]), own in fails
                    row["kept"] += n * (not gone and not bad)
                    row["removed"] += n * (not gone and bad)
                    row["redundant"] += n * bool(gone and bad)
                    row["unique_fails"] += n * (fails == own)
                    row["good_lost"] += n * (not gone and bad and good)
                    row["toxic_lost"] += n * (not gone and bad and toxic)
                shapley[part, own] += row["removed"]
                out.append((part, order, k + 1, *(row[c] for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


@pytest.mark.parametrize("counters", [None, 1 << 15, 64 * 1024 * 8])
def test_audit(spark, counters):
    rng = np.random.default_rng(2)
    text = lambda n, size: " ".join(f"w{x}" for x in rng.integers(0, size, n))
    long = text(30_000, 10**6)
    base = [text(int(rng.integers(1, 90)), int(rng.integers(5, 400))) for _ in range(60)]
    rows = [(i, base[int(rng.integers(0, 60))] + ("#" if i % 7 == 0 else "") + ("ABCDEF" * 3 if i % 11 == 0 else ""), ["web", "book", None, ""][i % 4]) for i in range(200)]
    rows += [(1000 + i, "one text of a third of all rows " * 9, "web") for i in range(120)]
    rows += [(2000, None, "web"), (2001, "", "web"), (2002, " \t\n", None), (2003, long, "book"), (2004, long, "book"), (2005, long + "é日本", "book"),
             (None, base[0], "web"), (None, base[0], "web"), (5, rows[5][1], rows[5][2]), (5, "another text", "web"), (2006, "a b " * 60, "web"), (2007, "é" * 50 + "AB", None)]
    labels = [(i, int(rng.integers(0, 2)), int(rng.integers(0, 2))) for i in range(0, 200, 2)] + [(1001, None, 1), (4, 1, None), (4, 0, 0), (None, 1, 1), (99999, 1, 1)]
    marks = spark.createDataFrame([(*r, "g", "t", "p") for r in labels], "doc_id long, quality int, toxic int, good string, n string, part string")
    got = sorted(tuple(r) for r in audit.audit(documents(spark, rows), marks, counters).collect())
    assert got == audited(rows, labels)
    assert {(r[0]) for r in got} == {"web", "book", ""} and len(got) == 3 * 600


def test_audit_without_rows(spark):
    none = documents(spark, [])
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert audit.audit(none, marks).count() == 0
    one = audit.audit(documents(spark, [(1, None, None)]), marks).collect()
    assert len(one) == 600 and {r["part"] for r in one} == {""}


def test_counting_bloom_clears_only_unique_texts(spark):
    rng = np.random.default_rng(4)
    single, twice = rng.integers(-2**62, 2**62, 5000), rng.integers(-2**62, 2**62, 300)
    hashes = np.concatenate([single, twice, twice, twice[:50]])
    rng.shuffle(hashes)
    whole = audit.CountingBloom(audit.counters_for(len(hashes)))
    whole.add(hashes)
    merged = audit.sketch(spark.createDataFrame(pd.DataFrame({"hash": hashes})).repartition(7), audit.counters_for(len(hashes)))
    assert (whole.once == merged.once).all() and (whole.more == merged.more).all()
    assert merged.repeated(twice).all() and merged.repeated(single).mean() < 0.01
    assert audit.counters_for(10**12) == audit.COUNTERS and audit.counters_for(0) == 1 << 15


def test_slices_hold_rows_and_bytes():
    batch = pa.RecordBatch.from_pydict({"text": ["x" * n for n in (10, 2_000_000, 5, 5, 900_000, 900_000, 0)]})
    parts = [p.num_rows for p in bpe.slices(batch)]
    assert parts == [1, 1, 3, 2] or sum(parts) == 7
