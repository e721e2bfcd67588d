"""The text operators against brute force on small tables, with nulls, empty and long texts, ties and clashing columns."""

import gc
import random
import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from assayer.llm import components, katz, line_dedup, minhash, packing, pieces, pivots, secret_scan, suffixes, topk, toxicity
from assayer.llm.common import crc_of_id, stored

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, id long, keys string"


def documents(spark, texts, start=0):
    rows = [(i + start, t, None, "s", None if t is None else len(t), "k", 1, None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(n, seed=0, size=60):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{x}" for x in rng.integers(0, size, n))


@pytest.fixture(scope="module")
def corpus(spark):
    base = words(120, 1, 5000)
    near = base.replace(base.split()[60], "other", 1)
    texts = [None, "", " \n\t", "one two", "one two", base, base, near, base.upper(), words(3000, 2), "é ü " * 300, "aaaa " * 200,
             *(f"{base} tail{i} x{i} y{i}" for i in range(40)), *(words(60, s, 5000) for s in range(20, 40))]
    return texts, stored(documents(spark, texts), "corpus")


def tokens(text):
    return re.findall(rb"[^\x20\x09-\x0D]+", bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()))


def joined(n, links):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def test_components(spark):
    edges = [(5, 4), (4, 3), (3, 2), (9, 8), (8, 9), (7, 7), (1, 2), (20, 9)]
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 5: 1, 8: 8, 9: 8, 20: 8}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("small", [2, 32])
def test_minhash(spark, corpus, small, monkeypatch):
    texts, docs = corpus
    sets = []
    for t in texts:
        w = tokens(t)
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    links = [(a, b) for a in range(len(sets)) for b in range(a) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    want = joined(len(sets), links)
    monkeypatch.setattr(minhash.linked_classes, "__defaults__", (75, 5, 64, small))
    got = {r["doc_id"]: r for r in minhash.near_duplicates(docs).collect()}
    assert [got[i]["component_id"] for i in range(len(sets))] == want
    assert [got[i]["n_shingles"] for i in range(len(sets))] == [len(s) for s in sets]
    assert sorted(r["doc_id"] for r in minhash.keep_one(docs).collect()) == [i for i, c in enumerate(want) if i == c]
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_minhash_of_shortened_copies(spark):
    """Pairs at exactly 3/4, one text the start of the other, of which few of the smallest half of the sketch is shared."""
    rng, texts = np.random.default_rng(29), []
    hasher = minhash.WordHasher()
    for k in range(40):
        batch = [[f"r{k}x{i}y{x}" for x in rng.permutation(404)] for i in range(100)]
        both = [" ".join(w) for w in batch] + [" ".join(w[:304]) for w in batch]
        with np.errstate(over="ignore"):
            sets = list(minhash.shingle_sets(hasher, pa.array(both)))
        for i in range(100):
            assert (len(sets[i]), len(sets[100 + i]), len(np.intersect1d(sets[i], sets[100 + i]))) == (400, 300, 300)
            if len(np.intersect1d(sets[i][:32], sets[100 + i][:32])) <= 16:
                texts += [both[i], both[100 + i]]
    assert len(texts) >= 2
    got = {r["doc_id"]: r["component_id"] for r in minhash.near_duplicates(documents(spark, texts)).collect()}
    assert got == {i: i - i % 2 for i in range(len(texts))}


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_line_dedup(spark):
    rng = np.random.default_rng(3)
    stock = ["".join(rng.choice(list("abé "), 24)) for _ in range(12)]
    lines = []
    for k in range(160):
        line = stock[(k // 6) % 12]
        at = int(rng.integers(0, 24))
        lines.append([line, line[:at] + line[at + 1 :], line[:at] + "z" + line[at:], line[:at] + "q" + line[at + 1 :], f"short{k % 9}", ["", " \t", "\u3000"][k % 3]][k % 6])
    texts = [None, "", "x", *("\n".join(lines[i : i + 8]) for i in range(0, 160, 8)), "a" * 25 + "\n" + "a" * 26, words(4000, 5)]
    docs = documents(spark, texts)
    flat = [(d, n, line) for d, t in enumerate(texts) for n, line in enumerate((t or "").split("\n"))]
    kept = {}
    for i, (d, n, line) in enumerate(flat):
        earlier = [o for _, _, o in flat[:i]]
        again = line.strip(" \t\n\v\f\r") and line in earlier
        if not (again or len(line) >= 20 and any(len(o) >= 20 and distance_one(line, o) for o in earlier)):
            kept.setdefault(d, []).append(line)
    first = {}
    for d, n, line in flat:
        first.setdefault(line, (d, n))
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    for d, t in enumerate(texts):
        assert got[d]["text"] == (None if t is None else "\n".join(kept.get(d, []))), d
        assert got[d]["key"] == "k" and got[d]["id"] == 1
    assert sum(r["__near"] for r in got.values()) > 20
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def test_secrets(spark):
    body = "abcdefghijklmnopqrstuvwxyz0123"
    good, bad = "ghp_" + body + secret_scan.crc_base62(body), "ghp_" + body + "AAAAAA"
    texts = [None, "", f"é {good} {bad}", 'Password = "hunter22x" token:abc passwd=secret=abcdef API_KEY : zzzzzzz', "AKIA" + "A" * 16 + " AKIA123",
             "x" + "0123456789abcdef" * 2 + "G deadbeef" + "f" * 23, "F" * 30, "api-key=1234567", "deadBEEF" + "0" * 24]
    got = {r["doc_id"]: r for r in secret_scan.scan(documents(spark, texts)).collect()}
    for d, t in enumerate(texts):
        t = t or ""
        low = re.sub("[A-Z]", lambda m: m[0].lower(), t)
        spans = [(m.start(), 0, m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([a-z0-9+/_.=-]+)""", low) if len(m[2]) >= 6]
        spans += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
        spans += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
        base = ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
        assert got[d]["base_sha256"] == hashlib.sha256(base.encode()).hexdigest()
        assert [got[d]["n_assign"], got[d]["n_access"], got[d]["n_hex"]] == [sum(k == x for _, k, _ in spans) for x in range(3)]
    assert got[2]["spans"] == "github:2:42"
    clean = {r["doc_id"]: r["text"] for r in secret_scan.redact(documents(spark, texts)).collect()}
    assert clean[0] is None and clean[1] == "" and clean[2] == f"é [SECRET] {bad}" and clean[7] == "api-key=1234567"


def test_packing(spark, corpus):
    texts, docs = corpus
    rows = packing.pack(docs).toPandas()
    assert rows.groupby("doc_id")["length"].sum().to_dict() == rows.groupby("doc_id")["doc_tokens"].first().to_dict()
    rows = rows.sort_values(["sequence_id", "offset"])
    assert (rows.groupby("sequence_id")["length"].cumsum() - rows["length"] == rows["offset"]).all()
    assert rows.groupby("sequence_id")["length"].sum().max() <= 2048
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(packing.default_tokenizer())
    for doc, start, length, crc in rows[["doc_id", "start", "length", "ids_crc32"]].itertuples(index=False):
        ids = [*tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids, 1][start : start + length]
        assert zlib.crc32(np.array(ids, "<u4").tobytes()) == crc
    assert packing.pack(docs.limit(0)).count() == 0


def test_cutting_stock_is_near_the_bound():
    sizes, demand = np.array([3, 5, 9, 14, 22]), np.array([400, 300, 170, 90, 33])
    solution = packing.cutting_stock(sizes, demand, 32)
    assert (sum(n * p for n, p in solution) >= demand).all() and all((p * sizes).sum() <= 32 for _, p in solution)
    assert sum(n for n, _ in solution) <= math.ceil((sizes * demand).sum() / 32) + len(sizes)


@pytest.mark.parametrize("order", [2, 3])
def test_katz_is_normalised_and_counts(spark, corpus, order):
    texts, docs = corpus
    got = {r["doc_id"]: r for r in katz.score(docs, crc_of_id() % 10 == 0, order=order, group=500, bucket=100).collect()}
    held = {d for d in range(len(texts)) if zlib.crc32(str(d).encode()) % 10 == 0}
    count, seen = [Counter() for _ in range(order)], [{} for _ in range(order)]
    for d, t in enumerate(texts):
        line = ["^"] * (order - 1) + tokens(t) + [None]
        for i in range(order - 1, len(line)):
            for k in range(order if d not in held else 0):
                gram = tuple(line[i - k : i + 1])
                count[k][gram] += 1
                seen[k].setdefault(gram[:-1], set()).add(gram)
    total, types = sum(count[0].values()), len(count[0])
    factor = [katz.discounts(np.array([0, 0, *(Counter(c.values())[r] for r in range(1, 7))])) for c in count]
    cut = lambda k, c: c * (factor[k][c] if c <= 5 else 1)
    lost = total - sum(cut(0, c) for c in count[0].values())

    def p(gram):
        k = len(gram) - 1
        c = count[k].get(gram, 0)
        if k == 0:
            return cut(0, c) / total if c else lost / total
        options = seen[k].get(gram[:-1])
        if not options:
            return p(gram[1:])
        whole, kept = sum(count[k][g] for g in options), sum(cut(k, count[k][g]) for g in options)
        whole += kept >= whole - 1e-9
        return cut(k, c) / whole if c else (1 - kept / whole) / (1 - sum(p(g[1:]) for g in options)) * p(gram[1:])

    for history in list(seen[1])[:20]:
        assert math.isclose(sum(p(history + w) for w in count[0]) + p(history + ("unknown",)), 1, rel_tol=1e-9)
    for d, t in enumerate(texts):
        line = ["^"] * (order - 1) + tokens(t) + [None]
        score = sum(math.log10(p(tuple(line[i - order + 1 : i + 1]))) for i in range(order - 1, len(line)))
        base = sum(math.log10((count[0].get((w,), 0) + 0.1) / (total + 0.1 * (types + 1))) for w in line[order - 1 :])
        row = got[d]
        assert math.isclose(row["score"], score, rel_tol=1e-6) and math.isclose(row["base_score"], base, rel_tol=1e-6)
        assert (row["held_out"], row["n_tokens"], row["train_tokens"]) == (d in held, len(line) - order + 1, total)
    assert katz.score(docs.limit(0), F.lit(False)).count() == 0


def test_toxicity(spark):
    rng = np.random.default_rng(7)
    clean = [words(80, s, 400) for s in range(200)]
    toxic = [f"{words(40, s, 400)} vileword {words(30, s + 1, 400)} badname" for s in range(200, 260)]
    texts = [*clean, *toxic, None, ""]
    labels = spark.createDataFrame([(i, 1 if 200 <= i < 260 else 0) for i in range(len(texts))] + [(5, None)], "doc_id long, toxic int")
    docs = documents(spark, texts)
    model = toxicity.train(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.classify(docs, model).collect()}
    right = [got[i]["predicted"] == (200 <= i < 260) for i in range(len(texts)) if got[i]["held_out"]]
    assert sum(right) >= 0.95 * len(right) and got[261]["predicted"] == 0
    hidden = documents(spark, [f"{words(30, 9, 400)} v1lew0rd and b.a.d.n.a.m.e", f"{words(30, 9, 400)} vileworddd v i l e w o r d", words(30, 9, 400)])
    assert [r["predicted"] for r in toxicity.classify(hidden, model).orderBy("doc_id").collect()] == [1, 1, 0]
    assert sorted(r["doc_id"] for r in toxicity.reject(hidden, model).collect()) == [2]
    none = toxicity.train(docs, labels.limit(0))
    assert {r["score"] for r in toxicity.classify(docs, none).collect()} == {0.0}
    assert rng is not None


def test_toxicity_learns_from_every_labelled_row(spark):
    # 100 labelled documents of 30,000 hold the word: a learner of some 20,000 of them does not meet all.
    ids = [i for i in range(46_000) if zlib.crc32(str(i).encode()) % 3 != 1][:30_000]
    rows = [(i, f"plain words{' vileword' if k < 100 else ''} {i}", int(k < 100)) for k, i in enumerate(ids)]
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.train(table.select("doc_id", "text"), table.select("doc_id", "toxic"))
    assert math.isclose(model.weights["vileword"], math.log(100.5 / 101) - math.log(0.5 / 29_901))
    assert model.trigrams["^pl"] == 30_000


def test_toxicity_counts_are_sent_on_before_they_fill_the_memory(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "tidy", lambda run: tasks.append(run) or run)
    monkeypatch.setattr(toxicity, "COUNTED", 20)
    tasks = []
    labelled = spark.createDataFrame([("a", 1)], "text string, toxic int")
    toxicity.count_features(labelled)
    batch = pa.RecordBatch.from_pydict({"text": [f"same own{i}" for i in range(200)], "toxic": [i % 2 for i in range(200)]})
    parts = list(tasks[0](iter([batch])))
    assert len(parts) > 5 and max(p.num_rows for p in parts) < 60
    total = Counter()
    for part in parts:
        for feature, toxic, clean in zip(*(c.to_pylist() for c in part.columns), strict=True):
            total[feature] += toxic + clean
    assert total["same"] == 200 and total["own7"] == 1 and total[" ^sa"] == 200


def test_toxicity_curve_is_the_one_of_all_points(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=400), 1)
    y = (x + rng.normal(size=400) > 1).astype(float)
    counts = Counter(zip(y.tolist(), x.tolist(), strict=True))
    points = spark.createDataFrame([(int(a), b, n) for (a, b), n in counts.items()], "toxic int, evidence double, rows long")
    slope, intercept = toxicity.fit_curve(points)
    p = 1 / (1 + np.exp(-(slope * x + intercept)))
    assert abs(((y - p) * x).sum() - 0.5 * slope) < 1e-6 and abs((y - p).sum() - 0.05 * intercept) < 1e-6  # the penalised optimum


def test_topk(spark):
    rng = np.random.default_rng(11)
    cells = np.round(rng.normal(size=(700, 9)), 3)
    cells[100:160] = cells[100]
    rows = [(i, c.tolist()) for i, c in enumerate(cells)] + [(1000, None), (1050, [float("nan")] * 9), (1100, [None] * 9), (1150, [1.0, 2.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("rank", F.lit("clash"))
    got = {}
    for r in topk.search(table, F.col("vec_id") % 50 == 0, block=128).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = {i: np.floor(256 * np.array([*v, *[0] * (9 - len(v))])).astype(int) for i, v in rows if v and None not in v and not np.isnan(v).any()}
    for q in (i for i in whole if i % 50 == 0):
        best = sorted(((-int(whole[q] @ v), i) for i, v in whole.items() if i != q))[:5]
        assert sorted(got[q]) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]
    assert topk.search(table.limit(0), F.lit(True)).count() == 0


def test_topk_in_many_groups_without_a_broadcast(spark, monkeypatch):
    rng = np.random.default_rng(12)
    cells = rng.integers(-20, 20, (600, 5)) / 256
    table = spark.createDataFrame([(i, c.tolist()) for i, c in enumerate(cells)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(topk, "QUERIES", 32)
    monkeypatch.setattr(topk, "GROUP_BYTES", 2 * 64 * 5 * 8)
    found = topk.search(table, F.col("vec_id") % 3 == 0, block=64)
    # The queries' copies are one to each group of rows: their size is unknown to Spark, so none may be sent to all tasks by way of the driver.
    assert "Broadcast" not in found._jdf.queryExecution().toString()
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    whole = np.floor(256 * cells).astype(int)
    scores = whole @ whole.T
    assert sorted(got) == list(range(0, 600, 3))
    for q, rows in got.items():
        best = sorted((-int(s), i) for i, s in enumerate(scores[q]) if i != q)[:5]
        assert sorted(rows) == [(k + 1, i, -s) for k, (s, i) in enumerate(best)]


def test_pivot_recall(spark):
    rng = np.random.default_rng(13)
    a = rng.normal(size=(600, 32))
    b = a + rng.normal(size=a.shape) * 0.35
    cells = np.concatenate([a, b, a[:50], np.tile(a[0], (40, 1))])
    rows = [(i, c.tolist()) for i, c in enumerate(cells)] + [(5000, None), (5001, [0.0] * 32), (5002, [float("inf")] * 32)]
    got = pivots.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas().set_index("vec_id").sort_index()
    unit = cells / np.linalg.norm(cells, axis=1, keepdims=True)
    links = (unit @ unit.T >= 0.9) & ~np.eye(len(cells), dtype=bool)
    found = got.loc[: len(cells) - 1, "n_links"].to_numpy()
    assert (found <= links.sum(1)).all() and found.sum() >= 0.9 * links.sum()
    assert list(got.loc[5000:, "n_links"]) == [0, 0, 0] and got.loc[5000:, "kept"].all()


@pytest.mark.parametrize("count, group_cosine", [(1500, 0.92), (4500, 0.92), (4500, 0.85)])
def test_pivot_recall_in_a_dense_group(spark, count, group_cosine):
    rng = np.random.default_rng(19)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    own = unit(rng.normal(size=(count // 3, 64)))
    group = unit(group_cosine**0.5 * unit(rng.normal(size=(1, 64))) + (1 - group_cosine) ** 0.5 * own)
    cells = np.concatenate([group, unit(rng.normal(size=(count - len(group), 64)))])
    frame = pd.DataFrame({"vec_id": np.arange(count), "embedding": [c.tolist() for c in cells]})
    got = pivots.near_duplicates(spark.createDataFrame(frame, "vec_id long, embedding array<double>")).toPandas().set_index("vec_id").sort_index()
    links = (cells @ cells.T >= 0.9) & ~np.eye(count, dtype=bool)
    found = got["n_links"].to_numpy()
    assert (found <= links.sum(1)).all() and found.sum() >= 0.99 * links.sum() > 0


def test_pieces(spark):
    texts = [None, "", " ", "  a  b", "a▁b ▁", "x\n\n y \n", "Hello world", "中文 é\t!", words(500, 3), "ab" * 3000, " \n"]
    docs = documents(spark, texts)
    rows = {r["doc_id"]: r for r in pieces.digests(docs).collect()}
    assert all(r["restored"] for r in rows.values()) and rows[0]["n_ids"] == 0
    back = {r["doc_id"]: r["text"] for r in pieces.decoded(pieces.encoded(docs)).collect()}
    assert back == {i: t or "" for i, t in enumerate(texts)}
    model = pieces.PieceModel(pieces.default_model())
    score = {model.output[i].replace(b" ", "▁".encode()).decode(): s for i, s in enumerate(model.score) if s > -1e30}
    for text in ("Hello  world", "internationalisation of x"):
        line = "▁" + text.replace(" ", "▁")
        best = [0.0] + [-1e99] * len(line)
        for j in range(1, len(line) + 1):
            best[j] = max(best[i] + score.get(line[i:j], model.least if j - i == 1 else -1e99) for i in range(max(0, j - 20), j))
        ids = next(pieces.PieceEncoder(model).encode([text]))
        assert math.isclose(sum(model.score[i] if model.score[i] > -1e30 else model.least for i in ids), best[-1])


@pytest.mark.parametrize("limit", [30, 10**6])
def test_suffix_order(limit):
    rng = np.random.default_rng(17)
    for n in (0, 1, 2, 40, 700):
        for letters in (1, 2, 256):
            data = rng.integers(0, letters, n).astype(np.uint8)
            raw = data.tobytes()
            assert suffixes.suffix_order(data, n + 1, limit).tolist() == sorted(range(n), key=lambda i: raw[i:])


def test_repeats(spark, corpus):
    texts, docs = corpus
    passage = words(90, 77, 900)
    texts = [*texts, f"left side {passage} right", passage, "é" * 250, "x" * 399, "y" * 401, "ab" * 400]
    docs = documents(spark, texts)
    count = Counter(t.encode()[i : i + 400] for t in texts if t for i in range(len(t.encode()) - 399))
    got = {r["doc_id"]: r for r in suffixes.remove_repeats(docs).collect()}
    for d, t in enumerate(texts):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 399):
            if count[data[i : i + 400]] > 1:
                gone[i : i + 400] = b"\1" * 400
        kept = bytes(x for x, g in zip(data, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        assert (got[d]["n_bytes"], got[d]["n_removed"], got[d]["n_spans"], got[d]["kept_sha256"]) == (len(data), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    assert suffixes.remove_repeats(docs.limit(0)).count() == 0


def test_repeats_of_an_oversized_key(spark, monkeypatch):
    passage = words(90, 78, 900)[:300]
    texts = [f"{words(80, s % 50 + 100, 900)}{passage}{words(80, s % 40 + 300, 900)}" for s in range(120)]
    docs = documents(spark, texts)
    largest = {}

    def seen(name, call):
        def wrapped(pieces, *more):
            largest[name] = pieces.groupBy("key").agg(F.sum(F.length("data")).alias("n")).agg(F.max("n")).first()[0]
            return call(pieces, *more)

        monkeypatch.setattr(suffixes, name, wrapped)

    seen("shard_runs", suffixes.shard_runs)
    seen("window_runs", suffixes.window_runs)
    got = {r["doc_id"]: sorted((x["start"], x["end"]) for x in r["spans"]) for r in suffixes.repeats(docs, shard=10_000).collect()}
    assert largest["window_runs"] > 10_000 and (largest["shard_runs"] or 0) <= 10_000
    count = Counter(t[i : i + 400] for t in texts for i in range(len(t) - 399))
    for d, t in enumerate(texts):
        want = {x for i in range(len(t) - 399) if count[t[i : i + 400]] > 1 for x in range(i, i + 400)}
        assert {x for a, b in got.get(d, []) for x in range(a, b)} == want


def test_queues_spill_below_the_size_of_a_shard(monkeypatch):
    files, make = [], suffixes.tempfile.mkstemp
    monkeypatch.setattr(suffixes.tempfile, "mkstemp", lambda **k: files.append(1) or make(**k))
    n = 30_000
    data = np.random.default_rng(23).integers(0, 256, n).astype(np.uint8)
    order = suffixes.suffix_order(data, 64, suffixes.IN_MEMORY * n // suffixes.SHARD)
    raw = data.tobytes()
    assert files and order.tolist() == sorted(range(n), key=lambda i: raw[i : i + 64])


def test_pipeline_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf), f"test-{name}")
        assert docs.columns == columns and 0.7 * before <= docs.count() <= before
    texts = [r["text"] for r in docs.collect()]
    assert not any(secret_scan.Scanner().spans(t) for t in texts[:50])
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == len(texts)


def test_line_dedup_beside_columns_of_its_own_names(spark):
    text = "a line of more than twenty characters"
    rows = [(1, text, "n", "d", "w", "l", "x"), (2, text + "\nshort", "n", "d", "w", "l", "x"), (3, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, near string, dropped string, wanted string, line string, number string")
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    assert [got[i]["text"] for i in (1, 2, 3)] == [text, "short", None] and [got[i]["near"] for i in (1, 2, 3)] == ["n", "n", None]
    assert [got[i]["__removed"] for i in (1, 2, 3)] == [0, 1, 0]


def test_minhash_loses_no_link_beside_a_document_without_id(spark):
    base = words(100, 5, 5000)
    near = base.replace(base.split()[50], "other", 1)
    docs = stored(documents(spark, [base, near, "of its own " * 30]).unionByName(documents(spark, [base]).withColumn("doc_id", F.lit(None).cast("long"))), "no-id")
    got = sorted(((r["doc_id"], r["component_id"], r["kept"]) for r in minhash.near_duplicates(docs).collect()), key=repr)
    assert got == [(0, 0, True), (1, 0, False), (2, 2, True), (None, None, True)]
    assert sorted((r["doc_id"] for r in minhash.keep_one(docs).collect()), key=repr) == [0, 2, None]


def test_word_encoder_equals_the_tokenizer_on_odd_words():
    rng = random.Random(4)
    bits = ["'s", "'T", "don't", "..'s", "İ", "×", "²", "1", "23", "Ab", "é", "é", "中", "\t", " ", "\n", "\x1c", "\x85", "#", "_", "Σ", "한", "😀", "'ll", "'", "ß", "."]
    texts = ["", *["".join(rng.choice(bits) for _ in range(rng.randint(0, 12))) for _ in range(1500)], "x" * 30_000]
    encoder = packing.WordEncoder(packing.default_tokenizer())
    encoder.words.limit = encoder.parts.limit = 50  # generations turn all the time
    got = [b for at in range(0, len(texts), 64) for b in encoder.encode(texts[at : at + 64])]
    want = [np.array(e.ids, "<u4").tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert got == want and encoder.cut


def test_packing_encodes_without_the_search_for_cycles(spark, monkeypatch):
    tasks, seen, encode = [], [], packing.WordEncoder.encode
    monkeypatch.setattr(packing, "tidy", lambda run: tasks.append(run) or run)
    packing.pieces(spark.createDataFrame([(1, "a")], "doc_id long, text string"))
    monkeypatch.setattr(packing.WordEncoder, "encode", lambda self, texts: seen.append(gc.isenabled()) or encode(self, texts))
    batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": ["one two", ""]})
    assert [len(found) for found in tasks[0](iter([batch]))] == [2]
    assert seen == [False] and gc.isenabled()


def test_memory_keeps_what_is_used():
    memory = packing.Memory(2)
    memory.now.update(a=1, b=2, c=3)
    memory.turn()
    assert memory.missing({"a", "z"}) == ["z"] and memory.now == {"a": 1}


def test_disguised_words_of_any_length_are_restored():
    word = "vileword" * 12
    model = toxicity.CharModel(Counter(toxicity.trigrams_of(word)))
    evidence = toxicity.Evidence({"vilewo*": 4.0, word: 7.0}, model)
    for text in (word.replace("i", "1", 3), "v.i.l.e" + word[4:].replace("e", "3"), "vvvile" + word[4:], " ".join(word)):
        assert len(text) > 60 and evidence.of(f"some {text} here") == 7.0
    assert toxicity.decode(word.replace("i", "!") * 100, model) == word * 100
