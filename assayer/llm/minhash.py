"""Near-duplicate documents by bottom-k sketches from one hash function.

A document's set holds its distinct five-word shingles as 64-bit hashes; its sketch is the ``SKETCH`` smallest of them.
Documents with equal sets form a class, of which only the smallest doc_id goes on. Inverted lists of retained values
propose pairs, the share of common values among the smallest of the united sketches filters them, and the full sets
confirm 100 * intersection >= 75 * union.

Inverted lists. Two linked sketches have at least ``LEAST_SHARED`` of their ``LISTED`` smallest values in common: fewest are
expected where one set holds the other (a shortened copy), 48 of 64 at a similarity of 3/4 with a deviation of 3.5, and the
bound is six deviations below; ``SLACK`` leaves the union-sketch filter as much. So it is enough that a class enters the lists of its rarest
retained values, all but ``LEAST_SHARED`` - 1 of them: two linked classes meet in one of these lists. Values of very common
lines are a document's least rare ones and open no list, and a class whose rarest values are its own alone needs no look.

A list of at most ``SMALL`` classes gives all its pairs. A longer one first gives only pairs with its smallest member; what
they link becomes one component. Pairs inside a component need no further look, so only the classes outside the list's
largest component are left. These are compared with the whole list on full sets, in blocks of sets that meet in tasks; a task
gives at most one link per class and component. So no list gives rows by the square of its size, and none is cut off.

Null and empty texts have no shingles and link with nothing; fewer than five words are one shingle. Repeated rows share
their doc_id's component. A document without doc_id links with nothing, has no component and is kept. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHasher, column, mix, release, stored, text_chunks, texts_of
from .components import components

WORDS, SKETCH, LISTED, LEAST_SHARED, SMALL, BLOCK, SLACK = 5, 64, 64, 28, 32, 150_000, 0.32
STEP = np.uint64(0xD6E8FEB86659FD93)
SETS = "doc_id long, n_shingles long, set_a long, set_b long, values array<long>"


def shingle_sets(hasher: WordHasher, texts: pa.Array, words: int = WORDS) -> Iterator[np.ndarray]:
    """Each text's distinct shingle hashes, ascending, as unsigned 64-bit numbers."""
    for _, offsets, data in text_chunks(texts):
        hashes, before = hasher.words(offsets, data)
        joined = np.zeros(max(0, len(hashes) - words + 1), np.uint64)
        for j in range(words):
            joined = joined * STEP + hashes[j : j + len(joined)]
        joined = mix(joined)
        for start, end in zip(before[:-1], before[1:], strict=True):
            if end - start >= words:
                yield np.unique(joined[start : end - words + 1])
            elif end > start:
                few = np.uint64(end - start)
                for h in hashes[start:end]:
                    few = np.bitwise_xor(few * STEP, h)
                yield mix(np.array([few], np.uint64))
            else:
                yield joined[:0]


def shingled(docs: DataFrame, keep: int | None, words: int = WORDS) -> DataFrame:
    """One row per document with its set's size and digest, and the ``keep`` smallest values (None: all)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            hasher = WordHasher()
            for whole in batches:
                for at in range(0, whole.num_rows, 500):
                    batch = whole.slice(at, 500)
                    sizes, digest_a, digest_b, values = [], [], [], []
                    for s in shingle_sets(hasher, column(batch, "text"), words):
                        sizes.append(len(s))
                        digest_a.append(int(s.sum().view(np.int64)) if len(s) else 0)
                        digest_b.append(int(mix(s ^ STEP).sum().view(np.int64)) if len(s) else 0)
                        values.append((s if keep is None else s[:keep]).view(np.int64))
                    ends = np.cumsum([0, *map(len, values)])
                    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(values) if values else np.zeros(0, np.int64)))
                    yield pa.RecordBatch.from_arrays(
                        [column(batch, "doc_id"), pa.array(sizes, pa.int64()), pa.array(digest_a, pa.int64()), pa.array(digest_b, pa.int64()), lists],
                        names=["doc_id", "n_shingles", "set_a", "set_b", "values"])

    return texts_of(docs).mapInArrow(run, SETS)


def classes_of(sketches: DataFrame) -> DataFrame:
    """(id, n, sketch) of each distinct non-empty set; id is the smallest doc_id that has it."""
    grouped = sketches.filter("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "set_a", "set_b").agg(F.min(F.struct("doc_id", "values")).alias("least"))
    return grouped.select(F.col("least.doc_id").alias("id"), F.col("n_shingles").alias("n"), F.col("least.values").alias("sketch"))


def rare_first(classes: DataFrame, percent: int) -> DataFrame:
    """(id, values, quota): the listed values that other classes retain, too, rarest first; ``quota`` of them open lists."""
    values = classes.select("id", F.explode(F.slice("sketch", 1, LISTED)).alias("value"))
    common = values.groupBy("value").agg(F.count("*").alias("m")).filter("m > 1")
    shared = values.join(common, "value").groupBy("id").agg(F.sort_array(F.collect_list(F.struct("m", "value"))).alias("shared"))
    length = F.least("n", F.lit(LISTED))
    # A set of at most 3/4 * LISTED values, and any partner of it, is listed whole: then the bound is exact.
    short = F.col("n") <= LISTED * percent // 100
    prefix = F.when(short, F.col("n") - F.ceil(F.col("n") * percent / 100) + 1).otherwise(F.lit(LISTED - LEAST_SHARED + 1))
    own = length - F.size("shared")
    return shared.join(classes.select("id", "n"), "id").select(
        "id", F.col("shared.value").alias("values"), (prefix - own).cast("int").alias("quota")).filter("quota > 0")


def full_sets(docs: DataFrame, ids: DataFrame, words: int, sketch: int) -> DataFrame:
    """(id, n, sketch, values) of the classes named in ``ids``."""
    some = texts_of(docs).join(ids.select(F.col("id").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return shingled(some, None, words).select(
        F.col("doc_id").alias("id"), F.col("n_shingles").alias("n"), F.slice("values", 1, sketch).alias("sketch"), "values")


def verified(pairs: DataFrame, sets: DataFrame, percent: int, sketch: int) -> DataFrame:
    """The pairs that the united sketches let pass and the full sets confirm."""
    brief, whole = sets.select("id", "n", "sketch"), sets.select("id", "values")
    side = lambda frame, end: frame.select([F.col(c).alias(f"{c}_{end}" if c != "id" else end) for c in frame.columns])
    both = pairs.join(side(brief, "a"), "a").join(side(brief, "b"), "b").filter(
        100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
    both = both.withColumn("united", F.slice(F.sort_array(F.array_union("sketch_a", "sketch_b")), 1, sketch))
    shared = F.size(F.array_intersect(F.array_intersect("sketch_a", "sketch_b"), "united"))
    likely = stored(both.filter(shared >= (percent / 100 - SLACK) * F.size("united")).select("a", "b"), "likely-pairs")
    full = likely.join(side(whole, "a"), "a").join(side(whole, "b"), "b").withColumn("common", F.size(F.array_intersect("values_a", "values_b")))
    return full.filter(100 * F.col("common") >= percent * (F.size("values_a") + F.size("values_b") - F.col("common"))).select("a", "b")


def linked_classes(docs: DataFrame, classes: DataFrame, percent: int = 75, words: int = WORDS, sketch: int = SKETCH, small: int = SMALL) -> DataFrame:
    """Edges (a, b) between classes whose components are those of all links."""
    spark = docs.sparkSession
    links = spark.createDataFrame([], "a long, b long")
    nodes = spark.createDataFrame([], "node long, component long")
    ordered = rare_first(classes, percent)
    rows = stored(ordered.select("id", F.explode(F.slice("values", F.lit(1), F.col("quota"))).alias("key")), "list-rows")
    sizes = stored(rows.groupBy("key").agg(F.count("*").alias("m"), F.min("id").alias("first")).filter("m > 1"), "list-sizes")
    sets = stored(full_sets(docs, rows.join(sizes, "key").select("id").distinct(), words, sketch), "full-sets")
    release(spark)
    short = rows.join(sizes.filter(F.col("m") <= small).select("key"), "key")
    members = short.groupBy("key").agg(F.sort_array(F.collect_set("id")).alias("ids"))  # ``small`` ids at most
    pairs = members.select(F.explode("ids").alias("a"), "ids").select("a", F.explode("ids").alias("b")).filter("a < b")
    long_lists = sizes.filter(F.col("m") > small).select("key", "first")
    stars = rows.join(long_lists, "key").filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"))
    links, nodes = _look_at(pairs.unionByName(stars), links, nodes, sets, percent, sketch)
    if long_lists.isEmpty():
        return links
    hot = stored(rows.join(long_lists.select("key"), "key").join(nodes.withColumnRenamed("node", "id"), "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")), "long-lists")
    parts = hot.groupBy("key", "component").agg(F.count("*").alias("size"))
    lists = parts.groupBy("key").agg(F.sum("size").alias("m"), F.max(F.struct("size", "component")).alias("main")).filter("m > main.size")
    lists = stored(lists.select("key", F.col("main.component").alias("main")), "list-parts")
    full = hot.join(lists, "key").join(sets.select("id", "values"), "id")
    outside, whole = set_blocks(full.filter("component <> main"), "u"), set_blocks(full, "w")
    more = outside.join(whole, "key").select("u", "w").mapInPandas(block_links(percent), "a long, b long")
    return stored(links.unionByName(more), "links")


def set_blocks(rows: DataFrame, name: str) -> DataFrame:
    """(key, block of sets): each list's rows (id, component, values) in blocks of about ``BLOCK`` values, as bytes."""
    blocks = rows.groupBy("key").agg(F.ceil(F.sum(F.size("values")) / BLOCK).cast("int").alias("blocks"))

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        lengths = np.array([len(v) for v in frame["values"]], np.int64)
        arrays = [np.array([len(frame)], np.int64), frame["id"].to_numpy(np.int64), frame["component"].to_numpy(np.int64), lengths, *frame["values"]]
        return pd.DataFrame({"key": [key[0]], name: [np.concatenate(arrays).astype(np.int64).tobytes()]})

    numbered = rows.join(blocks, "key").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    return numbered.groupBy("key", "block").applyInPandas(pack, f"key long, {name} binary")


def block_links(percent: int):
    """A task's work: links between a block of outsiders and a block of the whole list, a few for each that has any."""

    def sets_in(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        data = np.frombuffer(data, np.int64)
        n = int(data[0])
        return data[1 : n + 1], data[n + 1 : 2 * n + 1], data[2 * n + 1 : 3 * n + 1], data[3 * n + 1 :]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for u, w in zip(frame["u"], frame["w"], strict=True):
                (ids, parts, sizes, values), (their_ids, their_parts, their_sizes, their_values) = sets_in(u), sets_in(w)
                common = np.intersect1d(values, their_values)
                row, their_row = np.repeat(np.arange(len(ids)), sizes), np.repeat(np.arange(len(their_ids)), their_sizes)
                at, their_at = np.searchsorted(common, values), np.searchsorted(common, their_values)
                own = (at < len(common)) & (common[np.minimum(at, len(common) - 1)] == values)
                theirs = (their_at < len(common)) & (common[np.minimum(their_at, len(common) - 1)] == their_values)
                met = np.zeros((len(ids), len(their_ids)), np.float32)
                for low in range(0, len(common), 4096):  # counts of common values, exact in single precision
                    left, right = np.zeros((len(ids), 4096), np.float32), np.zeros((len(their_ids), 4096), np.float32)
                    mine, other = own & (at >= low) & (at < low + 4096), theirs & (their_at >= low) & (their_at < low + 4096)
                    left[row[mine], at[mine] - low] = 1
                    right[their_row[other], their_at[other] - low] = 1
                    met += left @ right.T
                linked = (100 * met >= percent * (sizes[:, None] + their_sizes[None, :] - met)) & (parts[:, None] != their_parts[None, :])
                found = set()
                for i, j in zip(*np.nonzero(linked), strict=True):  # one link to each component is enough
                    found.add((int(ids[i]), int(their_parts[j])))
                yield pd.DataFrame(list(found), columns=["a", "b"], dtype=np.int64)

    return run


def _look_at(pairs: DataFrame, links: DataFrame, nodes: DataFrame, sets: DataFrame, percent: int, sketch: int) -> tuple[DataFrame, DataFrame]:
    """Links and components after the pairs that join different components have been verified."""
    apart = pairs.distinct()
    for end in ("a", "b"):
        apart = apart.join(nodes.select(F.col("node").alias(end), F.col("component").alias(f"c{end}")), end, "left")
    apart = stored(apart.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b"), "pairs")
    if apart.isEmpty():
        return links, nodes
    links = stored(links.unionByName(verified(apart, sets, percent, sketch)), "links")
    release(pairs.sparkSession)
    return links, components(links)


def near_duplicates(docs: DataFrame, percent: int = 75, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept per document."""
    sketches = stored(shingled(docs, SKETCH, words), "sketches")
    classes = stored(classes_of(sketches), "classes")
    links = linked_classes(docs, classes, percent, words)
    release(docs.sparkSession)
    named = classes_named(sketches)
    nodes = components(links).withColumnRenamed("node", "id")
    known = F.col("doc_id").isNotNull()
    return named.join(nodes, "id", "left").select(
        "doc_id", "n_shingles", F.when(known, F.coalesce("component", "id")).alias("component_id")).withColumn("kept", ~known | (F.col("doc_id") == F.col("component_id")))


def classes_named(sketches: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, id of its class); an empty set is a class of its own."""
    narrow = sketches.select("doc_id", "n_shingles", "set_a", "set_b")
    ids = narrow.filter("n_shingles > 0").groupBy("n_shingles", "set_a", "set_b").agg(F.min("doc_id").alias("id"), F.count("*").alias("m"))
    several = stored(ids.filter("m > 1").drop("m"), "shared-classes")
    return narrow.join(several, ["n_shingles", "set_a", "set_b"], "left").select("doc_id", "n_shingles", F.coalesce("id", "doc_id").alias("id"))


def keep_one(docs: DataFrame, percent: int = 75, words: int = WORDS) -> DataFrame:
    """The rows of ``docs``, all columns, without near duplicates of a document with a smaller doc_id."""
    gone = near_duplicates(docs, percent, words).filter(~F.col("kept")).select(F.col("doc_id").alias("__gone"))
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")
