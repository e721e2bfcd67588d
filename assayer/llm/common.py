"""Shared helpers: tables, intermediate tables, and words and hashes of whole text batches.

Every function that runs inside a task works on Arrow batches and holds a few megabytes of text at a time.
"""

from __future__ import annotations

import ctypes
import gc
import time
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.session import scratch_path

#: Odd multiplier of the polynomial word hash, and the seed of its byte values.
BASE, SEED = 0x9E3779B97F4A7C15, 20240601
#: Bytes of text worked on at a time inside a task.
CHUNK = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage is cut, and several passes read it cheaply."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished work: it does so once the driver has collected its garbage."""
    for _ in range(2):  # the first pass lets go of plans, the second of the shuffles they held
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def tidy(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``; its worker, which Spark keeps for later tasks, gives back what the task freed."""

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc alone has it
        if trim:
            trim(0)

    return tidied


def texts_of(docs: DataFrame) -> DataFrame:
    """``doc_id`` as long and ``text`` with null as empty, whatever other columns there are."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def crc_of_id(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary"))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def text_chunks(texts: pa.Array, limit: int = CHUNK) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, offsets of the rows, bytes) of consecutive rows that hold about ``limit`` bytes."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if not len(texts):
        return
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
        yield row, at[row : end + 1] - at[row], data[at[row] : at[end]]
        row = end


class WordHasher:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z in lower case, as 64-bit hashes, without a Python object per word."""

    def __init__(self) -> None:
        self.blank = np.zeros(256, bool)
        self.blank[[32, *range(9, 14)]] = True
        lower = np.arange(256)
        lower[65:91] += 32
        self.value = np.random.default_rng(SEED).integers(1, 2**63, 256, dtype=np.uint64)[lower]
        self.up, self.down = np.zeros(0, np.uint64), np.zeros(0, np.uint64)

    def words(self, offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hash of each word, in order, and the number of words before each row (one more entry than rows)."""
        n = len(data)
        if n > len(self.up):
            self.up, self.down = powers(BASE, n + n // 4), powers(pow(BASE, -1, 2**64), n + n // 4)
        inside = ~self.blank[data]
        cut = np.zeros(n + 1, bool)  # rows end words, too
        cut[offsets] = True
        begins = inside.copy()
        begins[1:] &= ~inside[:-1] | cut[1:n]
        ends = inside.copy()
        ends[:-1] &= ~inside[1:] | cut[1:n]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(self.value[data] * self.up[:n], out=total[1:])
        hashes = (total[end] - total[start]) * self.down[start]
        return mix(hashes + (end - start).astype(np.uint64)), np.searchsorted(start, offsets)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))
