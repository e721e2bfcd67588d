"""Seeded, engine-independent pseudo-randomness from md5 of a row key."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_hash(seed, *keys) -> Column:
    """32 hex digits; the order of the strings is a seeded shuffle of the keys."""
    parts = [F.lit(str(seed))] + [F.col(k).cast("string") if isinstance(k, str) else k.cast("string") for k in keys]
    return F.md5(F.concat_ws(":", *parts))


def hash_bits(digest: Column, hex_digits: int, start: int = 1) -> Column:
    """``hex_digits`` (at most 15) of the digest as a bigint."""
    return F.conv(F.substring(digest, start, hex_digits), 16, 10).cast("bigint")


def hash_uniform(digest: Column, start: int = 1) -> Column:
    """A number in [0, 1) from 12 hex digits (48 bits) of the digest."""
    return hash_bits(digest, 12, start).cast("double") / F.lit(float(1 << 48))
