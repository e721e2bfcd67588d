"""Vector columns: which rows take part, and blocks of vectors as matrices."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(vector: str = "embedding") -> Column:
    """True for vectors without null, NaN or infinite components; null vectors are out."""
    value = lambda x: x.cast("double")
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(value(x)) | (F.abs(value(x)) == float("inf")))
    return F.col(vector).isNotNull() & ~F.coalesce(bad, F.lit(True))


def matrix(vectors: pd.Series, width: int, kind=np.float64) -> np.ndarray:
    """The vectors as rows; shorter ones are filled up with zeros."""
    out = np.zeros((len(vectors), width), kind)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def packed(rows: DataFrame, size: int, count: int, width: int) -> DataFrame:
    """(block, ids, cells): about ``size`` of the ``count`` rows (vec_id, vector of longs) a block, as binary matrices."""
    blocks = max(1, -(-count // size))

    def pack(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        ids = frame["vec_id"].to_numpy(np.int64)
        return pd.DataFrame({"block": [key[0]], "ids": [ids.tobytes()], "cells": [matrix(frame["vector"], width, np.int64).tobytes()]})

    numbered = rows.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int"))
    return numbered.groupBy("block").applyInPandas(pack, "block int, ids binary, cells binary")
