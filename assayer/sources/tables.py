"""Reading and writing feature tables."""

from __future__ import annotations

import re
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The wine-quality table's columns, in file order.
WINE_FEATURES = [
    "fixed acidity", "volatile acidity", "citric acid", "residual sugar", "chlorides", "free sulfur dioxide",
    "total sulfur dioxide", "density", "pH", "sulphates", "alcohol",
]
WINE_SCHEMA = T.StructType(
    [T.StructField("index", T.IntegerType())]
    + [T.StructField(c, T.DoubleType()) for c in WINE_FEATURES]
    + [T.StructField("quality", T.IntegerType())]
)
DELIMITERS = [",", ";", "\t", "|"]
INDEX_NAMES = ["index", "Unnamed: 0", "_c0", ""]


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None, sep: str = ",") -> DataFrame:
    """A headed CSV; without a schema the types are inferred with an extra pass over the file."""
    reader = spark.read.option("header", True).option("sep", sep)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def sniff_delimiter(spark: SparkSession, path: str) -> str:
    """The delimiter that occurs most often, outside quotes, in the first line."""
    lines = spark.read.text(path).head(1)
    plain = re.sub(r'"[^"]*"', "", lines[0][0]) if lines else ""
    return max(DELIMITERS, key=lambda d: (plain.count(d), -DELIMITERS.index(d)))


def read_sniffed(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    return read_csv(spark, path, schema, sniff_delimiter(spark, path))


def read_parquet(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def is_monotonic(df: DataFrame, col: str, order: str) -> bool:
    """Whether ``col`` never falls when rows are read in ``order``.

    The rows are cut into ranges of ``order``; inside a range neighbours are
    compared, between ranges only the end values, so no task sees all rows.
    """
    edges = df.stat.approxQuantile(order, [i / 64 for i in range(1, 64)], 0.002)
    cuts = sorted(set(edges))
    part = reduce(add, [(F.col(order) > F.lit(float(e))).cast("int") for e in cuts], F.lit(0))
    rows = df.select(F.col(col).alias("v"), F.col(order).alias("o"), part.alias("p"))
    inside = Window.partitionBy("p").orderBy("o")
    stepped = rows.withColumn("fall", F.lag("v").over(inside) > F.col("v"))
    ends = stepped.groupBy("p").agg(F.max(F.coalesce("fall", F.lit(False))).alias("fall"), F.min_by("v", "o").alias("first"), F.max_by("v", "o").alias("last"))
    ranges = sorted(ends.collect(), key=lambda r: r["p"])
    return not any(r["fall"] for r in ranges) and all(a["last"] <= b["first"] for a, b in zip(ranges, ranges[1:]))


def drop_index(df: DataFrame, name: str | None = None, order: str | None = None) -> DataFrame:
    """Drop the named index column, or the first column when it carries an index name or, read in ``order``, never falls."""
    if name is not None:
        return df.drop(name)
    first = df.columns[0]
    found = first in INDEX_NAMES or (order is not None and is_monotonic(df, first, order))
    return df.drop(first) if found else df


def holdout(df: DataFrame, index: str, first: int, last: int) -> DataFrame:
    """Rows whose index lies in ``[first, last]``; the range reaches the scan as a filter."""
    return df.filter(F.col(index).between(first, last))


def normalise_names(df: DataFrame) -> DataFrame:
    """strip, lower case, blanks to underscores."""
    return df.toDF(*[re.sub(r"\s+", "_", c.strip().lower()) for c in df.columns])


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def synthetic_table(spark: SparkSession, n: int, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """A stand-in wine table when the input is absent: uniform features, classes 3..9."""
    base = spark.range(0, n, 1, partitions) if partitions else spark.range(n)
    features = [F.rand(seed + i).alias(c) for i, c in enumerate(WINE_FEATURES)]
    quality = (F.floor(F.rand(seed + len(WINE_FEATURES)) * 7) + 3).cast("int").alias("quality")
    return base.select(F.col("id").cast("int").alias("index"), *features, quality)
