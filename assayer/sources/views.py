"""Feature tables derived from the raw tables, once as DataFrames and once as SQL.

The SQL text is what the oracle runs; both sides round aggregated doubles so that
a different summation order cannot move a value across a threshold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ORDER_COLS = ["sum_qty", "sum_price", "avg_disc", "max_tax", "min_qty", "total_price"]
LINE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_size", "p_retailprice"]
DOC_COLS = ["n_chars", "spaces"]
USER_COLS = ["n_events", "sum_value", "avg_value", "max_value", "n_errors"]

SQL = {
    "order_features": """order_features AS (
  SELECT l_orderkey AS row_id, CAST(SUM(l_quantity) AS DOUBLE) AS sum_qty,
         ROUND(SUM(l_extendedprice), 2) AS sum_price, ROUND(AVG(l_discount), 6) AS avg_disc,
         MAX(l_tax) AS max_tax, MIN(l_quantity) AS min_qty, MAX(o_totalprice) AS total_price,
         CAST(LEAST(COUNT(*), 9) AS INT) AS quality
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY l_orderkey)""",
    "line_features": """line_features AS (
  SELECT l_quantity, l_extendedprice, l_discount, l_tax, CAST(p_size AS DOUBLE) AS p_size, p_retailprice,
         CAST(CEIL(l_quantity / 10) AS INT) + 2 AS quality
  FROM lineitem JOIN part ON l_partkey = p_partkey)""",
    "doc_features": """doc_features AS (
  SELECT d.doc_id, CAST(d.n_chars AS DOUBLE) AS n_chars,
         CAST(LENGTH(d.text) - LENGTH(REPLACE(d.text, ' ', '')) AS DOUBLE) AS spaces,
         d.lang, d.source, l.quality
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)""",
    "event_values": "event_values AS (SELECT event_id, user_id, event_type, value FROM events)",
    "user_features": """user_features AS (
  SELECT user_id, CAST(COUNT(*) AS DOUBLE) AS n_events, ROUND(SUM(value), 4) AS sum_value,
         ROUND(AVG(value), 6) AS avg_value, MAX(value) AS max_value,
         CAST(SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS DOUBLE) AS n_errors
  FROM events GROUP BY user_id)""",
    "scored": """scored AS (
  SELECT row_id, quality AS label, 1 + sum_qty / 25.5 AS prediction,
         CAST(LEAST(GREATEST(ROUND_EVEN(1 + sum_qty / 25.5, 0), 1), 9) AS INT) AS pred_class
  FROM order_features)""",
}
_NEEDS = {"scored": ["order_features"]}


def with_views(names: str | list[str], body: str) -> str:
    """``WITH`` the named views (and what they need) followed by ``body``.

    ``body`` may start with further CTEs, each ending in a comma-free ``)`` and
    introduced by the word ``THEN``; otherwise it is the final SELECT.
    """
    wanted = [names] if isinstance(names, str) else list(names)
    ordered: list[str] = []
    for n in wanted:
        for dep in [*_NEEDS.get(n, []), n]:
            if dep not in ordered:
                ordered.append(dep)
    glue = ", " if body.lstrip().upper().startswith("THEN") else " "
    body = body.lstrip()[4:] if glue == ", " else body
    return "WITH " + ", ".join(SQL[n] for n in ordered) + glue + body


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: line aggregates, order total, line count as the class.

    Lines are aggregated before the join, on the join key, so the join reuses
    that partitioning and only order keys and totals are shuffled besides.
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("row_id"))
        .agg(
            F.sum("l_quantity").alias("sum_qty"),
            F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
            F.round(F.avg("l_discount"), 6).alias("avg_disc"),
            F.max("l_tax").alias("max_tax"),
            F.min("l_quantity").alias("min_qty"),
            F.least(F.count(F.lit(1)), F.lit(9)).cast("int").alias("quality"),
        )
    )
    totals = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_totalprice").alias("total_price"))
    return lines.join(totals, "row_id").select("row_id", *ORDER_COLS, "quality")


def line_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    return line.join(part, line.l_partkey == part.p_partkey).select(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax", F.col("p_size").cast("double").alias("p_size"), "p_retailprice",
        (F.ceil(F.col("l_quantity") / 10).cast("int") + 2).alias("quality"),
    )


def doc_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    gaps = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit("")))
    return (
        docs.select("doc_id", F.col("n_chars").cast("double").alias("n_chars"), gaps.cast("double").alias("spaces"), "lang", "source")
        .join(labels.select("doc_id", "quality"), "doc_id", "left")
    )


def event_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")


def user_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events").groupBy("user_id")
        .agg(
            F.count(F.lit(1)).cast("double").alias("n_events"),
            F.round(F.sum("value"), 4).alias("sum_value"),
            F.round(F.avg("value"), 6).alias("avg_value"),
            F.max("value").alias("max_value"),
            F.count_if(F.col("event_type") == "error").cast("double").alias("n_errors"),
        )
    )


def emb_features(spark: SparkSession, sf_dir: str, dims: int = 64) -> DataFrame:
    """One double column ``e1..e<dims>`` per embedding element."""
    emb = table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", "label", *[F.element_at("embedding", i).cast("double").alias(f"e{i}") for i in range(1, dims + 1)])


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A closed-form prediction, so every metric has an exact SQL counterpart."""
    pred = 1 + F.col("sum_qty") / 25.5
    return order_features(spark, sf_dir).select(
        "row_id", F.col("quality").alias("label"), pred.alias("prediction"),
        F.least(F.greatest(F.rint(pred), F.lit(1.0)), F.lit(9.0)).cast("int").alias("pred_class"),
    )
