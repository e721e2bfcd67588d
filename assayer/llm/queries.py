"""Queries of the text operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, bpe, katz, line_dedup, minhash, packing, pieces, pivots, secret_scan, simplex, suffixes, topk, toxicity
from .common import crc_of_id, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.classify(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query
def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"), F.col("__near").alias("n_near"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE["op7_line_dedup"] = """
WITH lines AS (
    SELECT doc_id, UNNEST(range(len(l))) AS number, UNNEST(l) AS line
    FROM (SELECT doc_id, string_split(COALESCE(text, ''), chr(10)) AS l FROM documents)
), distinct_lines AS (
    SELECT line, length(line) AS n, MIN({'d': doc_id, 'k': number}) AS first FROM lines
    WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY line
), halves AS (
    SELECT line, n, first, n + g AS l, s,
           CASE s WHEN 0 THEN left(line, (n + g - 1) // 2) ELSE right(line, (n + g - 1) // 2) END AS half
    FROM distinct_lines, (VALUES (0), (1)) AS g(g), (VALUES (0), (1)) AS s(s) WHERE n >= 20
), near AS (
    SELECT DISTINCT a.line FROM halves a JOIN halves b ON a.l = b.l AND a.s = b.s AND a.half = b.half
    WHERE b.first < a.first AND levenshtein(a.line, b.line) <= 1
), fate AS (
    SELECT l.doc_id, l.number, l.line, near.line IS NOT NULL AS near,
           near.line IS NOT NULL OR ({'d': l.doc_id, 'k': l.number} > d.first) AS gone
    FROM lines l LEFT JOIN distinct_lines d ON l.line = d.line LEFT JOIN near ON l.line = near.line
)
SELECT doc_id, CAST(COUNT(*) AS BIGINT) AS n_lines, CAST(COUNT(*) FILTER (WHERE gone) AS BIGINT) AS n_removed,
       CAST(COUNT(*) FILTER (WHERE gone AND near) AS BIGINT) AS n_near,
       sha256(COALESCE(string_agg(line, chr(10) ORDER BY number) FILTER (WHERE gone IS NOT TRUE), '')) AS kept_sha256
FROM fate GROUP BY doc_id
"""


@query
def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE["op1_topk_search"] = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, r.vec_id, CAST(list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM v q JOIN v r ON q.vec_id <> r.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op9_pivot_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE["op9_pivot_index"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.9
), reach AS (
    SELECT vec_id AS node, vec_id AS other FROM v
    UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT v.vec_id, (SELECT CAST(COUNT(*) AS BIGINT) FROM links WHERE a = v.vec_id) AS n_links, MIN(other) AS component_id, MIN(other) = v.vec_id AS kept
FROM v JOIN reach ON node = v.vec_id GROUP BY v.vec_id
"""


@query
def op2_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"), crc_of_id() % 10 == 0)


@query
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.digests(table(spark, sf_dir, "documents"))


@query
def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op11_nsimplex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simplex.report(simplex.fit(table(spark, sf_dir, "embeddings")))


def _rounds(k: int = 8, rounds: int = 10) -> str:
    """The rounds of the clustering, a table of assignments ``a<i>`` and one of centroids ``c<i>`` each."""
    parts = [f"""
c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS INTEGER) AS cluster, v FROM v WHERE vec_id IS NOT NULL
       ORDER BY sha256('3:' || vec_id), v LIMIT {k})"""]
    for i in range(rounds + 1):
        parts.append(f"""
a{i} AS MATERIALIZED (
    SELECT row, arg_min(cluster, {{'d': d, 'c': cluster}}) AS cluster, MIN(d) AS d
    FROM (SELECT row, cluster, CAST(list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT) AS d FROM v, c{i} c)
    GROUP BY row)""")
        if i < rounds:
            parts.append(f"""
c{i + 1} AS MATERIALIZED (
    SELECT cluster, COALESCE(m.v, c.v) AS v FROM c{i} c LEFT JOIN (
        SELECT cluster, list(x ORDER BY place) AS v FROM (
            SELECT cluster, place, (SUM(x)::BIGINT - ((SUM(x)::BIGINT % COUNT(*)) + COUNT(*)) % COUNT(*)) // COUNT(*) AS x
            FROM (SELECT cluster, UNNEST(v.v) AS x, UNNEST(range(64)) AS place FROM v JOIN a{i} USING (row)) GROUP BY cluster, place)
        GROUP BY cluster) m USING (cluster))""")
    return ",".join(parts)


ORACLE["op11_nsimplex"] = f"""
WITH v AS MATERIALIZED (
    SELECT vec_id, row_number() OVER () AS row, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), {_rounds()}
SELECT vec_id, cluster, a.d AS distance, CAST(SUM(a.d) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia, CAST(SUM(a.d) OVER () AS BIGINT) AS inertia,
       sha256(list_aggregate(c.v, 'string_agg', ',')) AS centroid_sha256
FROM v JOIN a10 a USING (row) JOIN c10 c USING (cluster)
"""


@query
def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(table(spark, sf_dir, "documents"))


@query
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE["op13_filter_audit"] = r"""
WITH docs AS (
    SELECT doc_id, COALESCE(text, '') AS text, COALESCE(source, '') AS part,
           list_filter(string_split_regex(COALESCE(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words FROM documents
), firsts AS (SELECT text, MIN(doc_id) AS first FROM docs GROUP BY text
), marks AS (
    SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), flagged AS (
    SELECT part, COALESCE(good, FALSE) AS good, COALESCE(toxic, FALSE) AS toxic,
           CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 5 * length(d.text) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(d.text, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN d.doc_id > first THEN 'E' ELSE '' END AS fails
    FROM docs d JOIN firsts USING (text) LEFT JOIN marks USING (doc_id)
), counts AS (SELECT part, fails, good, toxic, COUNT(*) AS n FROM flagged GROUP BY ALL
), letters(f) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')
), orders AS (
    SELECT a.f || b.f || c.f || d.f || e.f AS filter_order FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
    SELECT filter_order, step, filter_order[step] AS own, left(filter_order, step - 1) AS earlier FROM orders, (SELECT CAST(UNNEST(range(1, 6)) AS INTEGER) AS step)
), met AS (
    SELECT part, filter_order, step, own, fails, good, toxic, n, contains(fails, own) AS failing, translate(fails, earlier, '') <> fails AS gone FROM counts, steps
), summed AS (
    SELECT part, filter_order, step, own,
           SUM(CASE WHEN NOT failing AND NOT gone THEN n ELSE 0 END) AS kept, SUM(CASE WHEN failing AND NOT gone THEN n ELSE 0 END) AS removed,
           SUM(CASE WHEN failing AND gone THEN n ELSE 0 END) AS redundant, SUM(CASE WHEN fails = own THEN n ELSE 0 END) AS unique_fails,
           SUM(CASE WHEN failing AND NOT gone AND good THEN n ELSE 0 END) AS good_lost, SUM(CASE WHEN failing AND NOT gone AND toxic THEN n ELSE 0 END) AS toxic_lost
    FROM met GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(SUM(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM summed
"""
