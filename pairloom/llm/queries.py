"""The queries of the training-data operators, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exact_dedup, mixing, packing, quality, simhash, substring_dedup, token_counts, topk, toxicity, warc


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_read(spark, sf_dir, "documents"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _read(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter(F.col("vec_id") % 50 == 0))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(_read(spark, sf_dir, "documents"))


def op4_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read_archive(spark, warc.write_archive(_read(spark, sf_dir, "pages")))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_read(spark, sf_dir, "documents"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_dedup(_read(spark, sf_dir, "documents"))


def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return quality.quality(docs, quality.fit(docs, _read(spark, sf_dir, "labels")))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_read(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_read(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return toxicity.toxicity(docs, toxicity.fit(docs, _read(spark, sf_dir, "labels")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_warc_archive": op4_warc_archive,
    "op5_best_fit_packing": op5_best_fit_packing,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_line_quality": op7_line_quality,
    "op8_mix_sources": op8_mix_sources,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_toxicity": op10_toxicity,
}

ORACLES: dict[str, str] = {
    "op2_exact_top_k": """
        WITH part AS (
          SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
          FROM embeddings
          WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
          SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
          FROM part a JOIN part b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id AND len(a.q) = len(b.q)),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
        SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op3_suffix_array_dedup": """
        WITH b AS (
          SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h, octet_length(encode(coalesce(text, ''))) AS n
          FROM documents),
        parts AS (SELECT r, 1000 * o AS base, substr(h, 2000 * o + 1, 2398) AS part FROM (SELECT r, h, unnest(range((n + 800) // 1000)) AS o FROM b WHERE n >= 200)),
        starts AS (SELECT r, base, part, unnest(range(len(part) // 2 - 199)) AS i FROM parts),
        strings AS (SELECT r, base + i AS p, sha256(substr(part, 2 * i + 1, 400)) AS s FROM starts),
        twice AS (SELECT r, p FROM strings WHERE s IN (SELECT s FROM strings GROUP BY s HAVING count(*) > 1)),
        marked AS (SELECT r, p, coalesce(p > lag(p) OVER (PARTITION BY r ORDER BY p) + 200, true) AS opens FROM twice),
        runs AS (SELECT r, p, count_if(opens) OVER (PARTITION BY r ORDER BY p) AS run FROM marked),
        spans AS (SELECT r, min(p) AS a, max(p) + 200 AS z FROM runs GROUP BY r, run),
        gaps AS (
          SELECT r, a, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS since FROM spans
          UNION ALL SELECT b.r, b.n, coalesce(max(z), 0) FROM b LEFT JOIN spans USING (r) GROUP BY b.r, b.n),
        kept AS (SELECT g.r, string_agg(substr(b.h, 2 * since + 1, 2 * (a - since)), '' ORDER BY since) AS k FROM gaps g JOIN b USING (r) GROUP BY g.r),
        sums AS (SELECT r, sum(z - a) AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
        SELECT doc_id, n AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(k)) AS kept_sha256
        FROM b JOIN kept USING (r) LEFT JOIN sums USING (r)
    """,
    "op4_warc_archive": """
        WITH t AS (
          SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
          FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM t),
        r AS (SELECT *, payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id AS again FROM f)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN again THEN first_id END AS refers_to
        FROM r
    """,
    "op9_exact_dedup": r"""
        WITH t AS (
          SELECT doc_id, length(coalesce(text, '')) AS n_points,
                 sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
          FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY text_sha256) AS group_size,
               row_number() OVER w = 1 AS kept,
               text_sha256
        FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY n_points DESC, doc_id)
    """,
}
