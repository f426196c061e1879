"""The queries of this subpackage: each operator with its production parameters over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from inkwright.llm import exact_dedup, license_scan, line_dedup, media, mixing, near_dedup, packing, token_counts, token_ids, toxicity, workspace


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    with workspace.Scratch(spark) as scratch:
        shards = token_ids.write_token_ids(_documents(spark, sf_dir), scratch.path("shards"))
        return scratch.keep(token_ids.read_token_ids(spark, shards, digest=True))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    labels, categories = toxicity.by_language(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.score(docs, toxicity.train(docs, labels, categories))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [F.col("doc_id"), F.col("n_lines"), F.col("n_dropped"), F.length("text").alias("n_chars_kept"), F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256")]
    return line_dedup.line_dedup(_documents(spark, sf_dir), columns=columns)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(_documents(spark, sf_dir))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(_documents(spark, sf_dir))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.best_fit_packing(_documents(spark, sf_dir))


def op7_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    with workspace.Scratch(spark) as scratch:
        out = scratch.path("archives")
        written = media.write_archives(_documents(spark, sf_dir), out)
        return scratch.keep(media.features(media.read_archives(spark, out, [uri for uri, _ in written])))


def quality_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents of good quality weigh 2, of poor quality 0.5; the others 1."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return labels.where("doc_id is not null and quality is not null").select("doc_id", F.when(F.col("quality") == 1, 2.0).otherwise(0.5).alias("weight"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir), quality_weights(spark, sf_dir))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(_documents(spark, sf_dir))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir))


OP5_SQL = """
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[ \\t\\n\\x0B\\x0C\\r]+', ' ', 'g')) AS text_sha256 FROM documents),
c AS (SELECT (min(doc_id) + max(doc_id)) // 2 AS cut FROM documents),
g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size, bool_or(doc_id > cut) AS new, bool_or(doc_id <= cut) AS old FROM d, c GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256,
  CASE WHEN new AND old THEN 'both' WHEN new THEN 'batch' ELSE 'snapshot' END AS seen_in
FROM d JOIN g USING (text_sha256)
"""

OP8_SQL = """
WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\x0C\\r]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS weight, CAST(2 * source_size AS DOUBLE) AS cap FROM s),
l AS (SELECT *, (1.5 * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0))
  / sum(weight) OVER (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT source, source_size, cap, weight, max(CASE WHEN level * weight <= cap THEN level END) OVER () AS level FROM l),
b AS (SELECT source, source_size, CASE WHEN level IS NULL THEN cap ELSE least(cap, level * weight) END AS target FROM t),
e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs, CAST(round(target) AS BIGINT) AS goal FROM b),
q AS (SELECT doc_id, CASE WHEN max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) = 1 THEN 2.0 ELSE 0.5 END AS weight FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
k AS (SELECT d.*, source_size, target, epochs, goal - epochs * source_size AS rest,
  -ln((CAST(CAST('0x' || substr(md5('0/' || d.doc_id || '/' || size), 1, 12) AS UBIGINT) AS DOUBLE) + 0.5) / 281474976710656.0) / coalesce(q.weight, 1.0) AS key
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source LEFT JOIN q ON d.doc_id = q.doc_id)
SELECT doc_id, size, source_size, target,
  CAST(epochs * size + greatest(0, least(size, rest - (sum(size) OVER (PARTITION BY source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size))) AS BIGINT) AS taken
FROM k
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_token_ids, op2_toxicity, op3_line_dedup, op4_license_scan, op5_exact_dedup, op6_best_fit_packing, op7_media_columns, op8_mixing, op9_near_dedup, op10_token_counts)}


def oracle_sql() -> dict[str, str]:
    return {"op5_exact_dedup": OP5_SQL, "op8_mixing": OP8_SQL}
