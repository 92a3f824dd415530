"""The queries of this subpackage, over the driver's tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from candlespark.llm import boosted_rules, exact_dedup, jaccard_join, kernel_classifier, licences, mixing, packing, pseudonyms, token_files, warc

#: Keys the pseudonyms of op8; in production a secret, here fixed so that reruns agree.
PSEUDONYM_KEY = b"a fixed key for the test tables"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return boosted_rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kernel_classifier.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op5_length_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rule = jaccard_join.Rule(words=3, num=90, den=100)
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), rule).select("doc_id", "n_shingles", "component_id")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    manifest, lengths = token_files.write_token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2)
    return token_files.read_token_files(manifest, lengths)


def op8_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonyms.pseudonyms(table(spark, sf_dir, "documents"), PSEUDONYM_KEY)


def op9_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.resolved(warc.write_archives(table(spark, sf_dir, "pages")))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.licence_scan(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_mix_sources": op2_mix_sources,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_length_buckets": op5_length_buckets,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_token_files": op7_token_files,
    "op8_pseudonyms": op8_pseudonyms,
    "op9_warc_revisits": op9_warc_revisits,
    "op10_licence_scan": op10_licence_scan,
}

OP9_SQL = r"""
WITH r AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages
), g AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS original FROM r
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < original THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < original THEN original END AS refers_to
FROM g
"""

OP4_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm, length(coalesce(text, '')) AS n_chars FROM documents
)
SELECT doc_id,
  first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id) AS keep_id,
  count(*) OVER (PARTITION BY norm) AS group_size,
  doc_id = first_value(doc_id) OVER (PARTITION BY norm ORDER BY n_chars DESC, doc_id) AS kept,
  sha256(norm) AS text_sha256
FROM n
"""

OP6_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [words]
    ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i:i + 2])) END AS shingles FROM w
), sets AS (
  SELECT min(doc_id) AS node, list_sort(shingles) AS shingles, len(shingles) AS n FROM s GROUP BY 2, 3
), cells AS (
  SELECT node, n, unnest(shingles) AS shingle FROM sets
), pairs AS (
  SELECT a.node AS x, b.node AS y, a.n AS nx, b.n AS ny, count(*) AS shared FROM cells a JOIN cells b ON a.shingle = b.shingle AND a.node < b.node
    AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n) GROUP BY ALL
), links AS (
  SELECT x, y FROM pairs WHERE 100 * shared >= 90 * (nx + ny - shared) UNION ALL SELECT y, x FROM pairs WHERE 100 * shared >= 90 * (nx + ny - shared)
), reach AS (
  SELECT node, node AS met FROM sets WHERE n > 0
  UNION
  SELECT r.node, l.y FROM reach r JOIN links l ON l.x = r.met
), roots AS (
  SELECT node, min(met) AS root FROM reach GROUP BY node
)
SELECT s.doc_id, CAST(len(s.shingles) AS BIGINT) AS n_shingles, coalesce(r.root, s.doc_id) AS component_id
FROM s LEFT JOIN sets t ON list_sort(s.shingles) = t.shingles AND t.n > 0 LEFT JOIN roots r ON t.node = r.node
"""

ORACLE_SQL: dict[str, str] = {
    "op2_mix_sources": mixing.ORACLE_SQL,
    "op4_exact_dedup": OP4_SQL,
    "op6_jaccard_join": OP6_SQL,
    "op9_warc_revisits": OP9_SQL,
    "op10_licence_scan": licences.oracle_sql(),
}
