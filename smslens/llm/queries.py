"""Registered queries of the training-data operators, each over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smslens.llm.alignment import align_documents
from smslens.llm.common import small_batches, table
from smslens.llm.decontamination import contaminated
from smslens.llm.exact_dedup import exact_groups
from smslens.llm.jaccard import jaccard_components
from smslens.llm.language import fit_languages, predict_languages
from smslens.llm.line_dedup import dedup_lines
from smslens.llm.mixing import mix_sources
from smslens.llm.negatives import hard_negatives
from smslens.llm.packing import pack_documents
from smslens.llm.quality import quality_scores
from smslens.llm.repeats import strip_repeats
from smslens.llm.secrets import scan_secrets
from smslens.llm.sharding import interleave_shards

Query = Callable[[SparkSession, str], DataFrame]


def op1_simhash_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that occur before, exactly or nearly."""
    return dedup_lines(table(spark, sf_dir, "documents"))


def op2_randomness_battery(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document: patterns, and tokens that pass for random."""
    return scan_secrets(table(spark, sf_dir, "documents"))


def op3_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens in windows of 2048, filled with related documents."""
    small_batches(spark)
    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 1)


def op4_quality_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by boosted trees over its statistics."""
    small_batches(spark)
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("stats")


def op5_interleaved_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 shards of equal row counts."""
    placed = interleave_shards(table(spark, sf_dir, "documents"), 40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "source", "rank")


def op6_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items whose words they cover."""
    small_batches(spark)
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_grace_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts and the row of each that stays."""
    small_batches(spark)
    return exact_groups(table(spark, sf_dir, "documents"))


def op8_prefix_free_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 100-byte strings that start earlier in the corpus."""
    small_batches(spark)
    return strip_repeats(table(spark, sf_dir, "documents"))


def op9_multi_order_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose three-word shingles agree to nine tenths."""
    small_batches(spark)
    return jaccard_components(table(spark, sf_dir, "documents"))


def op10_nearest_centroid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by its nearest centroid."""
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    return predict_languages(docs, fit_languages(docs))


def op11_token_incidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens of two tokenizers, their overlaps and groups."""
    small_batches(spark)
    return align_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_segment_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every fiftieth vector, some labels moved on by one."""
    small_batches(spark)
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved))


def op13_budget_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the words that the mix takes of it."""
    return mix_sources(table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Query] = {
    "op1_simhash_lines": op1_simhash_lines,
    "op2_randomness_battery": op2_randomness_battery,
    "op3_bm25_packing": op3_bm25_packing,
    "op4_quality_trees": op4_quality_trees,
    "op5_interleaved_shards": op5_interleaved_shards,
    "op6_string_tiling": op6_string_tiling,
    "op7_grace_dedup": op7_grace_dedup,
    "op8_prefix_free_parsing": op8_prefix_free_parsing,
    "op9_multi_order_jaccard": op9_multi_order_jaccard,
    "op10_nearest_centroid": op10_nearest_centroid,
    "op11_token_incidence": op11_token_incidence,
    "op12_segment_summaries": op12_segment_summaries,
    "op13_budget_mix": op13_budget_mix,
}

#: DuckDB SQL of the queries that SQL can express.
LLM_SQL: dict[str, str] = {
    "op7_grace_dedup": r"""
        WITH base AS (
            SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM documents
        ), ranked AS (
            SELECT doc_id, text_sha256, count(*) OVER (PARTITION BY text_sha256) AS group_size,
                   row_number() OVER best AS place, first_value(doc_id) OVER best AS keep_id
            FROM base WINDOW best AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
        )
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM ranked""",
    "op12_segment_summaries": """
        WITH v AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), scored AS (
            SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.e, b.e) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
        ), positive AS (
            SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
        )
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, other AS negative_id, positive_score, score AS negative_score
        FROM positive JOIN scored USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other)
        QUALIFY row_number() OVER w <= 3
    """,
}
