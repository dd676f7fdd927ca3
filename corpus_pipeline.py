"""Corpus pipeline: from raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.  All but the last return the
columns they were given.  Rows are judged by their own text; null and repeated ids are told apart by it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from smslens.llm.common import small_batches, stored, table
from smslens.llm.decontamination import drop_contaminated
from smslens.llm.jaccard import keep_one_of_each
from smslens.llm.line_dedup import drop_repeated_lines
from smslens.llm.packing import pack_documents
from smslens.llm.quality import document_statistics, fit_quality, score_texts

QUALITY = 0.3


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the boosted trees score 0.3 or more."""
    small_batches(spark)
    model = fit_quality(stored(document_statistics(docs)), table(spark, sf_dir, "labels"))
    return score_texts(docs, model, score_col="_quality").where(F.col("_quality") >= QUALITY).drop("_quality")


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that occur before, exactly or nearly."""
    return drop_repeated_lines(docs)


def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of five-word shingle sets at Jaccard 0.8 or more."""
    small_batches(spark)
    return keep_one_of_each(docs, length=5, percent=80)


def benchmark_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark item's tiles cover by half."""
    small_batches(spark)
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token windows of 2048, as pieces with their ids."""
    small_batches(spark)
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 1, with_ids=True)


STAGES = [
    ("quality classifier", quality_filter),
    ("line dedup", line_filter),
    ("n-gram Jaccard join", near_duplicate_filter),
    ("benchmark decontamination", benchmark_filter),
    ("packing", pack),
]

#: Trees, SimHash and tokens are beyond SQL; the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each stage's result stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
