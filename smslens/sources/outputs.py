"""Writing the results of a run, by run date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from smslens.operators.split import split_templates
from smslens.sources.jsonl import JSON_TIMES

LOG_COLUMNS = (
    "template_id", "template_text", "original_message", "cleaned_message", "phone_number", "status_id", "client_name",
    "timestamp", "operator_name", "applied_rules",
)


def _category() -> Column:
    return F.when(F.size("applied_rules") > 0, F.lit("with_placeholders")).otherwise(F.lit("pure_messages"))


def append_template_log(templated: DataFrame, path: str) -> None:
    """Append every templated message to the log of its group (JSON lines, one folder per group)."""
    present = [c for c in LOG_COLUMNS if c in templated.columns]
    templated.select(*present, _category().alias("category")).write.mode("append").partitionBy("category").options(**JSON_TIMES).json(path)


def _replace_day(writer):
    """Rewrite only the partitions the data touches."""
    return writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")


def write_split(templated: DataFrame, path: str, run_date: str) -> None:
    """Both groups as snappy parquet under run_date and has_placeholder; a rerun replaces its day."""
    rows = split_templates(templated)
    if "metadata" in rows.columns:
        rows = rows.withColumn("metadata", F.to_json("metadata"))
    rows = rows.withColumn("run_date", F.lit(run_date))
    _replace_day(rows.write).partitionBy("run_date", "has_placeholder").option("compression", "snappy").parquet(path)


def write_unique_templates(freq: DataFrame, path: str, run_date: str) -> None:
    """Counted unique templates as JSON lines."""
    _replace_day(freq.withColumn("run_date", F.lit(run_date)).write).partitionBy("run_date").options(**JSON_TIMES).json(path)


def write_results(results: DataFrame, path: str, run_date: str) -> None:
    """Classification results of a run as JSON lines."""
    _replace_day(results.withColumn("run_date", F.lit(run_date)).write).partitionBy("run_date").options(**JSON_TIMES).json(path)


def run_metadata(freq: DataFrame, classified: DataFrame, run_date: str, source: str, day: int | None = None) -> DataFrame:
    """One row: messages, unique templates and pure texts, and level-0 coverage.

    ``freq`` includes pure texts; ``classified`` is what went through level 0.
    """
    fired = F.size("applied_rules") > 0
    left = freq.agg(
        F.coalesce(F.sum("frequency"), F.lit(0)).alias("total_messages"),
        F.count_if(fired).alias("unique_templates"),
        F.count_if(~fired).alias("unique_pure_messages"),
    )
    hit = F.col("level_used") == "rule"
    level0 = classified.agg(F.struct(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("hits")).alias("l0")).scalar()
    row = left.withColumn("l0", level0).select("*", "l0.n", "l0.hits")
    pct = F.when(F.col("n") > 0, 100.0 * F.col("hits") / F.col("n")).otherwise(F.lit(0.0)).cast("double")
    return row.select(
        F.lit(run_date).alias("run_date"), F.lit(source).alias("source"), F.lit(day).cast("int").alias("day"),
        "total_messages", "unique_templates", "unique_pure_messages",
        F.struct(
            F.col("n").alias("total_classified"), F.col("hits").alias("matched_rules"),
            (F.col("n") - F.col("hits")).alias("pending"), pct.alias("coverage_percentage"),
        ).alias("l0_classification"),
    )


def write_metadata(row: DataFrame, path: str) -> None:
    _replace_day(row.write).partitionBy("run_date").options(**JSON_TIMES).json(path)


def write_classification_csv(export: DataFrame, path: str) -> None:
    """The label export with its published headers; the input of the phone-scoring lookup."""
    from smslens.sources.lookups import EXPORT_HEADERS

    columns = (
        "template_id", "template_text", "label", "category", "subcategory", "rule_name", "frequency", "confidence", "applied_rules",
    )
    named = export.select(*[F.col(c).alias(h) for c, h in zip(columns, EXPORT_HEADERS)])
    named.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
