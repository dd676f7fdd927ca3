"""JSON-lines tables: tolerant reads and the append-only result log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

CORRUPT = "_corrupt_record"

RESULT_SCHEMA = (
    "template_id string, template_text string, applied_rules array<string>, frequency bigint, label string,"
    " category string, subcategory string, confidence double, level_used string, agreement boolean,"
    " panel_judge_1 string, panel_judge_1_conf double, panel_judge_2 string, panel_judge_2_conf double,"
    " arbiter_label string, arbiter_abstained boolean, arbiter_reasoning string, needs_human_review boolean,"
    " is_synthetic boolean, classified_at string,"
    " metadata struct<rule_name: string, error: string, error_type: string>"
)


#: Without these Spark writes times to the millisecond; its default reader takes either.
JSON_TIMES = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def parse_lines(lines: DataFrame, schema: str, column: str = "value") -> tuple[DataFrame, DataFrame]:
    """Split text lines into (records, rejected lines) by a DDL schema.  Blank lines are neither."""
    with_corrupt = f"{schema}, {CORRUPT} string"
    text = F.trim(F.col(column))
    parsed = lines.where(text != "").select(
        F.col(column).alias("line"),
        F.from_json(text, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"),
    )
    broken = F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull()
    good = parsed.where(~broken).select("r.*").drop(CORRUPT)
    return good, parsed.where(broken).select("line")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejected lines) of a JSON-lines file or folder; a missing path raises."""
    return parse_lines(spark.read.text(path), schema)


def append_results(results: DataFrame, path: str) -> None:
    """Append classification results to the log."""
    results.write.mode("append").options(**JSON_TIMES).json(path)


def read_results(spark: SparkSession, path: str) -> DataFrame:
    """All readable results of the log."""
    return read_jsonl(spark, path, RESULT_SCHEMA)[0]


def processed_ids(results: DataFrame) -> DataFrame:
    """Distinct template ids already in a log."""
    return results.where(F.col("template_id").isNotNull()).select("template_id").distinct()


def not_processed(templates: DataFrame, done: DataFrame, limit: int | None = None) -> DataFrame:
    """Templates whose id is not in ``done``; with a limit, the most frequent ones."""
    rest = templates.join(done.select("template_id"), "template_id", "left_anti")
    return rest if limit is None else rest.orderBy(F.desc("frequency"), "template_id").limit(limit)
