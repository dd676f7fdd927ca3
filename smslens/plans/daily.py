"""The daily batch: read, normalise, extract, count, classify, write."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from smslens.operators.cascade import cascade
from smslens.operators.classify import classify_rules
from smslens.operators.frequency import template_frequency, templates_of
from smslens.sources import outputs
from smslens.sources.jsonl import RESULT_SCHEMA
from smslens.sources.messages import check_required, delivered_only, select_days


@dataclass(frozen=True)
class DayPaths:
    """Where a run writes."""

    root: str

    def of(self, name: str) -> str:
        return f"{self.root}/{name}"


def classified_templates(messages: DataFrame, include_pure: bool = False, rules=None) -> DataFrame:
    """Counted unique templates of raw messages with their level-0 result, as one lazy plan."""
    return classify_rules(template_frequency(delivered_only(messages), include_pure=include_pure), rules)


def as_log_rows(classified: DataFrame) -> DataFrame:
    """Level-0 results in the layout of the result log."""
    named = classified.withColumn("metadata", F.struct("rule_name", F.lit(None).cast("string").alias("error"), F.lit(None).cast("string").alias("error_type")))
    layout = T.StructType.fromDDL(RESULT_SCHEMA)
    columns = [F.col(f.name) if f.name in named.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in layout.fields]
    return named.select(*columns)


def run_day(messages: DataFrame, paths: DayPaths, run_date: str, source: str = "", day: int | None = None, include_pure: bool = False, split: bool = True, known: DataFrame | None = None, model=None) -> DataFrame:
    """Write one run and return its metadata row.

    ``known`` (classified templates) and ``model`` (a ``learn.CascadeModel``) add the levels between rules and judges to
    the classifications written; the metadata counts the rules' results as before.

    The messages are read once for the counts (and once more when ``split`` keeps the message-level
    tables).  Everything later starts from the written counts.
    """
    spark = messages.sparkSession
    delivered = delivered_only(check_required(messages))
    if split:
        outputs.write_split(templates_of(delivered).withColumnRenamed("Message", "original_message"), paths.of("templates"), run_date)
    outputs.write_unique_templates(template_frequency(delivered, include_pure=True), paths.of("unique_templates"), run_date)
    freq = read_unique_templates(spark, paths, run_date)
    chosen = freq if include_pure else freq.where(F.size("applied_rules") > 0)
    classified = classify_rules(chosen)
    results = classified if known is None and model is None else cascade(classified, known, model=model)
    outputs.write_results(as_log_rows(results), paths.of("rule_classifications"), run_date)
    metadata = outputs.run_metadata(freq, classified, run_date, source, day)
    outputs.write_metadata(metadata, paths.of("metadata"))
    return spark.read.schema(metadata.schema).json(paths.of("metadata")).where(F.col("run_date") == run_date)


UNIQUE_SCHEMA = (
    "template_id string, template_text string, applied_rules array<string>, client_name string, frequency bigint,"
    " first_seen timestamp_ntz, last_seen timestamp_ntz, run_date string"
)


def read_unique_templates(spark: SparkSession, paths: DayPaths, run_date: str) -> DataFrame:
    return spark.read.schema(UNIQUE_SCHEMA).json(paths.of("unique_templates")).where(F.col("run_date") == run_date).drop("run_date")


def run_days(messages: DataFrame, paths: DayPaths, days, run_date: str, day_column: str = "day") -> dict[int, str]:
    """One run per day of the month; a failing day is recorded and the others go on.  Returns day -> status."""
    status = {}
    for day in days:
        try:
            run_day(select_days(messages, day, day_column), DayPaths(paths.of(f"day={day}")), run_date, day=day)
            status[day] = "ok"
        except Exception as e:  # the caller decides what to do with failed days
            status[day] = f"failed: {type(e).__name__}: {str(e)[:200]}"
    return status
