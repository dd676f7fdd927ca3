"""Templates with placeholders and pure texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def with_placeholders(templates: DataFrame) -> DataFrame:
    return templates.where(F.size("applied_rules") > 0)


def pure_texts(templates: DataFrame) -> DataFrame:
    return templates.where(F.size("applied_rules") == 0)


def split_templates(templates: DataFrame) -> DataFrame:
    """Mark each row by whether any rule fired; both groups keep all columns."""
    return templates.withColumn("has_placeholder", F.size("applied_rules") > 0)


def split_summary(templates: DataFrame) -> DataFrame:
    """One row: total, rows in each group, placeholder ratio (0.0 when empty)."""
    fired = F.size("applied_rules") > 0
    return templates.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(fired).alias("with_placeholders"),
        F.count_if(~fired).alias("pure"),
        F.coalesce(F.avg(fired.cast("double")), F.lit(0.0)).alias("placeholder_ratio"),
    )
