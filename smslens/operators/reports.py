"""Reports on classified templates (template_id, template_text, applied_rules, frequency, label, ...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from smslens.operators.joins import share_of_listed


def _labelled(classified: DataFrame) -> DataFrame:
    return classified.where(F.trim("label") != "")


def label_report(classified: DataFrame) -> DataFrame:
    """Per label: messages, templates, rules, mean confidence, rank and share of all labelled messages.

    The ranking window runs over one row per label.
    """
    per_label = (
        _labelled(classified)
        .groupBy("label", "category", "subcategory")
        .agg(
            F.sum("frequency").alias("frequency"),
            F.count(F.lit(1)).alias("templates"),
            F.array_join(F.sort_array(F.collect_set("rule_name")), ", ").alias("rules"),
            F.avg("confidence").alias("avg_confidence"),
        )
    )
    rank = F.row_number().over(Window.orderBy(F.desc("frequency"), "label"))
    return per_label.withColumn("share", share_of_listed("frequency")).withColumn("rank", rank)


def label_export(classified: DataFrame) -> DataFrame:
    """Every labelled template, most frequent first; rules joined, confidence with two decimals."""
    return (
        _labelled(classified)
        .select(
            "template_id", "template_text", "label", "category", "subcategory", "rule_name", "frequency",
            F.format_string("%.2f", "confidence").alias("confidence"),
            F.array_join("applied_rules", ", ").alias("applied_rules"),
        )
        .orderBy(F.desc("frequency"), "template_id")
    )


def pending_top(classified: DataFrame, n: int = 100) -> DataFrame:
    """The n most frequent pending templates with rank and percentage of their own total."""
    best = (
        classified.where(F.col("level_used") == "pending")
        .select("template_id", "template_text", "frequency", "applied_rules")
        .orderBy(F.desc("frequency"), "template_id")
        .limit(n)
    )
    rank = F.row_number().over(Window.orderBy(F.desc("frequency"), "template_id"))
    return best.withColumn("rank", rank).withColumn("pct", 100.0 * share_of_listed("frequency"))


def pending_summary(pending: DataFrame) -> DataFrame:
    """One row over pending_top: count, total, mean, largest, smallest frequency (zeros when empty)."""

    def zero(c):
        return F.coalesce(c, F.lit(0))

    return pending.agg(
        F.count(F.lit(1)).alias("templates"),
        zero(F.sum("frequency")).alias("total"),
        zero(F.avg("frequency")).alias("mean"),
        zero(F.max("frequency")).alias("largest"),
        zero(F.min("frequency")).alias("smallest"),
    )


def pending_rules(pending: DataFrame, n: int = 20) -> DataFrame:
    """Most common extraction rules among the given pending templates."""
    fired = pending.select(F.explode("applied_rules").alias("rule_name"))
    return fired.groupBy("rule_name").agg(F.count(F.lit(1)).alias("templates")).orderBy(F.desc("templates"), "rule_name").limit(n)
