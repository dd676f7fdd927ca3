"""Text normalisation over message tables, and its report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from smslens.functions.text import normalize_text


def with_normalized(df: DataFrame, column: str = "Message", output: str = "NormalizedMessage") -> DataFrame:
    """Add the normalised text; unchanged when the message column is absent."""
    return df.withColumn(output, normalize_text(column)) if column in df.columns else df


def normalization_report(df: DataFrame, before: str = "Message", after: str = "NormalizedMessage") -> DataFrame:
    """One row: rows, rows changed and their share, characters before / after / removed, longest text."""
    b, a = F.coalesce(F.col(before), F.lit("")), F.coalesce(F.col(after), F.lit(""))
    sums = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(b != a).alias("changed"),
        F.coalesce(F.sum(F.length(b)), F.lit(0)).cast("bigint").alias("chars_before"),
        F.coalesce(F.sum(F.length(a)), F.lit(0)).cast("bigint").alias("chars_after"),
        F.coalesce(F.max(F.length(b)), F.lit(0)).cast("bigint").alias("max_length_before"),
        F.coalesce(F.max(F.length(a)), F.lit(0)).cast("bigint").alias("max_length_after"),
    )
    share = F.when(F.col("total") > 0, 100.0 * F.col("changed") / F.col("total")).otherwise(F.lit(0.0))
    return sums.select(
        "total", "changed", share.cast("double").alias("changed_pct"), "chars_before", "chars_after",
        (F.col("chars_before") - F.col("chars_after")).alias("chars_removed"),
        "max_length_before", "max_length_after",
    )


def changed_samples(df: DataFrame, order_by: str, n: int = 5, before: str = "Message", after: str = "NormalizedMessage") -> DataFrame:
    """The first n rows whose text changed."""
    differs = F.coalesce(F.col(before), F.lit("")) != F.col(after)
    return df.where(differs).select(order_by, before, after).orderBy(order_by).limit(n)
