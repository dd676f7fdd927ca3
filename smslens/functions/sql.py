"""Optional SQL names for the text functions."""

from __future__ import annotations

from pyspark.sql import SparkSession

from smslens.functions.text import WHITESPACE_RUN, sql_text


def register_sql_functions(spark: SparkSession) -> None:
    """``normalize_message(text)`` and ``template_id(text)`` for SQL; both are inlined into the plan."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION normalize_message(t STRING) RETURNS STRING"
        f" RETURN trim(regexp_replace(lower(coalesce(t, '')), {sql_text(WHITESPACE_RUN)}, ' '))"
    )
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION template_id(t STRING) RETURNS STRING RETURN substring(md5(t), 1, 16)")
