"""Classification that continues where an earlier run stopped."""

from __future__ import annotations

from pyspark.sql import DataFrame

from smslens.operators.classify import classify_rules
from smslens.operators.votes import DEFAULT_THRESHOLD, resolve_votes
from smslens.sources.jsonl import not_processed, processed_ids


def classify_remaining(
    templates: DataFrame, log: DataFrame, votes: DataFrame, arbiter: DataFrame, limit: int | None = None, threshold: float = DEFAULT_THRESHOLD, rules=None
) -> DataFrame:
    """Results for the templates that the log does not have yet."""
    rest = not_processed(templates, processed_ids(log), limit)
    return resolve_votes(classify_rules(rest, rules), votes, arbiter, threshold)
