"""Phone scoring from the lake to documents."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame

from smslens.operators.scoring import categorise, score_documents
from smslens.sources.lake import scan_messages


def score_phones(
    lake: DataFrame, requests: DataFrame, lookup: DataFrame, as_of: date, generated_at: str, lookback_days: int = 365, request_reference: str | None = None
) -> DataFrame:
    """One document per requested phone (ordinal, phone_number); one scan however many phones are asked for."""
    messages = scan_messages(lake, requests, as_of, lookback_days)
    return score_documents(requests, categorise(messages, lookup), generated_at, lookback_days, request_reference)
