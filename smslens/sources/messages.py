"""Reading raw message tables (parquet) in batch."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from smslens.functions.text import clean_string
from smslens.functions.vocabulary import DELIVERED_STATUS

# Raw column -> (canonical column, kind), in output order of the typed projection.
REQUIRED = {
    "Message": ("message", "text"),
    "PhoneNumber": ("phone_number", "raw"),
    "StatusId": ("status_id", "int"),
    "ClientId": ("client_id", "bigint"),
    "ClientName": ("client_name", "string"),
    "PriorityId": ("priority_id", "bigint"),
    "PriorityDescription": ("priority_description", "string"),
    "OperatorName": ("operator_name", "string"),
    "ArrivalDate": ("timestamp", "timestamp_ntz"),
    "AccountName": ("account_name", "string"),
}
OPTIONAL = {
    "SenderId": ("sender_id", "string"),
    "OperatorId": ("operator_id", "bigint"),
    "AccountId": ("account_id", "bigint"),
    "MTMessageId": ("mt_message_id", "bigint"),
    "TransactionNumber": ("transaction_number", "string"),
    "CampaignName": ("campaign_name", "string"),
    "Segments": ("segments", "count int"),
    "Part": ("part", "count int"),
    "Attempt": ("attempt", "count bigint"),
    "Tool": ("tool", "int"),
    "RequestIp": ("request_ip", "string"),
    "Variables": ("variables", "string"),
}


def missing_columns(df: DataFrame) -> list[str]:
    return sorted(set(REQUIRED) - set(df.columns))


def check_required(df: DataFrame) -> DataFrame:
    """df itself, or ValueError naming the missing and the available columns."""
    missing = missing_columns(df)
    if missing:
        raise ValueError(f"missing required columns: {missing}; available: {sorted(df.columns)}")
    return df


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """One parquet table; a missing path raises."""
    return spark.read.parquet(path)


def delivered_only(df: DataFrame) -> DataFrame:
    """Rows with the delivered status; a null status is dropped, and so is text that is no number."""
    status = F.col("StatusId")
    if isinstance(df.schema["StatusId"].dataType, T.StringType):
        status = status.try_cast("double")
    return df.where(status == DELIVERED_STATUS)


def _typed(raw: str, kind: str, dtype: T.DataType | None) -> Column:
    if dtype is None:
        return F.lit(1).cast(kind.split()[1]) if kind.startswith("count") else F.lit(None).cast("string" if kind in ("text", "raw") else kind)
    c = F.col(raw)
    if kind == "text":
        return F.coalesce(c.cast("string"), F.lit(""))
    if kind == "raw":
        return c.cast("string")
    if kind == "string":
        return clean_string(c)
    if isinstance(dtype, T.StringType):
        c = F.trim(c)
    if kind.startswith("count"):
        number = c.try_cast(kind.split()[1])
        return F.coalesce(F.nullif(number, F.lit(0)), F.lit(1)).cast(kind.split()[1])
    return c.try_cast(kind)


def typed_messages(df: DataFrame) -> DataFrame:
    """Raw columns to canonical names and types; cells that do not parse become null.

    A row whose status is not a number is dropped.  Optional columns that are absent are null
    (segments, part and attempt: 1).
    """
    check_required(df)
    types = {f.name: f.dataType for f in df.schema.fields}
    status = _typed("StatusId", "int", types["StatusId"])
    columns = [_typed(raw, kind, types.get(raw)).alias(name) for raw, (name, kind) in {**REQUIRED, **OPTIONAL}.items()]
    return df.where(status.isNotNull()).select(*columns)


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Delivered rows with canonical names and types."""
    return typed_messages(delivered_only(check_required(read_raw(spark, path))))


def read_messages_raw(spark: SparkSession, path: str) -> DataFrame:
    """Delivered rows with the raw columns."""
    return delivered_only(read_raw(spark, path))


def first_messages(df: DataFrame, limit: int = 100_000, order_by: str = "MTMessageId") -> DataFrame:
    """The first ``limit`` delivered rows by an explicit key (files have no order in Spark)."""
    return delivered_only(df).orderBy(order_by).limit(limit)


def select_days(df: DataFrame, days, column: str = "day") -> DataFrame:
    """Rows of the given days of the month; None keeps all.  A partition column prunes files."""
    if days is None:
        return df
    chosen = [days] if isinstance(days, int) else list(days)
    return df.where(F.col(column).isin(chosen))


def filter_messages(df: DataFrame, client: str | None = None, priority: str | None = None, operator: str | None = None) -> DataFrame:
    for column, value in (("ClientName", client), ("PriorityDescription", priority), ("OperatorName", operator)):
        if value is not None:
            df = df.where(F.col(column) == value)
    return df
