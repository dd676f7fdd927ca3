"""The hive-partitioned message lake (year / month / day folders)."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from smslens.operators.joins import BROADCAST_ROWS, has_at_most
from smslens.sources.messages import delivered_only

SLICE_COLUMNS = ("PhoneNumber", "Message", "ArrivalDate", "StatusId", "ClientName", "OperatorName", "PriorityDescription")


#: What the scans need of a message, and the partition folders.  Columns that a file lacks are null.
LAKE_SCHEMA = (
    "MTMessageId bigint, PhoneNumber string, Message string, ArrivalDate timestamp_ntz, StatusId bigint, ClientId bigint, ClientName string,"
    " OperatorName string, PriorityId bigint, PriorityDescription string, AccountName string, year int, month int, day int"
)
#: Phones that are listed in the scan's filter, where files and row groups are skipped by them.
LISTED_PHONES = 500


def open_lake(spark: SparkSession, root: str, schema: str = LAKE_SCHEMA) -> DataFrame:
    """All files below root with a known schema, partition folders as columns.

    No footer is opened before the partition filters have picked the files.  A lake with other or other typed columns
    passes its own schema.
    """
    return spark.read.schema(schema).option("recursiveFileLookup", "false").parquet(root)


def lookback_filter(df: DataFrame, as_of: date, lookback_days: int = 365) -> DataFrame:
    """Delivered rows from ``as_of - lookback_days`` on; prunes by year and, when present, month and day."""
    start = as_of - timedelta(days=lookback_days)
    if "year" in df.columns:
        newer = F.col("year") > start.year
        if "month" in df.columns:
            same_month = F.col("month") == start.month
            if "day" in df.columns:
                same_month = same_month & (F.col("day") >= start.day)
            newer = newer | ((F.col("year") == start.year) & ((F.col("month") > start.month) | same_month))
            df = df.where(newer)
        else:
            df = df.where(F.col("year") >= start.year)
    first = F.lit(start.isoformat() + " 00:00:00").cast(df.schema["ArrivalDate"].dataType)
    return delivered_only(df).where(F.col("ArrivalDate") >= first)


def scan_messages(
    lake: DataFrame, phones: DataFrame, as_of: date, lookback_days: int = 365, listed_phones: int = LISTED_PHONES, max_rows: int | None = BROADCAST_ROWS
) -> DataFrame:
    """Phone, message and arrival of the requested phones within the look-back.

    One scan serves any number of phones; ``phones`` has a column ``phone_number``.  A few phones are listed in the
    scan's filter; with more, their smallest and greatest are, and a join keeps the wanted ones.  Where that join is
    shuffled, Spark puts a bloom filter of the phones ahead of the shuffle (``runtime_filters``).  Ordering is left
    to the caller: see ``in_phone_order``.
    """
    wanted = phones.select(F.col("phone_number").alias("PhoneNumber")).where("PhoneNumber is not null").distinct()
    rows = lookback_filter(lake, as_of, lookback_days).select("PhoneNumber", "Message", "ArrivalDate")
    listed = [r.PhoneNumber for r in wanted.limit(listed_phones + 1).collect()]
    if len(listed) <= listed_phones:
        return rows.where(F.col("PhoneNumber").isin(listed))
    ends = wanted.agg(F.min("PhoneNumber").alias("lo"), F.max("PhoneNumber").alias("hi")).first()
    between = F.col("PhoneNumber").between(ends.lo, ends.hi)
    if max_rows is not None and has_at_most(wanted, max_rows):
        return rows.where(between).join(F.broadcast(wanted), "PhoneNumber", "left_semi")
    # Both sides shuffled.  The phones are one row each, so a phone with very many messages can be split.
    return rows.where(between).join(wanted.hint("shuffle_merge"), "PhoneNumber", "left_semi")


def runtime_filters(spark: SparkSession, scan_bytes: str = "1g", phones_bytes: str = "256m") -> None:
    """Let Spark build a bloom filter of a shuffled join's smaller side and apply it to scans of at least ``scan_bytes``."""
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.enabled", "true")
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold", scan_bytes)
    spark.conf.set("spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold", phones_bytes)


def in_phone_order(df: DataFrame) -> DataFrame:
    """Sorted by phone, then arrival (a range-partitioned sort)."""
    return df.orderBy("PhoneNumber", "ArrivalDate")


def write_slice(lake: DataFrame, path: str, as_of: date, lookback_days: int = 365) -> None:
    """Keep the look-back slice as its own table: by year and month, sorted by phone within files."""
    rows = lookback_filter(lake, as_of, lookback_days)
    present = [c for c in SLICE_COLUMNS if c in rows.columns]
    stamped = rows.select(*present, F.year("ArrivalDate").alias("year"), F.month("ArrivalDate").alias("month"))
    # Range partitioning by phone keeps each phone's rows together and splits a month over many tasks;
    # arrival is part of the key so that one phone with a large share of the rows is split as well.
    ordered = stamped.repartitionByRange("year", "month", "PhoneNumber", "ArrivalDate")
    ordered.sortWithinPartitions("year", "month", "PhoneNumber").write.mode("overwrite").partitionBy("year", "month").parquet(path)


def phone_timeline(slice_df: DataFrame, phone: str) -> DataFrame:
    """All rows of one phone in time order."""
    return slice_df.where(F.col("PhoneNumber") == phone).orderBy("ArrivalDate")
