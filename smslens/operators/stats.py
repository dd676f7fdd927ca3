"""Statistics over raw message tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from smslens.functions.text import bucket_label
from smslens.functions.vocabulary import LENGTH_RANGES
from smslens.operators.joins import facet_row, share_of_total

PRIORITY = ("PriorityId", "PriorityDescription")


def message_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("messages"))


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    """Messages per value (or pair of values); rows with a null in any of them are left out."""
    return df.dropna(subset=list(columns)).groupBy(*columns).agg(F.count(F.lit(1)).alias("messages"))


def top_values(df: DataFrame, *columns: str, n: int = 5) -> DataFrame:
    """The n most frequent values with their percentage of all rows, null ones included."""
    best = counts_by(df, *columns).orderBy(F.desc("messages"), *columns).limit(n)
    return best.withColumn("pct", 100.0 * share_of_total("messages", message_count(df)))


def distinct_phones(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Distinct phones; a null phone counts as one value, as in a set."""
    has_null = F.coalesce(F.max(F.col("PhoneNumber").isNull().cast("bigint")), F.lit(0))
    count = F.approx_count_distinct("PhoneNumber") if approximate else F.count_distinct("PhoneNumber")
    return df.agg((count + has_null).alias("phones"))


def hours_between(first: Column, last: Column) -> Column:
    """Elapsed hours as a double."""
    return (F.timestamp_diff("MICROSECOND", first, last).cast("double")) / F.lit(3.6e9)


def time_range(df: DataFrame) -> DataFrame:
    """First and last arrival and the hours between; values that do not parse are ignored."""
    ts = F.col("ArrivalDate").try_cast("timestamp_ntz")
    ends = df.agg(F.min(ts).alias("min_timestamp"), F.max(ts).alias("max_timestamp"))
    return ends.withColumn("duration_hours", hours_between(F.col("min_timestamp"), F.col("max_timestamp")))


def message_report(df: DataFrame) -> DataFrame:
    """One row: messages, distinct clients, operators, phones and priorities, first and last arrival.

    Every distinct count comes from one aggregation over (facet, value); each message is expanded to four
    short rows that collapse before the shuffle, and no task holds the values of a facet.
    """
    ts = F.col("ArrivalDate").try_cast("timestamp_ntz")
    priority = F.when(
        F.col("PriorityId").isNotNull() & F.col("PriorityDescription").isNotNull(),
        F.concat_ws("\x01", F.col("PriorityId").cast("string"), "PriorityDescription"),
    )
    facets = F.array(
        facet_row("client", F.col("ClientName")),
        facet_row("operator", F.col("OperatorName")),
        facet_row("phone", F.col("PhoneNumber")),
        facet_row("priority", priority),
    )
    values = (
        df.select(ts.alias("ts"), F.inline(facets))
        .groupBy("facet", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    )

    def distinct(facet: str, count_null: bool = False) -> Column:
        hit = F.col("facet") == facet
        return F.count_if(hit if count_null else hit & F.col("value").isNotNull())

    return values.agg(
        F.coalesce(F.sum(F.when(F.col("facet") == "client", F.col("n"))), F.lit(0)).alias("total_messages"),
        distinct("client").alias("unique_clients"),
        distinct("operator").alias("unique_operators"),
        distinct("phone", count_null=True).alias("unique_phones"),
        distinct("priority").alias("unique_priorities"),
        F.min("lo").alias("min_timestamp"),
        F.max("hi").alias("max_timestamp"),
    )


def completeness(df: DataFrame, columns=("PhoneNumber", "ClientName", "OperatorName", "ArrivalDate")) -> DataFrame:
    """Non-empty count and percentage per column, as one row per column, from one aggregation."""
    filled = [
        F.count_if(F.col(c).isNotNull() & (F.col(c).cast("string") != "")).alias(c) for c in columns
    ]
    counts = df.agg(F.count(F.lit(1)).alias("__total"), *filled)
    rows = counts.select("__total", F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("filled")) for c in columns])))
    pct = F.when(F.col("__total") > 0, 100.0 * F.col("filled") / F.col("__total")).otherwise(F.lit(0.0))
    return rows.select("column_name", "filled", pct.cast("double").alias("filled_pct"))


def length_bands(df: DataFrame, column: str = "Message") -> DataFrame:
    """Messages per length range; null counts as empty."""
    band = bucket_label(F.length(F.coalesce(F.col(column), F.lit(""))), LENGTH_RANGES)
    return df.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("messages"))
