"""Phone profiles, the hot set, and routing of known templates."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from smslens.functions.text import normalize_text
from smslens.functions.vocabulary import HOT_MAX_IDLE_DAYS, HOT_MIN_FREQUENCY
from smslens.operators.extract import distinct_templates, text_key
from smslens.operators.joins import lookup_join

PROFILE_KEYS = ("phone_number", "template_id", "sender")


def phone_profile(messages: DataFrame, rules=None) -> DataFrame:
    """Count, first and last day per phone, template and sender, over every message.

    Messages collapse by phone, sender and the hash of their text; the rules run once per distinct text.
    """
    base = messages.select(
        F.col("PhoneNumber").alias("phone_number"), F.col("ClientName").alias("sender"), F.to_date("ArrivalDate").alias("day"),
        normalize_text("Message").alias("cleaned_message"),
    )
    counts = base.groupBy("phone_number", "sender", *text_key(F.col("cleaned_message"))).agg(
        F.count(F.lit(1)).alias("n"), F.min("day").alias("first_day"), F.max("day").alias("last_day")
    )
    # One row per text on the right: a text that went to very many phones can be split on the left.
    joined = counts.join(distinct_templates(base, rules=rules).drop("template_text"), ["h1", "h2"])
    return joined.groupBy(*PROFILE_KEYS).agg(F.sum("n").alias("appearances"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))


def merge_profiles(previous: DataFrame, today: DataFrame) -> DataFrame:
    """Accumulate two profile snapshots (null senders are one sender)."""
    return (
        previous.unionByName(today)
        .groupBy(*PROFILE_KEYS)
        .agg(F.sum("appearances").alias("appearances"), F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))
    )


def write_profiles(profiles: DataFrame, path: str, ranges: int = 64) -> None:
    """The snapshot, partitioned by a hash of the phone, so that a day's update touches the ranges it has phones in."""
    keyed = profiles.withColumn("phone_range", F.pmod(F.xxhash64("phone_number"), F.lit(ranges)).cast("int"))
    # Sender and template in the key: a phone with very many templates is split over tasks.
    keyed.repartition("phone_range", F.pmod(F.xxhash64("phone_number", "template_id", "sender"), F.lit(4))).write.mode("overwrite").partitionBy("phone_range").parquet(path)


def update_profiles(spark: SparkSession, path: str, today: DataFrame, work: str, ranges: int = 64) -> list[int]:
    """Merge a day's profile into the snapshot at ``path``; returns the phone ranges rewritten, the others keep their files.

    The merged ranges are written to ``work`` (a new folder that all executors share) before they replace those at
    ``path`` by dynamic partition overwrite, so a run that dies while merging leaves the snapshot as it was.
    ``ranges`` has to be that of ``write_profiles``; a day is merged once.
    """
    keyed = today.withColumn("phone_range", F.pmod(F.xxhash64("phone_number"), F.lit(ranges)).cast("int"))
    keyed.write.mode("overwrite").partitionBy("phone_range").parquet(f"{work}/today")
    fresh = spark.read.schema(keyed.schema).parquet(f"{work}/today")
    touched = sorted(r.phone_range for r in fresh.select("phone_range").distinct().collect())  # `ranges` numbers
    if not touched:
        return []
    before = spark.read.schema(keyed.schema).parquet(path).where(F.col("phone_range").isin(touched))
    merged = merge_profiles(before.select(*today.columns), fresh.select(*today.columns))
    merged = merged.withColumn("phone_range", F.pmod(F.xxhash64("phone_number"), F.lit(ranges)).cast("int"))
    merged.write.mode("overwrite").partitionBy("phone_range").parquet(f"{work}/merged")
    ready = spark.read.schema(merged.schema).parquet(f"{work}/merged")
    ready.repartition("phone_range").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("phone_range").parquet(path)
    return touched


def read_profiles(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot without its range column."""
    return spark.read.parquet(path).drop("phone_range")


def hot_templates(
    freq: DataFrame, as_of: date, min_frequency: int = HOT_MIN_FREQUENCY, max_idle_days: int = HOT_MAX_IDLE_DAYS
) -> DataFrame:
    """Templates seen often enough and recently enough."""
    since = as_of - timedelta(days=max_idle_days)
    return freq.where((F.col("frequency") >= min_frequency) & (F.to_date("last_seen") >= F.lit(since)))


def route_known(freq: DataFrame, known: DataFrame) -> DataFrame:
    """Add ``known``: whether the template id is in the keyed table."""
    marked = known.select("template_id").distinct().withColumn("__k", F.lit(True))
    return freq.join(marked, "template_id", "left").withColumn("known", F.coalesce("__k", F.lit(False))).drop("__k")


def route_messages(templated: DataFrame, known: DataFrame, max_known_rows: int | None = 1_000_000) -> DataFrame:
    """Same for message rows, where one template may hold a third of the rows."""
    marked = known.select("template_id").distinct().withColumn("__k", F.lit(True))
    joined = lookup_join(templated, marked, "template_id", "left", max_known_rows)
    return joined.withColumn("known", F.coalesce("__k", F.lit(False))).drop("__k")


def known_traffic(routed: DataFrame) -> DataFrame:
    """One row: templates and messages known and unknown, and the known share of messages."""
    k = F.col("known")
    sums = routed.agg(
        F.count_if(k).alias("known_templates"),
        F.count_if(~k).alias("unknown_templates"),
        F.coalesce(F.sum(F.when(k, F.col("frequency"))), F.lit(0)).alias("known_messages"),
        F.coalesce(F.sum("frequency"), F.lit(0)).alias("messages"),
    )
    return sums.withColumn(
        "known_share", F.when(F.col("messages") > 0, F.col("known_messages").cast("double") / F.col("messages")).otherwise(F.lit(0.0))
    )
