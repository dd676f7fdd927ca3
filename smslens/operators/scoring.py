"""Phone scoring: behaviour of each phone over the look-back window.

One aggregation serves every part of the document.  Each message counts towards three cells of its
phone: its hour, its weekday, its category and subcategory.  A phone has at most 24 + 7 + (number of
subcategories) cells, so a phone that receives a third of all messages leaves each task as a few rows,
and everything after works on cells, never on messages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from smslens.functions.labels import message_type
from smslens.functions.text import normalize_text
from smslens.functions.vocabulary import DAYPARTS, MESSAGE_TYPES, OTHER_MESSAGE_TYPE, WEEKDAYS
from smslens.operators.extract import distinct_templates, text_key
from smslens.operators.joins import BROADCAST_ROWS, lookup_join

TYPES = [*MESSAGE_TYPES, OTHER_MESSAGE_TYPE]
UNKNOWN = "unknown"
SHARE_SUFFIX = "_share_last_365d"


def categorise(messages: DataFrame, lookup: DataFrame, rules=None, max_lookup_rows: int | None = BROADCAST_ROWS) -> DataFrame:
    """Messages (PhoneNumber, Message, ArrivalDate) with categoria and subcategoria of their template.

    The rules and the lookup see each distinct text once; of a message only the phone, the arrival and the hash
    of its text go into a join.  See ``lookup_join`` for ``max_lookup_rows``.
    """
    base = messages.select(
        F.col("PhoneNumber").alias("phone_number"), "ArrivalDate", normalize_text("Message").alias("cleaned_message")
    )
    texts = distinct_templates(base, rules=rules).drop("template_text")
    found = lookup_join(texts, lookup.select("template_id", "categoria", "subcategoria"), "template_id", "left", max_lookup_rows)
    known = found.where("categoria is not null or subcategoria is not null").select("h1", "h2", "categoria", "subcategoria")
    # One row per text on the right: a text that went to very many phones can be split on the left.
    rows = base.select("phone_number", "ArrivalDate", *text_key(F.col("cleaned_message"))).join(known, ["h1", "h2"], "left")
    return rows.select(
        "phone_number", "ArrivalDate",
        F.coalesce("categoria", F.lit(UNKNOWN)).alias("category"),
        F.coalesce("subcategoria", F.lit(UNKNOWN)).alias("subcategory"),
    )


def phone_cells(categorised: DataFrame) -> DataFrame:
    """(phone_number, facet, k1, k2): messages n, first_seen, last_seen.

    facet 'hour': k1 = 0..23; 'weekday': k1 = 0 (Monday) .. 6; 'category': k1 = category, k2 = subcategory.
    """

    def cell(facet: str, k1: Column, k2: Column) -> Column:
        return F.struct(F.lit(facet).alias("facet"), k1.cast("string").alias("k1"), k2.cast("string").alias("k2"))

    none = F.lit(None)
    facets = F.array(
        cell("hour", F.hour("ArrivalDate"), none),
        cell("weekday", F.weekday("ArrivalDate"), none),
        cell("category", F.col("category"), F.col("subcategory")),
    )
    return (
        categorised.select("phone_number", "ArrivalDate", F.inline(facets))
        .groupBy("phone_number", "facet", "k1", "k2")
        .agg(F.count(F.lit(1)).alias("n"), F.min("ArrivalDate").alias("first_seen"), F.max("ArrivalDate").alias("last_seen"))
    )


def _facet(cells: DataFrame, facet: str) -> DataFrame:
    return cells.where(F.col("facet") == facet)


def _number(c: str = "k1") -> Column:
    return F.col(c).cast("int")


def phone_hours(cells: DataFrame) -> DataFrame:
    """phone, hour, messages: all 24 hours, zero-filled."""
    seen = F.map_from_entries(F.collect_list(F.struct(_number(), "n")))
    per_phone = _facet(cells, "hour").groupBy("phone_number").agg(seen.alias("seen"))
    hours = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.struct(h.alias("hour"), _count_in("seen", h).alias("messages")))
    return per_phone.select("phone_number", F.inline(hours))


def _count_in(counts: str, key: Column) -> Column:
    return F.coalesce(F.try_element_at(F.col(counts), key), F.lit(0).cast("bigint"))


def phone_dayparts(cells: DataFrame) -> DataFrame:
    """phone and the share of its messages in each quarter of the day."""
    hour = _number()

    def share(start: int, end: int) -> Column:
        part = F.sum(F.when((hour >= start) & (hour < end), F.col("n")).otherwise(F.lit(0)))
        return part.cast("double") / F.sum("n")

    return _facet(cells, "hour").groupBy("phone_number").agg(*[share(a, b).alias(f"{name}{SHARE_SUFFIX}") for name, a, b in DAYPARTS])


def phone_weekdays(cells: DataFrame) -> DataFrame:
    """phone, weekday, messages; weekdays without messages are left out."""
    names = F.array(*[F.lit(w) for w in WEEKDAYS])
    return _facet(cells, "weekday").select("phone_number", _number().alias("day_index"), F.get(names, _number()).alias("weekday"), F.col("n").alias("messages"))


def phone_categories(cells: DataFrame) -> DataFrame:
    """phone, category, messages, share of all the phone's messages, first and last seen; 'unknown' left out.

    The total is a window over one phone's categories, never over its messages.
    """
    per_category = _facet(cells, "category").groupBy("phone_number", F.col("k1").alias("category")).agg(
        F.sum("n").alias("messages"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")
    )
    total = F.sum("messages").over(Window.partitionBy("phone_number"))
    return per_category.withColumn("share", F.col("messages").cast("double") / total).where(F.col("category") != UNKNOWN)


def phone_subcategories(cells: DataFrame) -> DataFrame:
    """phone, category, subcategory, messages, share within the category (unknown subcategories count in it)."""
    total = F.sum("n").over(Window.partitionBy("phone_number", "k1"))
    rows = _facet(cells, "category").select(
        "phone_number", F.col("k1").alias("category"), F.col("k2").alias("subcategory"), F.col("n").alias("messages"),
        (F.col("n").cast("double") / total).alias("share"),
    )
    return rows.where((F.col("category") != UNKNOWN) & (F.col("subcategory") != UNKNOWN))


def phone_types(cells: DataFrame) -> DataFrame:
    """phone and its messages of each of the five message types."""
    kind = message_type("k2")
    return _facet(cells, "category").groupBy("phone_number").agg(
        *[F.coalesce(F.sum(F.when(kind == t, F.col("n"))), F.lit(0)).alias(t) for t in TYPES]
    )


def _ranked(items: Column, count: str, *ties: str) -> Column:
    """Array of structs by count descending, then name."""

    def order(a: Column, b: Column) -> Column:
        out = F.when(a[count] > b[count], -1).when(a[count] < b[count], 1)
        for t in ties:
            out = out.when(a[t] < b[t], -1).when(a[t] > b[t], 1)
        return out.otherwise(0)

    return F.array_sort(items, order)


def _iso(ts: Column | str) -> Column:
    """ISO text with a trailing Z; the fraction only when there is one."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(whole, F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros)), F.lit("Z"))


def score_documents(
    requests: DataFrame, categorised: DataFrame, generated_at: str, lookback_days: int = 365, request_reference: str | None = None
) -> DataFrame:
    """One nested document per requested phone (ordinal, phone_number), in request order by ``ordinal``.

    A phone without messages gets the full document with zeros.  Lists per phone hold one entry per
    category or subcategory of the lookup, never one per message.
    """
    cells = phone_cells(categorised).repartition("phone_number")
    facet = F.col("facet")
    kind = message_type("k2")
    # One row per (phone, facet, k1): an hour, a weekday, or a category with its subcategories.
    sub = F.struct(F.col("k2").alias("subcategory"), F.col("n").alias("messages_last_365d"))
    grouped = cells.groupBy("phone_number", "facet", "k1").agg(
        F.sum("n").alias("messages"),
        F.min("first_seen").alias("first"),
        F.max("last_seen").alias("last"),
        F.collect_list(F.when((facet == "category") & (F.col("k2") != UNKNOWN), sub)).alias("subs"),
        F.collect_list(F.when(facet == "category", F.struct(kind.alias("kind"), "n"))).alias("kinds"),
    ).withColumnsRenamed({"messages": "n", "first": "first_seen", "last": "last_seen"})
    shares = F.transform(
        _ranked(F.col("subs"), "messages_last_365d", "subcategory"),
        lambda s: F.struct(
            s["subcategory"].alias("subcategory"),
            s["messages_last_365d"].alias("messages_last_365d"),
            (s["messages_last_365d"].cast("double") / F.col("n")).alias("share_within_category"),
        ),
    )
    entry = F.struct(
        F.col("k1").alias("category"), F.col("n").alias("messages_last_365d"),
        _iso("first_seen").alias("first_seen_at"), _iso("last_seen").alias("last_seen_at"), shares.alias("subcategories"),
    )

    def counts(name: str) -> Column:
        return F.map_from_entries(F.collect_list(F.when(facet == name, F.struct(_number(), "n"))))

    per_phone = grouped.groupBy("phone_number").agg(
        F.sum(F.when(facet == "hour", F.col("n"))).alias("messages"),
        counts("hour").alias("hours"),
        counts("weekday").alias("days"),
        F.collect_list(F.when((facet == "category") & (F.col("k1") != UNKNOWN), entry)).alias("cats"),
        F.flatten(F.collect_list("kinds")).alias("kinds"),
    )
    joined = requests.select("ordinal", "phone_number").join(per_phone, "phone_number", "left")
    empty_map = F.create_map().cast("map<int, bigint>")
    types = per_phone.schema
    zero = joined.select(
        "ordinal", "phone_number",
        F.coalesce("messages", F.lit(0)).alias("n"),
        F.coalesce("hours", empty_map).alias("hours"),
        F.coalesce("days", empty_map).alias("days"),
        F.coalesce("cats", F.array().cast(types["cats"].dataType)).alias("cats"),
        F.coalesce("kinds", F.array().cast(types["kinds"].dataType)).alias("kinds"),
    )
    hours = F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: F.struct(h.alias("hour"), _count_in("hours", h).alias("messages_last_365d")))
    names = F.array(*[F.lit(w) for w in WEEKDAYS])
    days = F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.struct(F.get(names, i).alias("weekday"), _count_in("days", i).alias("messages_last_365d")))
    no_messages = F.lit(0).cast("bigint")

    def daypart(start: int, end: int) -> Column:
        part = F.aggregate(F.sequence(F.lit(start), F.lit(end - 1)), no_messages, lambda a, h: a + _count_in("hours", h))
        return F.when(F.col("n") > 0, part.cast("double") / F.col("n")).otherwise(F.lit(0.0))

    def of_type(name: str) -> Column:
        return F.aggregate("kinds", no_messages, lambda a, x: a + F.when(x["kind"] == name, x["n"]).otherwise(no_messages))

    categories = F.transform(
        _ranked(F.col("cats"), "messages_last_365d", "category"),
        lambda c: F.struct(
            c["category"].alias("category"),
            c["messages_last_365d"].alias("messages_last_365d"),
            (c["messages_last_365d"].cast("double") / F.col("n")).alias("share_last_365d"),
            c["first_seen_at"].alias("first_seen_at"),
            c["last_seen_at"].alias("last_seen_at"),
            c["subcategories"].alias("subcategories"),
        ),
    )
    return zero.select(
        "ordinal",
        "phone_number",
        F.struct(
            hours.alias("hourly_distribution"),
            F.struct(*[daypart(a, b).alias(f"{name}{SHARE_SUFFIX}") for name, a, b in DAYPARTS]).alias("daypart_distribution"),
            F.filter(days, lambda d: d["messages_last_365d"] > 0).alias("weekday_distribution"),
        ).alias("temporal_patterns"),
        categories.alias("categories"),
        F.struct(
            F.lit(lookback_days).alias("lookback_days"), F.struct(*[of_type(t).alias(t) for t in TYPES]).alias("counts_last_365d")
        ).alias("message_types"),
        F.struct(
            F.lit(generated_at).alias("generated_at"),
            F.lit(request_reference).cast("string").alias("request_reference"),
            F.lit("standard").alias("granularity"),
            F.lit(lookback_days).alias("data_lookback_days"),
            F.lit("1.0.0").alias("version"),
        ).alias("metadata"),
    )


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON document per line, in request order."""
    documents.orderBy("ordinal").drop("ordinal").write.mode("overwrite").option("ignoreNullFields", "false").json(path)
