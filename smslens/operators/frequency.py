"""Template frequencies.

Messages are reduced in steps: equal texts, then equal template rows, then template ids.  The first two
keep only fixed-width values (count, first and last arrival), so they run as hash aggregations with a
map-side part: a text or template that holds a third of the traffic leaves each task as one row.  The
last step works on that small result and may pick "first seen" values of any type.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from smslens.functions.text import bucket_label, normalize_text, template_id
from smslens.functions.vocabulary import DELIVERED_STATUS, FREQUENCY_RANGES
from smslens.operators.extract import distinct_templates, extract_templates, rewrite_texts, text_key, with_rule_names
from smslens.operators.joins import facet_row, share_of_listed, share_of_total
from smslens.operators.stats import message_report
from smslens.session import shared_folder
from smslens.sources.messages import delivered_only


def templates_of(messages: DataFrame, rules=None, unify: bool = False) -> DataFrame:
    """Raw message columns plus cleaned text and template columns, one row per message."""
    return extract_templates(
        messages.withColumn("cleaned_message", normalize_text("Message")), rules=rules, unify=unify
    )


def message_groups(messages: DataFrame, *extra: str, rules=None, text_first: bool = True) -> DataFrame:
    """Messages grouped by template row, client name and ``extra`` columns.

    ``text_first`` groups equal texts before the rules run: one more shuffle, of the distinct texts, and
    the rules see each text once.  The rules cost tens of microseconds per message, the shuffle about one,
    so this pays as soon as a few percent of the messages are verbatim copies.  Copies collapse before the
    shuffle, and the shuffle also spreads the rules over all cores when the input has few splits.
    """
    keys = ["ClientName", *extra]
    base = messages.select(normalize_text("Message").alias("cleaned_message"), *keys, "ArrivalDate")
    stamps = [F.min("ArrivalDate").alias("first_seen"), F.max("ArrivalDate").alias("last_seen")]
    if text_first:
        texts = base.groupBy("cleaned_message", *keys).agg(F.count(F.lit(1)).alias("n"), *stamps)
        rows = rewrite_texts(texts, rules=rules)
        measures = [F.sum("n").alias("n"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen")]
    else:
        rows = rewrite_texts(base, rules=rules)
        measures = [F.count(F.lit(1)).alias("n"), *stamps]
    grouped = rows.groupBy("template_text", *_masks(rows), *keys).agg(*measures)
    return with_rule_names(grouped, rules).withColumn("template_id", template_id("template_text"))


def _masks(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c.startswith("rule_mask")]


def template_frequency(messages: DataFrame, include_pure: bool = False, rules=None, text_first: bool = True) -> DataFrame:
    """One row per template id: text, rules, frequency, client of the first message, first / last seen.

    "First" is by arrival; equal arrivals by client name, then rules.
    """
    groups = message_groups(messages, rules=rules, text_first=text_first)
    if not include_pure:
        groups = groups.where(F.size("applied_rules") > 0)
    first = F.struct("template_text", "applied_rules", F.col("ClientName").alias("client_name"))
    order = F.struct("first_seen", "ClientName", F.array_join("applied_rules", ","))
    return (
        groups.groupBy("template_id")
        .agg(
            F.sum("n").alias("frequency"),
            F.min_by(first, order).alias("f"),
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
        )
        .select("template_id", "f.*", "frequency", "first_seen", "last_seen")
    )


def pure_text_frequency(messages: DataFrame, rules=None) -> DataFrame:
    """Frequency of the texts in which no rule fired."""
    cleaned = messages.select(normalize_text("Message").alias("cleaned_message"))
    rows = rewrite_texts(cleaned.groupBy("cleaned_message").agg(F.count(F.lit(1)).alias("frequency")), rules=rules)
    no_rule = reduce(lambda a, b: a & b, [F.col(m) == 0 for m in _masks(rows)])
    return rows.where(no_rule).select("cleaned_message", "frequency")


def distinct_counts(messages: DataFrame, rules=None) -> DataFrame:
    """Number of distinct templates with placeholders and of distinct pure texts."""
    groups = message_groups(messages, rules=rules).select("template_id", (F.size("applied_rules") > 0).alias("fired")).distinct()
    return groups.agg(
        F.count_if(F.col("fired")).alias("unique_templates"),
        F.count_if(~F.col("fired")).alias("unique_pure_messages"),
    )


def template_stats(messages: DataFrame, rules=None) -> DataFrame:
    """Full statistics per template: frequency, client names, priorities, operators, distinct phones, first / last seen.

    Each message becomes one short row per facet, keyed by the hash of its text.  They collapse to distinct rows
    before the shuffle, then take the template id of their text, for which the rules ran once.  Phones are reduced
    to a count before any list is built, and the template's text is attached to the result.
    """
    base = messages.select(
        normalize_text("Message").alias("cleaned_message"), "ClientName", "PriorityId", "OperatorName", "PhoneNumber", "ArrivalDate"
    )
    shared_folder(messages.sparkSession)
    templates = distinct_templates(base, rules=rules).checkpoint()
    facets = F.array(
        facet_row("all", F.lit(None)),
        facet_row("client", F.col("ClientName")),
        facet_row("priority", F.col("PriorityId")),
        facet_row("operator", F.col("OperatorName")),
        facet_row("phone", F.col("PhoneNumber")),
    )
    keys = ["template_id"]
    seen = (
        base.select(*text_key(F.col("cleaned_message")), "ArrivalDate", F.inline(facets))
        .groupBy("h1", "h2", "facet", "value")
        .agg(F.count(F.lit(1)).alias("n"), F.min("ArrivalDate").alias("lo"), F.max("ArrivalDate").alias("hi"))
    )
    values = (
        seen.join(templates.drop("template_text"), ["h1", "h2"])
        .groupBy(*keys, "facet", "value")
        .agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    )
    listed = F.when(F.col("facet") != "phone", F.col("value"))
    short = values.groupBy(*keys, "facet", listed.alias("value")).agg(
        F.sum("n").alias("n"), F.count("value").alias("distinct_values"), F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )

    def names(facet: str, cast: str = "string"):
        return F.sort_array(F.collect_set(F.when(F.col("facet") == facet, F.col("value")).cast(cast)))

    whole = F.col("facet") == "all"
    found = (
        short.groupBy("template_id")
        .agg(
            F.coalesce(F.sum(F.when(whole, F.col("n"))), F.lit(0)).alias("frequency"),
            names("client").alias("client_names"),
            names("priority", "bigint").alias("priority_ids"),
            names("operator").alias("operator_names"),
            F.coalesce(F.sum(F.when(F.col("facet") == "phone", F.col("distinct_values"))), F.lit(0)).alias("phone_count"),
            F.min(F.when(whole, F.col("lo"))).alias("first_seen"),
            F.max(F.when(whole, F.col("hi"))).alias("last_seen"),
        )
    )
    texts = templates.select("template_id", "template_text").dropDuplicates(["template_id"])
    return texts.join(found, "template_id")


def run_summary(raw: DataFrame, rules=None) -> DataFrame:
    """One row for a whole run over raw messages: rows in, rows delivered, distinct values, rules applied."""
    delivered = delivered_only(raw)
    groups = message_groups(delivered, rules=rules).agg(
        F.struct(
            F.count_distinct("template_id").alias("unique_templates"),
            F.coalesce(F.sum(F.col("n") * F.size("applied_rules")), F.lit(0)).alias("total_rules_applied"),
        )
    )
    values = message_report(delivered).select(F.struct("unique_clients", "unique_operators", "unique_priorities", "unique_phones"))
    rows = raw.agg(
        F.count(F.lit(1)).alias("total_messages_processed"),
        F.count_if(F.col("StatusId") == DELIVERED_STATUS).alias("messages_after_filter"),
    )
    return rows.withColumns({"g": groups.scalar(), "v": values.scalar()}).select(
        "total_messages_processed", "messages_after_filter", "g.*", "v.*"
    )


# --- Reports on template frequencies (columns template_id, frequency) ------------------------


def frequent_coverage(freq: DataFrame) -> DataFrame:
    """One row: templates seen more than once, their share of templates and of messages, ratio and reduction."""
    often = F.col("frequency") > 1
    sums = freq.agg(
        F.count(F.lit(1)).alias("templates"),
        F.coalesce(F.sum("frequency"), F.lit(0)).alias("messages"),
        F.count_if(often).alias("frequent_templates"),
        F.coalesce(F.sum(F.when(often, F.col("frequency"))), F.lit(0)).alias("frequent_messages"),
    )

    def over(a, b, default=0.0):
        return F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b)).otherwise(F.lit(default))

    return sums.select(
        "templates", "messages", "frequent_templates", "frequent_messages",
        (100.0 * over("frequent_templates", "templates")).alias("frequent_templates_pct"),
        (100.0 * over("frequent_messages", "messages")).alias("frequent_messages_pct"),
        over("messages", "templates").alias("messages_per_template"),
        (100.0 * (F.lit(1.0) - over("templates", "messages", 1.0))).alias("reduction_pct"),
    )


def top_frequent(freq: DataFrame, k: int = 100) -> DataFrame:
    """The k most frequent templates among those seen more than once."""
    return freq.where(F.col("frequency") > 1).orderBy(F.desc("frequency"), "template_id").limit(k)


def frequency_histogram(freq: DataFrame) -> DataFrame:
    """Templates and messages per frequency range, with percentages of the totals."""
    ranges = freq.groupBy(bucket_label("frequency", FREQUENCY_RANGES).alias("frequency_range")).agg(
        F.count(F.lit(1)).alias("templates"), F.sum("frequency").alias("messages")
    )
    return ranges.select(
        "frequency_range", "templates", "messages",
        (100.0 * share_of_listed("templates")).alias("templates_pct"),
        (100.0 * share_of_listed("messages")).alias("messages_pct"),
    )


def top_templates(freq: DataFrame, n: int = 20, total: DataFrame | None = None) -> DataFrame:
    """The n most frequent templates with their percentage of all messages.

    ``total`` is a one-value frame with the message count; without it the frequencies are summed, which
    reads ``freq`` a second time.
    """
    best = freq.orderBy(F.desc("frequency"), "template_id").limit(n)
    total = freq.agg(F.sum("frequency")) if total is None else total
    return best.withColumn("pct", 100.0 * share_of_total("frequency", total))
