"""Registered queries: each runs one operator over the whole given tables."""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.views import messages_sql
from smslens.functions.text import normalize_text, template_id, unify_spelling
from smslens.operators import cascade, classify, frequency, learn, profiles, reports, scoring, similarity, split, stats, store, votes
from smslens.operators.extract import extract_templates
from smslens.operators.normalize import changed_samples, normalization_report, with_normalized
from smslens.plans.daily import DayPaths, classified_templates, read_unique_templates, run_day
from smslens.plans.scoring import score_phones
from smslens.session import shared_folder
from smslens.sources import jsonl, lake, lookups, messages as src, outputs
from smslens.streaming import messages as stream

AS_OF = date(2024, 1, 31)
GENERATED_AT = "2024-01-31T00:00:00Z"


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def raw_messages(spark: SparkSession, d: str) -> DataFrame:
    """The message view over the whole events table."""
    return spark.sql(messages_sql("SELECT event_id AS n, ts, user_id, event_type AS kind, value, props FROM {events}"), events=table(spark, d, "events"))


def delivered(spark, d):
    return src.delivered_only(raw_messages(spark, d))


def texts(spark, d):
    """Delivered messages ahead of the extraction rules."""
    return delivered(spark, d)


def freq(spark, d, include_pure=False):
    return frequency.template_frequency(delivered(spark, d), include_pure=include_pure)


def stored(spark, df):
    """A table that several steps read, computed once (in production: a written table)."""
    shared_folder(spark)
    return df.checkpoint()


def fired(c="applied_rules"):
    return F.array_join(c, ",").alias("applied_rules")


# Votes of two judges and an arbiter, derived from the pending templates' ids.
JUDGE_SQL = """
SELECT template_id, judge, label, confidence FROM (
  SELECT template_id, judge, frequency,
         CASE WHEN (frequency + judge * (frequency % 2)) % 3 = 0 THEN 'banking::otp_2fa'
              WHEN (frequency + judge * (frequency % 2)) % 3 = 1 THEN 'utilities::water'
              ELSE 'government::dian' END AS label,
         0.6 + (frequency % 4) * 0.1 AS confidence
  FROM (SELECT template_id, frequency, 1 AS judge FROM pending UNION ALL SELECT template_id, frequency, 2 AS judge FROM pending) p
) v WHERE NOT (judge = 2 AND frequency % 11 = 0)
"""
ARBITER_SQL = """
SELECT template_id,
       CASE WHEN frequency % 5 = 0 THEN 'ABSTAIN' ELSE 'collections::legal_notice' END AS label,
       0.8 AS confidence, 'by frequency' AS reasoning,
       CASE WHEN frequency % 7 = 0 THEN 'timeout' END AS error
FROM pending WHERE frequency % 13 <> 0
"""


def vote_templates(spark, d):
    """Classified templates of the delivered messages and of all conversation turns, which no rule labels."""
    talk = spark.sql(
        "SELECT text AS Message, role AS ClientName, timestampadd(SECOND, conv_id * 60 + turn, TIMESTAMP_NTZ'2024-01-05 00:00:00') AS ArrivalDate FROM {talk}",
        talk=table(spark, d, "conversations"),
    )
    rows = delivered(spark, d).select("Message", "ClientName", "ArrivalDate").unionByName(talk)
    return stored(spark, classify.classify_rules(frequency.template_frequency(rows, include_pure=True)))


def pending_keys(done):
    """Pending ids with a number the fixture's judges decide by."""
    number = (F.col("frequency") + F.length("template_text")).alias("frequency")
    return done.where("level_used = 'pending'").select("template_id", number)


def resolved(spark, d, partial=False):
    done = vote_templates(spark, d)
    pending = pending_keys(done)
    v = spark.sql(JUDGE_SQL.replace("FROM pending", "FROM {pending}"), pending=pending)
    a = spark.sql(ARBITER_SQL.replace("FROM pending", "FROM {pending}"), pending=pending)
    return votes.resolve_votes(done, v.withColumn("confidence", F.col("confidence").cast("double")),
                               a.withColumn("confidence", F.col("confidence").cast("double")), partial_agreement=partial)


def classified(spark, d):
    return classified_templates(raw_messages(spark, d))


def lookup(spark, d):
    labelled = classified(spark, d).where("trim(label) <> ''")
    return stored(spark, labelled.select("template_id", F.col("category").alias("categoria"), F.col("subcategory").alias("subcategoria"), "label"))


def cells(spark, d):
    """Counters of every phone over the look-back."""
    rows = lake.lookback_filter(raw_messages(spark, d), AS_OF, 30)
    return scoring.phone_cells(scoring.categorise(rows, lookup(spark, d)))


def requests(spark, d):
    """Every user of the events table and one phone per supplier, most of which never got a message."""
    users = table(spark, d, "events").select("user_id").distinct()
    others = table(spark, d, "supplier").select((F.col("s_suppkey") + 900000).alias("user_id"))
    all_ids = users.unionByName(others)
    return all_ids.select(F.col("user_id").alias("ordinal"), F.concat(F.lit("57300"), F.lpad(F.col("user_id").cast("string"), 7, "0")).alias("phone_number"))


def keyed_table(spark, d):
    """The keyed table after inserting every resolved template, classified at its first arrival."""
    done = resolved(spark, d).withColumn("classified_at", F.col("first_seen")).drop("first_seen", "last_seen")
    return store.conform(done)


# --- queries ------------------------------------------------------------------------------------


def q_delivered_messages(spark, d):
    return src.typed_messages(delivered(spark, d)).select(
        "mt_message_id", "message", "phone_number", "status_id", "client_id", "client_name", "priority_id",
        "priority_description", "operator_name", "timestamp", "account_name", "segments", "variables",
    )


def q_first_delivered(spark, d):
    return src.first_messages(raw_messages(spark, d), 1000).select("MTMessageId", "PhoneNumber", "Message")


def q_day_counts(spark, d):
    rows = delivered(spark, d).withColumn("day", F.dayofmonth("ArrivalDate"))
    return stats.counts_by(src.select_days(rows, [1, 2, 3, 15]), "day")


def q_filtered_clients(spark, d):
    rows = src.filter_messages(delivered(spark, d), priority="Alto", operator="Tigo")
    return stats.counts_by(rows, "ClientName")


def q_lake_scan(spark, d):
    """From a lake of day folders written from the events table."""
    root = f"{shared_folder(spark).rstrip('/')}/lake-{uuid.uuid4().hex}"
    dated = raw_messages(spark, d).selectExpr("*", "year(ArrivalDate) as year", "month(ArrivalDate) as month", "day(ArrivalDate) as day")
    dated.repartition("year", "month", "day").write.partitionBy("year", "month", "day").parquet(root)
    rows = lake.scan_messages(lake.open_lake(spark, root), requests(spark, d), AS_OF, 14)
    return rows.groupBy("PhoneNumber").agg(F.count(F.lit(1)).alias("messages"), F.min("ArrivalDate").alias("first_arrival"),
                                           F.max("ArrivalDate").alias("last_arrival"))


def q_phone_timeline(spark, d):
    return lake.phone_timeline(delivered(spark, d), "573000000008").select("PhoneNumber", "Message", "ArrivalDate")


PROPS_SCHEMA = "k bigint"


def _json_lines(spark, d):
    return table(spark, d, "events").select(
        F.when(F.col("event_type") == "error", F.regexp_replace("props", "\\}$", "")).when(F.col("event_type") == "view", F.lit("  ")).otherwise(F.col("props")).alias("value")
    )


def q_tolerant_json(spark, d):
    good, bad = jsonl.parse_lines(_json_lines(spark, d), PROPS_SCHEMA)
    return (good.groupBy("k").agg(F.count(F.lit(1)).alias("lines")).withColumn("kind", F.lit("record"))
            .unionByName(bad.agg(F.count(F.lit(1)).alias("lines")).select(F.lit(None).cast("bigint").alias("k"), "lines", F.lit("rejected").alias("kind"))))


def q_resume_pending(spark, d):
    all_templates = stored(spark, freq(spark, d, include_pure=True))
    done = all_templates.where(F.substring("template_id", 1, 1) < "8")
    return jsonl.not_processed(all_templates, jsonl.processed_ids(done), 5).select("template_id", "template_text", "frequency")


def q_classification_lookup(spark, d):
    """Labels of every message as CSV-like rows with duplicates; the last one per template wins."""
    rows = frequency.templates_of(texts(spark, d)).withColumn("client_name", F.col("ClientName"))
    c = classify.classify_rules(rows.select("MTMessageId", "template_id", "template_text", "client_name"))
    csv = c.select(F.col("template_id").alias("ID Plantilla"), F.col("category").alias("Categoría"), F.col("subcategory").alias("Subcategoría"),
                   F.col("label").alias("Etiqueta (Label)"), "MTMessageId")
    return lookups.classification_lookup(csv, "MTMessageId")


def q_split_log(spark, d):
    rows = frequency.templates_of(texts(spark, d))
    return split.split_templates(rows).groupBy("has_placeholder").agg(
        F.count(F.lit(1)).alias("messages"), F.sum(F.length("template_text")).alias("template_chars"))


def q_run_metadata(spark, d):
    all_templates = stored(spark, freq(spark, d, include_pure=True))
    row = outputs.run_metadata(all_templates, classify.classify_rules(split.with_placeholders(all_templates)), "2024-01-31", "events")
    return row.select("total_messages", "unique_templates", "unique_pure_messages", "l0_classification.*")


def q_run_summary(spark, d):
    return frequency.run_summary(raw_messages(spark, d))


def q_normalized_messages(spark, d):
    return with_normalized(raw_messages(spark, d)).select("MTMessageId", "NormalizedMessage")


def q_normalization_report(spark, d):
    return normalization_report(with_normalized(raw_messages(spark, d)))


def q_normalization_samples(spark, d):
    return changed_samples(with_normalized(raw_messages(spark, d)), "MTMessageId")


def q_conversation_normalization(spark, d):
    rows = table(spark, d, "conversations").withColumnRenamed("text", "Message")
    return with_normalized(rows).select("conv_id", "turn", "NormalizedMessage")


def q_document_normalization(spark, d):
    return normalization_report(with_normalized(table(spark, d, "documents").withColumnRenamed("text", "Message")))


def q_templates(spark, d):
    rows = frequency.templates_of(texts(spark, d))
    return rows.select("MTMessageId", "template_id", "template_text", fired(), "has_placeholder")


def _texts(rows, key):
    t = extract_templates(rows.withColumn("cleaned_message", normalize_text("text")))
    return t.select(*key, "template_id", fired(), F.length("template_text").alias("template_chars"))


def q_conversation_templates(spark, d):
    return _texts(table(spark, d, "conversations"), ["conv_id", "turn"])


def q_document_templates(spark, d):
    return _texts(table(spark, d, "documents"), ["doc_id"])


def q_page_templates(spark, d):
    return _texts(table(spark, d, "pages").withColumnRenamed("html", "text"), ["page_id"])


def q_unified_spelling(spark, d):
    rows = table(spark, d, "conversations")
    return rows.select("conv_id", "turn", unify_spelling(normalize_text("text")).alias("unified"))


def q_template_frequency(spark, d):
    return freq(spark, d).select("template_id", "template_text", fired(), "client_name", "frequency", "first_seen", "last_seen")


def q_pure_text_frequency(spark, d):
    return frequency.pure_text_frequency(delivered(spark, d))


def q_distinct_counts(spark, d):
    return frequency.distinct_counts(delivered(spark, d))


def q_template_stats(spark, d):
    t = frequency.template_stats(texts(spark, d))
    return t.select("template_id", "template_text", "frequency", F.array_join("client_names", ",").alias("client_names"),
                    F.array_join(F.transform("priority_ids", lambda x: x.cast("string")), ",").alias("priority_ids"),
                    F.array_join("operator_names", ",").alias("operator_names"), "phone_count", "first_seen", "last_seen")


def q_split_summary(spark, d):
    return split.split_summary(frequency.templates_of(texts(spark, d)))


def q_frequent_coverage(spark, d):
    return frequency.frequent_coverage(freq(spark, d, include_pure=True))


def q_frequency_histogram(spark, d):
    return frequency.frequency_histogram(freq(spark, d, include_pure=True))


def q_top_frequent(spark, d):
    return frequency.top_frequent(freq(spark, d), 10).select("template_id", "template_text", "frequency")


def q_top_templates(spark, d):
    m = delivered(spark, d)
    best = frequency.top_templates(frequency.template_frequency(m, include_pure=True), 20, stats.message_count(m))
    return best.select("template_id", "template_text", "frequency", "pct")


def q_message_count(spark, d):
    return stats.message_count(delivered(spark, d))


def q_client_counts(spark, d):
    return stats.counts_by(delivered(spark, d), "ClientName")


def q_operator_counts(spark, d):
    return stats.counts_by(delivered(spark, d), "OperatorName")


def q_priority_counts(spark, d):
    return stats.counts_by(delivered(spark, d), *stats.PRIORITY)


def q_client_top(spark, d):
    return stats.top_values(delivered(spark, d), "ClientName", n=5)


def q_operator_top(spark, d):
    return stats.top_values(delivered(spark, d), "OperatorName", n=10)


def q_distinct_phones(spark, d):
    return stats.distinct_phones(delivered(spark, d))


def q_time_range(spark, d):
    return stats.time_range(delivered(spark, d))


def q_message_report(spark, d):
    return stats.message_report(delivered(spark, d))


def q_completeness(spark, d):
    return stats.completeness(delivered(spark, d))


def q_length_bands(spark, d):
    return stats.length_bands(delivered(spark, d))


def q_rule_classification(spark, d):
    return classified(spark, d).select("template_id", "template_text", "client_name", "frequency", "label", "category", "subcategory",
                                       "confidence", "level_used", "agreement", "rule_name", F.array_join("matched_tokens", ",").alias("matched_tokens"))


def q_message_classification(spark, d):
    """Every message's template classified with its own sender."""
    rows = frequency.templates_of(texts(spark, d)).withColumn("client_name", F.col("ClientName"))
    c = classify.classify_rules(rows.select("MTMessageId", "template_text", "client_name"))
    return c.select("MTMessageId", "label", "level_used", "rule_name")


def q_rule_coverage(spark, d):
    return classify.rule_coverage(classified(spark, d))


def q_label_report(spark, d):
    return reports.label_report(classified(spark, d)).withColumn("avg_confidence", F.round("avg_confidence", 6))


def q_label_export(spark, d):
    return reports.label_export(classified(spark, d))


def q_pending_top(spark, d):
    return reports.pending_top(classify.classify_rules(freq(spark, d, include_pure=True))).drop("applied_rules")


def q_pending_summary(spark, d):
    return reports.pending_summary(reports.pending_top(classify.classify_rules(freq(spark, d, include_pure=True))))


def q_pending_rules(spark, d):
    return reports.pending_rules(reports.pending_top(classified(spark, d)))


def q_resolve_votes(spark, d):
    return resolved(spark, d).select("template_id", "label", "category", "subcategory", F.round("confidence", 6).alias("confidence"), "level_used",
                                     "agreement", "panel_judge_1", "panel_judge_2", "arbiter_label", "needs_human_review", "error")


def q_resolve_votes_partial(spark, d):
    return resolved(spark, d, partial=True).select("template_id", "label", F.round("confidence", 6).alias("confidence"), "level_used")


def q_merged_labels(spark, d):
    """Votes after consolidating two overlapping labels, with their agreement rate."""
    pending = pending_keys(vote_templates(spark, d))
    v = spark.sql(JUDGE_SQL.replace("FROM pending", "FROM {pending}"), pending=pending)
    merged = votes.merge_labels(v, {"banking::otp_2fa": "public::security", "government::dian": "public::security"})
    pairs = votes.paired_votes(merged)
    return pairs.groupBy((F.col("panel_judge_1") == F.col("panel_judge_2")).alias("same")).agg(F.count(F.lit(1)).alias("templates"))


def q_level_summary(spark, d):
    return votes.level_summary(resolved(spark, d))


def q_top_labels(spark, d):
    return votes.top_labels(resolved(spark, d))


def q_top_categories(spark, d):
    return votes.top_labels(resolved(spark, d), "category")


def q_disagreements(spark, d):
    return votes.disagreements(resolved(spark, d))


def q_taxonomy_violations(spark, d):
    return votes.taxonomy_violations(resolved(spark, d), allow_abstain=True)


def q_extrapolated_shares(spark, d):
    return votes.extrapolate_shares(votes.label_counts(resolved(spark, d)).withColumn("share", F.round(F.col("pct") / 100.0, 6)), "share", 6_700_000).select(
        "label", "templates", "expected_messages")


def q_judged_templates(spark, d):
    """A pluggable judge (here: by text length) over the pending templates."""
    pending = vote_templates(spark, d).where("level_used = 'pending'")

    def by_length(text, rules, client):
        if len(text) % 5 == 4:
            raise ValueError("no answer")
        return ("utilities::water" if len(text) > 30 else "government::dian", 0.75)

    return votes.judge_templates(pending, by_length, 1)


def q_store_levels(spark, d):
    return store.stats_by_level(keyed_table(spark, d)).withColumn("avg_confidence", F.round("avg_confidence", 6))


def q_store_by_level(spark, d):
    return store.query_by_level(keyed_table(spark, d), "rule", 5).select("template_id", "label", "classified_at")


def q_store_by_confidence(spark, d):
    t = store.query_by_confidence(keyed_table(spark, d), 0.0, 0.9, 10)
    return t.select("template_id", F.round("confidence", 6).alias("confidence"))


def q_store_by_client(spark, d):
    return store.query_by_client(keyed_table(spark, d), "Nequi").select("template_id", "client_name", "classified_at")


def q_store_needing_review(spark, d):
    return store.query_needing_review(keyed_table(spark, d)).select("template_id", "level_used", "needs_human_review")


def _sightings(spark, d):
    """Every delivered message as an incoming template classified at its arrival."""
    rows = frequency.templates_of(texts(spark, d)).withColumn("client_name", F.col("ClientName"))
    return classify.classify_rules(rows.select("template_id", "template_text", "applied_rules", "client_name", F.col("ArrivalDate").alias("classified_at"))).where(
        "level_used = 'rule'")


def q_upsert_first_wins(spark, d):
    """A table that holds January 1-10, then everything again: ids already present keep their row."""
    incoming = store.conform(_sightings(spark, d))
    early = incoming.where(F.col("classified_at") < F.lit("2024-01-11 00:00:00").cast("timestamp_ntz"))
    table_then = store.new_rows(incoming.limit(0), early)
    return store.upsert_first_wins(table_then, incoming).select("template_id", "label", "client_name", "first_seen", "last_seen", "frequency")


def q_frequency_update(spark, d):
    incoming = store.conform(_sightings(spark, d))
    table_then = store.new_rows(incoming.limit(0), incoming.where(F.col("classified_at") < F.lit("2024-01-11 00:00:00").cast("timestamp_ntz")))
    later = incoming.where(F.col("classified_at") >= F.lit("2024-01-11 00:00:00").cast("timestamp_ntz")).select("template_id", "last_seen")
    return store.apply_frequency(table_then, later).select("template_id", "frequency", "last_seen")


def q_phone_hours(spark, d):
    return scoring.phone_hours(cells(spark, d))


def q_phone_dayparts(spark, d):
    return scoring.phone_dayparts(cells(spark, d))


def q_phone_weekdays(spark, d):
    return scoring.phone_weekdays(cells(spark, d))


def q_phone_categories(spark, d):
    return scoring.phone_categories(cells(spark, d))


def q_phone_subcategories(spark, d):
    return scoring.phone_subcategories(cells(spark, d))


def q_phone_types(spark, d):
    return scoring.phone_types(cells(spark, d))


def _documents(spark, d):
    rows = lake.lookback_filter(raw_messages(spark, d), AS_OF, 30)
    c = scoring.categorise(rows, lookup(spark, d))
    return scoring.score_documents(requests(spark, d), c, GENERATED_AT, 30)


def q_score_documents(spark, d):
    doc = _documents(spark, d)
    return doc.select("ordinal", "phone_number", F.to_json(F.struct("temporal_patterns", "categories", "message_types", "metadata"), {"ignoreNullFields": "false"}).alias("document"))


def q_score_documents_flat(spark, d):
    """Totals read back from the nested documents, phones without messages included."""
    doc = _documents(spark, d)
    total = lambda arr: F.aggregate(F.transform(arr, lambda x: x["messages_last_365d"]), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return doc.select(
        "phone_number", total("temporal_patterns.hourly_distribution").alias("hour_messages"),
        F.size("temporal_patterns.hourly_distribution").alias("hour_buckets"),
        total("temporal_patterns.weekday_distribution").alias("weekday_messages"),
        F.size("categories").alias("categories"), total("categories").alias("category_messages"),
        F.coalesce(F.get("categories", F.lit(0))["category"], F.lit("")).alias("first_category"),
        F.col("message_types.counts_last_365d.otp_2fa").alias("otp_2fa"),
        F.col("message_types.counts_last_365d.service_notifications").alias("service_notifications"),
        F.col("temporal_patterns.daypart_distribution.night_00_06_share_last_365d").alias("night_share"),
    )


def q_phone_profile(spark, d):
    return profiles.phone_profile(texts(spark, d))


def q_phone_profile_merged(spark, d):
    """Profiles of the first half of the month merged with those of the second."""
    m = texts(spark, d)
    cut = F.col("ArrivalDate") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    return profiles.merge_profiles(profiles.phone_profile(m.where(cut)), profiles.phone_profile(m.where(~cut)))


def q_hot_templates(spark, d):
    return profiles.hot_templates(freq(spark, d, include_pure=True), AS_OF).select("template_id", "frequency", "last_seen")


def q_known_traffic(spark, d):
    everything = stored(spark, freq(spark, d, include_pure=True))
    known = classify.classify_rules(split.with_placeholders(everything)).where("level_used = 'rule'")
    return profiles.known_traffic(profiles.route_known(everything, known))


def q_known_messages(spark, d):
    """Each message marked by whether its template is labelled."""
    rows = frequency.templates_of(texts(spark, d)).select("MTMessageId", "template_id")
    return profiles.route_messages(rows, stored(spark, classified(spark, d).where("level_used = 'rule'").select("template_id")))


#: Product texts with words changed, added and missing, down to one word (both engines).
PART_TEXT = """CASE p_partkey % 9 WHEN 0 THEN p_name WHEN 1 THEN concat(p_name, ' de ', p_type) WHEN 2 THEN p_type WHEN 3 THEN concat(p_name, ' de ', p_type, ' talla ', p_size, ' hoy')
  WHEN 4 THEN concat('oferta ', p_name, ' talla ', p_size) ELSE concat(p_name, ' de ', p_type, ' talla ', p_size) END"""


def part_templates(spark, d):
    """Short product texts as templates; the sender is the first brand."""
    rows = table(spark, d, "part").select(F.expr(PART_TEXT).alias("template_text"), F.col("p_brand").alias("sender"))
    return rows.groupBy("template_text").agg(F.min("sender").alias("sender")).withColumn("template_id", template_id("template_text"))


def q_near_templates(spark, d):
    return similarity.near_by_words(part_templates(spark, d))


def q_word_clusters(spark, d):
    c = similarity.cluster_templates(similarity.word_links(part_templates(spark, d), 1))
    return c.select(similarity.id_text("id").alias("template_id"), similarity.id_text("component").alias("cluster_id"))


def _similar(spark, d):
    """Half of the product texts are known and labelled; the others are classified, new ones by their neighbours."""
    rows = stored(spark, part_templates(spark, d).withColumnsRenamed({"sender": "client_name"}))
    is_known = F.substring("template_id", 1, 1) < "8"
    known = rows.where(is_known).withColumns({"label": F.concat(F.lit("part::"), F.substring("template_id", 1, 2)), "confidence": F.lit(0.9)})
    new = rows.where(~is_known).withColumns({"applied_rules": F.array().cast("array<string>"), "frequency": F.length("template_text").cast("bigint")})
    return cascade.cascade(classify.classify_rules(new), known)


def q_similar_levels(spark, d):
    return _similar(spark, d).select("template_id", "level_used", "label", "confidence", "similar_id", "similar_score")


def q_similar_level_counts(spark, d):
    return cascade.level_counts(_similar(spark, d))


def q_minhash_links(spark, d):
    return similarity.minhash_links(table(spark, d, "documents"), "doc_id", "text")


def q_minhash_clusters(spark, d):
    return similarity.minhash_clusters(table(spark, d, "documents"), "doc_id", "text")


def q_embedding_links(spark, d):
    """The given vectors point in random directions, so close ones have a cosine of 0.4."""
    return similarity.embedding_links(table(spark, d, "embeddings"), "vec_id", "embedding", 0.4).withColumn("cosine", F.round("cosine", 5))


def _quality(spark, d):
    """Fitted on the labelled documents, applied to all; the label is null where none is known."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    rows = docs.select("doc_id", normalize_text("text").alias("template_text"),
                       F.when(F.col("quality") == 1, F.lit("text::good")).when(F.col("quality") == 0, F.lit("text::bad")).alias("label"))
    return learn.predict_labels(learn.fit_text_classifier(rows.where("label is not null"), features=1 << 14), rows)


def q_text_classifier(spark, d):
    return _quality(spark, d).select("doc_id", "label", "predicted_label", F.round("prediction_confidence", 4).alias("confidence"), "accepted")


def _predictions(spark, d):
    """Predictions with a known answer, from labelled documents (no model, so both engines agree)."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    side = lambda c: F.concat(F.when(F.col("toxic") == 1, F.lit("toxic::")).otherwise(F.lit("clean::")), F.when(c, F.lit("good")).otherwise(F.lit("bad")))
    return docs.select(side(F.col("quality") == 1).alias("label"), side(F.col("n_chars") % 3 > 0).alias("predicted_label"),
                       ((F.col("n_chars") % 100) / F.lit(100.0)).alias("prediction_confidence"))


def q_confusion(spark, d):
    return learn.confusion(_predictions(spark, d))


def q_submodel_categories(spark, d):
    return learn.submodel_categories(learn.confusion(_predictions(spark, d)))


def q_threshold_curve(spark, d):
    return learn.threshold_curve(_predictions(spark, d))


def q_label_cuts(spark, d):
    """Half of the answers are right, so a cut for 0.45 of them."""
    return learn.label_cuts(learn.threshold_curve(_predictions(spark, d)), 0.45, 5)


def q_accepted_by_cut(spark, d):
    p = _predictions(spark, d)
    kept = learn.accept_by_cut(p, learn.label_cuts(learn.threshold_curve(p), 0.45, 5))
    return kept.groupBy("predicted_label", "accepted").agg(F.count(F.lit(1)).alias("rows"))


def q_model_levels(spark, d):
    """Levels 2 and 3 over all documents, fitted on two thirds of the labelled ones, cuts from the others."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    label = F.concat(F.when(F.col("toxic") == 1, F.lit("toxic::")).otherwise(F.lit("clean::")), F.when(F.col("quality") == 1, F.lit("good")).otherwise(F.lit("bad")))
    rows = docs.select(F.col("doc_id").cast("string").alias("template_id"), normalize_text("text").alias("template_text"), F.when(F.col("quality").isNotNull(), label).alias("label"))
    rows = stored(spark, rows)
    known, held = rows.where("label is not null and crc32(template_id) % 3 > 0"), rows.where("label is not null and crc32(template_id) % 3 = 0")
    model = learn.fit_cascade(known, held, min_precision=0.8, min_confusion=0.01, features=1 << 12)
    done = model.predict(rows.select("template_id", "template_text"))
    return done.select("template_id", "predicted_label", F.round("prediction_confidence", 4).alias("confidence"), "level", "accepted")


def q_training_readiness(spark, d):
    rows = _sightings(spark, d)
    return learn.training_readiness(rows, 0.9, 500)


def _stream_folder(spark):
    return f"{shared_folder(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"


def _stream_source(spark, d):
    """The events table as a stream of raw messages."""
    schema = table(spark, d, "events").schema
    rows = stream.stream_messages(spark, f"{d}/events.parquet*", schema, delivered=False)
    return src.delivered_only(spark.sql(messages_sql("SELECT event_id AS n, ts, user_id, event_type AS kind, value, props FROM {events}"), events=rows))


def q_streamed_template_counts(spark, d):
    out = _stream_folder(spark)
    stream.write_running(stream.running_template_counts(_stream_source(spark, d)), f"{out}/data", f"{out}/log").awaitTermination()
    return stream.latest_running(spark, f"{out}/data", "template_id", "template_text")


def q_streamed_first_sightings(spark, d):
    out = _stream_folder(spark)
    rows = stream.first_sightings(stream.stream_templates(_stream_source(spark, d)))
    stream.append_stream(rows.select("template_id", "template_text"), f"{out}/data", f"{out}/log").awaitTermination()
    return spark.read.parquet(f"{out}/data")


def q_written_first_sightings(spark, d):
    """Each template with its first arrival, written batch by batch."""
    out = _stream_folder(spark)
    stream.write_first_sightings(stream.stream_templates(_stream_source(spark, d)), f"{out}/data", f"{out}/log", kept=2).awaitTermination()
    return stream.known_sightings(spark, f"{out}/data").select("template_id", "template_text")


# --- what is written out, read back -------------------------------------------------------------


def q_written_split(spark, d):
    """The split tables of a run, read back."""
    out = _stream_folder(spark)
    outputs.write_split(frequency.templates_of(texts(spark, d)).withColumnRenamed("Message", "original_message"), out, "2024-01-31")
    back = spark.read.parquet(out).withColumn("has_placeholder", F.col("has_placeholder").cast("boolean"))
    return back.groupBy("has_placeholder").agg(F.count(F.lit(1)).alias("messages"))


def q_written_template_log(spark, d):
    """Two appended runs of the template log, read back."""
    out = _stream_folder(spark)
    rows = frequency.templates_of(texts(spark, d)).withColumnRenamed("Message", "original_message")
    for _ in range(2):
        outputs.append_template_log(rows, out)
    return spark.read.json(out).groupBy("template_id", "category").agg(F.count(F.lit(1)).alias("lines"))


def q_day_run(spark, d):
    """A whole daily run: the unique templates it wrote, with the result its log has of them."""
    paths = DayPaths(_stream_folder(spark))
    run_day(raw_messages(spark, d), paths, "2024-01-31", "events")
    unique = read_unique_templates(spark, paths, "2024-01-31").select("template_id", "template_text", "frequency", "first_seen", "last_seen")
    log = jsonl.read_results(spark, paths.of("rule_classifications")).select("template_id", "label", "confidence", "level_used")
    return unique.join(log, "template_id", "left")


def q_stored_slice(spark, d):
    """The materialised look-back slice, read back."""
    out = _stream_folder(spark)
    lake.write_slice(raw_messages(spark, d), out, AS_OF, 14)
    return spark.read.parquet(out).groupBy("year", "month", "PhoneNumber").agg(F.count(F.lit(1)).alias("messages"))


def q_exported_table(spark, d):
    """The keyed table as CSV, read back as text."""
    out = _stream_folder(spark)
    store.export_csv(keyed_table(spark, d), out, 1 << 30)
    back = spark.read.option("header", "true").csv(out)
    return back.groupBy("level_used", F.coalesce("label", F.lit("")).alias("label")).agg(F.count(F.lit(1)).alias("templates"), F.sum(F.col("frequency").cast("bigint")).alias("messages"))


def q_scored_phones(spark, d):
    """From the messages to the written documents, read back: messages and metadata of every requested phone."""
    out = _stream_folder(spark)
    scoring.write_documents(score_phones(raw_messages(spark, d), requests(spark, d), lookup(spark, d), AS_OF, GENERATED_AT, 30, "ref"), out)
    back = spark.read.json(out)
    total = F.aggregate(F.transform("temporal_patterns.hourly_distribution", lambda x: x["messages_last_365d"]), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return back.select("phone_number", total.alias("messages"), F.col("metadata.generated_at").alias("generated_at"), F.col("metadata.request_reference").alias("request_reference"),
                       F.col("metadata.granularity").alias("granularity"), F.col("metadata.data_lookback_days").alias("data_lookback_days"), F.col("metadata.version").alias("version"))


def q_phone_profile_updated(spark, d):
    """The first half of the month as a snapshot, the second merged into the phone ranges it touches."""
    out = _stream_folder(spark)
    m = texts(spark, d)
    cut = F.col("ArrivalDate") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    profiles.write_profiles(profiles.phone_profile(m.where(cut)), f"{out}/snapshot", 8)
    profiles.update_profiles(spark, f"{out}/snapshot", profiles.phone_profile(m.where(~cut)), f"{out}/work", 8)
    return profiles.read_profiles(spark, f"{out}/snapshot")


def q_word_clusters_updated(spark, d):
    """Clusters of a third of the links, brought up to date twice."""
    links = stored(spark, similarity.word_links(part_templates(spark, d), 1).withColumn("day", F.pmod(F.xxhash64("src", "dst"), F.lit(3))))
    labels = similarity.connected_components(links.where("day = 0"))
    for day in (1, 2):
        labels = similarity.update_components(labels, links.where(F.col("day") == day))
    return labels.select(similarity.id_text("id").alias("template_id"), similarity.id_text("component").alias("cluster_id"))


def q_own_rules(spark, d):
    """Rules given by the caller in place of the built-in ones, in their order."""
    rules = [
        classify.ClassificationRule("pin", "security::pin", required_any=frozenset({"OTP", "PHONE"}), forbidden=frozenset({"ENTIDAD_BANCARIA"}), confidence=0.6),
        classify.ClassificationRule("bank", "banking::any", required_all=frozenset({"ENTIDAD_BANCARIA"}), confidence=0.5),
        classify.ClassificationRule("late", "never::reached", required_all=frozenset({"ENTIDAD_BANCARIA", "OTP"})),
    ]
    done = classify.classify_rules(stored(spark, freq(spark, d, include_pure=True)), rules)
    return done.select("template_id", "label", "rule_name", "confidence", "level_used")


QUERIES = {name[2:]: fn for name, fn in list(globals().items()) if name.startswith("q_")}
