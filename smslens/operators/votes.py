"""Levels 1 and 2: two judges, an arbiter, human review - resolved from vote tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from smslens.functions.labels import label_category, label_subcategory
from smslens.functions.vocabulary import ABSTAIN, TAXONOMY_LABELS
from smslens.operators.joins import share_of_listed

DEFAULT_THRESHOLD = 0.7


def paired_votes(votes: DataFrame) -> DataFrame:
    """One row per template with both judges' label and confidence.

    ``votes``: template_id, judge (1 or 2), label, confidence; one vote per judge and template.
    """

    def vote(judge: int, column: str) -> Column:
        return F.max(F.when(F.col("judge") == judge, F.col(column)))

    return votes.groupBy("template_id").agg(
        vote(1, "label").alias("panel_judge_1"),
        vote(1, "confidence").alias("panel_judge_1_conf"),
        vote(2, "label").alias("panel_judge_2"),
        vote(2, "confidence").alias("panel_judge_2_conf"),
    )


def resolve_votes(
    classified: DataFrame, votes: DataFrame, arbiter: DataFrame, threshold: float = DEFAULT_THRESHOLD, partial_agreement: bool = False
) -> DataFrame:
    """Final result per template.

    A result of an earlier level (a rule, a similar template, the text model: anything but ``pending``) stands.  Otherwise equal labels whose lower confidence reaches the threshold are a
    panel agreement; else the arbiter decides, ABSTAIN meaning human review.  A judge without a vote
    voted ``error`` with confidence 0.  A missing arbiter decision, or one with an error, is an error.
    ``partial_agreement`` also accepts two labels of one category, as that category.
    """
    base = classified.join(paired_votes(votes), "template_id", "left").join(
        arbiter.select(
            "template_id",
            F.col("label").alias("__a_label"),
            F.col("confidence").alias("__a_conf"),
            F.col("reasoning").alias("__a_why"),
            F.col("error").alias("__a_error"),
        ),
        "template_id",
        "left",
    )
    j1, j2 = F.coalesce("panel_judge_1", F.lit("error")), F.coalesce("panel_judge_2", F.lit("error"))
    c1, c2 = F.coalesce("panel_judge_1_conf", F.lit(0.0)), F.coalesce("panel_judge_2_conf", F.lit(0.0))
    low = F.least(c1, c2)
    settled = F.coalesce(F.col("level_used") != "pending", F.lit(False))
    agree = (j1 == j2) & (low >= threshold)
    family = (label_category(j1) == label_category(j2)) & (low >= threshold) if partial_agreement else F.lit(False)
    failed = F.col("__a_label").isNull() | F.col("__a_error").isNotNull()
    abstained = F.col("__a_label") == ABSTAIN
    level = (
        F.when(settled, F.col("level_used"))
        .when(agree, F.lit("panel_agreement"))
        .when(family, F.lit("partial_agreement"))
        .when(failed, F.lit("error"))
        .when(abstained, F.lit("human_review"))
        .otherwise(F.lit("arbiter"))
    )
    step = base.withColumn("__level", level).withColumn("__settled", settled)
    lv, stands = F.col("__level"), F.col("__settled")
    voted = ~stands & (lv != "error")
    decided = lv.isin("arbiter", "human_review")
    label = (
        F.when(stands, F.col("label")).when(lv == "panel_agreement", j1).when(lv == "partial_agreement", label_category(j1))
        .when(lv == "error", F.lit("ERROR")).otherwise(F.col("__a_label"))
    )
    confidence = (
        F.when(stands, F.col("confidence")).when(lv.isin("panel_agreement", "partial_agreement"), low)
        .when(lv == "error", F.lit(0.0)).otherwise(F.col("__a_conf"))
    )
    replaced = {
        "label", "category", "subcategory", "confidence", "level_used", "agreement",
        "panel_judge_1", "panel_judge_1_conf", "panel_judge_2", "panel_judge_2_conf",
    }
    kept = [F.col(f"`{c}`") for c in classified.columns if c not in replaced]
    return step.select(
        *kept,
        label.alias("label"),
        label_category(label).alias("category"),
        label_subcategory(label).alias("subcategory"),
        confidence.alias("confidence"),
        lv.alias("level_used"),
        (stands | (lv == "panel_agreement")).alias("agreement"),
        F.when(voted, j1).alias("panel_judge_1"),
        F.when(voted, c1).alias("panel_judge_1_conf"),
        F.when(voted, j2).alias("panel_judge_2"),
        F.when(voted, c2).alias("panel_judge_2_conf"),
        F.when(decided, F.col("__a_label")).alias("arbiter_label"),
        (lv == "human_review").alias("arbiter_abstained"),
        F.when(decided, F.col("__a_why")).alias("arbiter_reasoning"),
        lv.isin("human_review", "error").alias("needs_human_review"),
        F.when(lv == "error", F.coalesce("__a_error", F.lit("no arbiter decision"))).alias("error"),
    )


def message_metadata(df: DataFrame) -> DataFrame:
    """Add ``message`` (struct of the original message's fields), null when the original text is empty."""
    fields = [
        "original_message", "cleaned_message", "client_name", "client_id", "phone_number", "operator_name",
        "account_name", "priority_description", "timestamp",
    ]
    present = [F.col(f) if f in df.columns else F.lit(None).cast("string").alias(f) for f in fields]
    has_text = F.length(F.coalesce("original_message", F.lit(""))) > 0
    return df.withColumn("message", F.when(has_text, F.struct(*present)))


LEVELS = ("panel_agreement", "arbiter", "human_review", "error")


def level_summary(results: DataFrame) -> DataFrame:
    """One row: total, count and percentage of each vote level (percent of max(total, 1))."""
    sums = results.agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("level_used") == lv).alias(lv) for lv in LEVELS]
    )
    base = F.greatest(F.col("total"), F.lit(1))
    return sums.select("*", *[(100.0 * F.col(lv) / base).cast("double").alias(f"{lv}_pct") for lv in LEVELS])


def label_counts(results: DataFrame, column: str = "label") -> DataFrame:
    """Every label (or category) with its templates and their percentage of all."""
    counts = results.groupBy(column).agg(F.count(F.lit(1)).alias("templates"))
    return counts.withColumn("pct", 100.0 * share_of_listed("templates"))


def top_labels(results: DataFrame, column: str = "label", n: int = 10) -> DataFrame:
    """The n most frequent of them."""
    return label_counts(results, column).orderBy(F.desc("templates"), column).limit(n)


def disagreements(results: DataFrame, n: int = 10) -> DataFrame:
    """Most frequent "judge 1 vs judge 2" pairs among arbiter decisions, with percentage of those."""
    pairs = (
        results.where(F.col("level_used") == "arbiter")
        .groupBy(F.concat_ws(" vs ", "panel_judge_1", "panel_judge_2").alias("pattern"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
    return pairs.withColumn("pct", 100.0 * share_of_listed("occurrences")).orderBy(F.desc("occurrences"), "pattern").limit(n)


def taxonomy_violations(results: DataFrame, allow_abstain: bool = False, labels=TAXONOMY_LABELS) -> DataFrame:
    """Labels outside the taxonomy with the number of rows that carry them."""
    allowed = [*labels, ABSTAIN] if allow_abstain else list(labels)
    return (
        results.where(F.col("label").isNotNull() & (F.col("label") != "") & ~F.col("label").isin(allowed))
        .groupBy("label")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def judge_templates(templates: DataFrame, judge, judge_id: int, partitions: int | None = None) -> DataFrame:
    """Votes of a user-supplied judge: ``judge(text, rules, client) -> (label, confidence)``.

    Runs in ``mapInPandas`` over the pending templates; a call that raises is an ``error`` vote with
    confidence 0.  ``partitions`` sets how many calls run side by side.
    """
    rows = templates.select("template_id", "template_text", "applied_rules", "client_name")
    if partitions:
        rows = rows.repartition(partitions, "template_id")

    def run(batches):
        for pdf in batches:
            answers = []
            for text, fired, client in zip(pdf["template_text"], pdf["applied_rules"], pdf["client_name"]):
                try:
                    answers.append(judge(text, list(fired), client))
                except Exception:
                    answers.append(("error", 0.0))
            yield pdf[["template_id"]].assign(
                judge=judge_id, label=[a[0] for a in answers], confidence=[float(a[1]) for a in answers]
            )

    return rows.mapInPandas(run, "template_id string, judge int, label string, confidence double")


def merge_labels(df: DataFrame, mapping: dict[str, str], columns=("label",)) -> DataFrame:
    """Replace overlapping labels by their merged label; labels without an entry stay."""
    if not mapping:
        return df
    pairs = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return df.withColumns({c: F.coalesce(F.try_element_at(pairs, F.col(c)), F.col(c)) for c in columns})


def extrapolate_shares(shares: DataFrame, share_col: str, volume: float) -> DataFrame:
    """Expected messages per row when a sample's shares hold for ``volume`` messages."""
    return shares.withColumn("expected_messages", F.round(F.col(share_col) * F.lit(float(volume))).cast("bigint"))
