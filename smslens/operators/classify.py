"""Level-0 classification: the first rule whose token set and sender conditions hold."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from smslens.functions.labels import label_category, label_subcategory
from smslens.functions.text import sql_name, sql_text
from smslens.functions.vocabulary import RULE_CATALOG

MATCH_TYPE = "struct<label: string, confidence: double, rule_name: string, watched: array<string>>"


@dataclass(frozen=True)
class ClassificationRule:
    name: str
    label: str
    priority: int = 100
    required_all: frozenset[str] = frozenset()
    required_any: frozenset[str] = frozenset()
    forbidden: frozenset[str] = frozenset()
    sender_pattern: str | None = None
    confidence: float = 1.0


def catalog() -> list[ClassificationRule]:
    """The built-in rules in ascending priority."""
    rules = [
        ClassificationRule(name, label, prio, frozenset(every), frozenset(some), frozenset(no), sender, conf)
        for name, prio, label, conf, every, some, no, sender in RULE_CATALOG
    ]
    return sorted(rules, key=lambda r: r.priority)


def extract_tokens(text: Column | str) -> Column:
    """Distinct ``[TOKEN]`` names of a template text, in order of appearance."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(r"\[([A-Z_]+)\]"), F.lit(1)))


def _has_token(text: str, token: str) -> str:
    # A token name has no brackets, so it is in the token set exactly when "[NAME]" is in the text.
    return f"contains({text}, {sql_text('[' + token + ']')})" if re.fullmatch("[A-Z_]+", token) else "false"


def rule_condition(rule: ClassificationRule, text: str = "template_text", sender: str = "client_name") -> str:
    """SQL condition: sender pattern, then no forbidden token, all required tokens, any of the alternatives."""
    parts = []
    if rule.sender_pattern:
        parts.append(f"coalesce({sender} <> '' and {sender} rlike {sql_text('(?iu)' + rule.sender_pattern)}, false)")
    parts += ["not " + _has_token(text, t) for t in sorted(rule.forbidden)]
    parts += [_has_token(text, t) for t in sorted(rule.required_all)]
    if rule.required_any:
        parts.append("(" + " or ".join(_has_token(text, t) for t in sorted(rule.required_any)) + ")")
    return " and ".join(parts) or "true"


def _first_rule(text: str, sender: str, rules) -> str:
    """SQL: struct of the first matching rule with the tokens it looks at, or null."""
    branches = []
    for rule in rules:
        watched = ", ".join(sql_text(t) for t in sorted(rule.required_all | rule.required_any))
        branches.append(
            f"when {rule_condition(rule, text, sender)} then struct({sql_text(rule.label)} as label,"
            f" cast({rule.confidence!r} as double) as confidence, {sql_text(rule.name)} as rule_name,"
            f" cast(array({watched}) as array<string>) as watched)"
        )
    return f"case {' '.join(branches)} end" if branches else f"cast(null as {MATCH_TYPE})"


def classify_rules(templates: DataFrame, rules=None) -> DataFrame:
    """Add label, category, subcategory, confidence, level_used (rule / pending), agreement, rule_name, matched_tokens.

    The first rule that holds wins: built-in rules by priority, caller-supplied ones in their order.
    """
    chosen = catalog() if rules is None else list(rules)
    text = "coalesce(template_text, '')"
    found = templates.withColumn("__m", F.expr(_first_rule(text, "client_name", chosen)))
    label = F.col("__m.label")
    return found.select(
        *[F.col(sql_name(c)) for c in templates.columns],
        label.alias("label"),
        label_category(label).alias("category"),
        label_subcategory(label).alias("subcategory"),
        F.coalesce("__m.confidence", F.lit(0.0)).alias("confidence"),
        F.when(F.col("__m").isNull(), F.lit("pending")).otherwise(F.lit("rule")).alias("level_used"),
        F.col("__m").isNotNull().alias("agreement"),
        F.col("__m.rule_name").alias("rule_name"),
        F.sort_array(F.array_intersect(extract_tokens(F.expr(text)), F.col("__m.watched"))).alias("matched_tokens"),
    )


def rule_coverage(classified: DataFrame) -> DataFrame:
    """One row: templates classified, matched by a rule, pending, and the matched percentage (0 when empty)."""
    hit = F.col("level_used") == "rule"
    sums = classified.agg(
        F.count(F.lit(1)).alias("total_classified"), F.count_if(hit).alias("matched_rules"), F.count_if(~hit).alias("pending")
    )
    pct = F.when(F.col("total_classified") > 0, 100.0 * F.col("matched_rules") / F.col("total_classified"))
    return sums.withColumn("coverage_pct", F.coalesce(pct, F.lit(0.0)).cast("double"))
