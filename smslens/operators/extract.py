"""Template extraction: ordered regex rewrites of message text into placeholders.

Each rule is one projection.  A rule is skipped for texts that cannot match it, by plain substring
tests on the lower-cased input; the tests never change the result, they only save regex passes.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from smslens.functions.text import sql_name, sql_text, template_id, unify_spelling
from smslens.functions.vocabulary import FRAGMENTS, OTP_TRIGGER, PLACEHOLDER_TABLE

FLAGS = "(?iU)"
DIGIT = r"(?U)\d"
# Rules per code generation unit: one span over all rules is too long for the JIT compiler.
SPAN = 8
BITS = 62  # rules per mask column


@dataclass(frozen=True)
class PlaceholderRule:
    """One rewrite.  ``fragments`` is an optional pre-filter: texts holding none of them cannot match."""

    name: str
    pattern: str
    placeholder: str
    priority: int = 100
    enabled: bool = True
    fragments: tuple[str, ...] = ()


DEFAULT_RULES = tuple(
    PlaceholderRule(name, pattern, token, priority, True, FRAGMENTS[name])
    for name, priority, token, pattern in PLACEHOLDER_TABLE
)


def active_rules(rules=None) -> list[PlaceholderRule]:
    """Enabled rules by ascending priority; equal priorities keep their order."""
    chosen = DEFAULT_RULES if rules is None else rules
    return sorted((r for r in chosen if r.enabled), key=lambda r: r.priority)


def _java_replacement(text: str) -> str:
    return re.sub(r"([\\$])", r"\\\1", text)


def _may_match(rule: PlaceholderRule, earlier: list[PlaceholderRule]) -> str | None:
    """Pre-filter condition of a rule, or None when no safe one exists.

    The fragments are looked up in the input text.  A later text differs from it only by inserted
    placeholders, so an earlier placeholder that contains a fragment re-opens the rule.
    """
    if not rule.fragments or any(set(f) & set("[]") for f in rule.fragments):
        return None
    if not all(re.fullmatch(r"\[[^\[\]0-9]*\]", e.placeholder) for e in earlier):
        return None
    tests = ["__odd"]
    for fragment in rule.fragments:
        tests.append("__digit" if fragment == "0-9" else f"contains(__low, {sql_text(fragment)})")
    for e in earlier:
        if any(f in e.placeholder.lower() for f in rule.fragments):
            tests.append(f"contains(__text, {sql_text(e.placeholder)})")
    return " or ".join(tests)


def _rewrite(rule: PlaceholderRule, earlier: list[PlaceholderRule]) -> str:
    replaced = f"regexp_replace(__text, {sql_text(FLAGS + rule.pattern)}, {sql_text(_java_replacement(rule.placeholder))})"
    gate = _may_match(rule, earlier)
    if rule.name == "otp":
        gate = "__otp" if gate is None else f"({gate}) and __otp"
    return replaced if gate is None else f"case when {gate} then {replaced} else __text end"


def _mask_names(rules: list[PlaceholderRule]) -> list[str]:
    return [f"rule_mask{m}" for m in range((max(len(rules), 1) - 1) // BITS + 1)]


def _record(masks: list[str], k: int) -> list[str]:
    """Mask columns after noting whether rule k changed the text (k < 0: nothing to note)."""
    bit = 1 << (k % BITS)
    return [
        f"case when __text <> __before then {m} | {bit}L else {m} end as {m}" if k >= 0 and k // BITS == i else m
        for i, m in enumerate(masks)
    ]


def rewrite_texts(df: DataFrame, text_col: str = "cleaned_message", rules=None, unify: bool = False) -> DataFrame:
    """All columns of df plus ``template_text`` and bit masks of the rules that fired (``rule_mask0`` ...).

    Aggregate on the masks and name the rules afterwards with ``with_rule_names``.
    """
    chosen = active_rules(rules)
    keep = [sql_name(c) for c in df.columns]
    masks = _mask_names(chosen)
    carried = ["__low", "__odd", "__digit", "__otp"]
    source = F.coalesce(F.col(sql_name(text_col)), F.lit(""))
    step = df.withColumn("__text", unify_spelling(source) if unify else source)
    # Only these four letters beyond ASCII equal an ASCII letter when case is ignored.
    odd = " or ".join(f"contains(__text, '{x}')" for x in "İıſK")
    step = step.selectExpr(
        *keep,
        "__text",
        "__text as __before",
        "lower(__text) as __low",
        f"length(__text) <> octet_length(__text) and ({odd}) as __odd",
        f"__text rlike {sql_text(DIGIT)} as __digit",
        f"__text rlike {sql_text(FLAGS + OTP_TRIGGER)} as __otp",
        *[f"0L as {m}" for m in masks],
    )
    for k, rule in enumerate(chosen):
        if k and k % SPAN == 0:
            # The identity transform, a higher-order function, ends the whole-stage codegen span here.
            step = step.selectExpr(*keep, "transform(array(__text), t -> t)[0] as __text", "__before", *carried, *masks)
        step = step.selectExpr(
            *keep, f"{_rewrite(rule, chosen[:k])} as __text", "__text as __before", *carried, *_record(masks, k - 1)
        )
    step = step.selectExpr(*keep, "__text", *_record(masks, len(chosen) - 1))
    # A one-element inline ends the chain: the optimizer does not push filters on the result through it.
    # Pushed through the rules, where each step names its input several times, a filter would grow
    # exponentially.
    return step.selectExpr(*keep, f"inline(array(struct(__text as template_text, {', '.join(masks)})))")


def with_rule_names(df: DataFrame, rules=None) -> DataFrame:
    """Replace the masks by ``applied_rules``, the names in firing order."""
    chosen = active_rules(rules)
    masks = _mask_names(chosen)
    names = ", ".join(f"case when {masks[k // BITS]} & {1 << (k % BITS)}L <> 0 then {sql_text(r.name)} end" for k, r in enumerate(chosen))
    any_fired = " or ".join(f"{m} <> 0" for m in masks)
    listed = f"case when {any_fired} then filter(array({names}), name -> name is not null) else array() end"
    return df.withColumn("applied_rules", F.expr(f"cast({listed} as array<string>)")).drop(*masks)


def text_key(text: Column) -> list[Column]:
    """Two 64-bit hashes that stand for a text in joins and groups."""
    return [F.xxhash64(text).alias("h1"), F.xxhash64(F.lit("b"), text).alias("h2")]


def distinct_templates(texts: DataFrame, text_col: str = "cleaned_message", rules=None) -> DataFrame:
    """(h1, h2, template_id, template_text): the rules applied once to every distinct text.

    The texts collapse next to their input and are spread by the shuffle, so the rules run on all cores whatever the
    input's splits.  Join messages to it by ``text_key``: only hashes of theirs have to move.
    """
    once = texts.select(F.col(sql_name(text_col)).alias("cleaned_message")).groupBy("cleaned_message").agg(F.lit(1).alias("one"))
    rows = rewrite_texts(once.drop("one"), rules=rules)
    return rows.select(*text_key(F.col("cleaned_message")), template_id("template_text").alias("template_id"), "template_text")


def extract_templates(df: DataFrame, text_col: str = "cleaned_message", rules=None, unify: bool = False) -> DataFrame:
    """Add ``template_text``, ``template_id``, ``applied_rules`` and ``has_placeholder``.

    All input columns are kept.  ``unify`` drops accents and abbreviation dots first.
    """
    named = with_rule_names(rewrite_texts(df, text_col, rules, unify), rules)
    return named.select(
        *[F.col(sql_name(c)) for c in df.columns],
        "template_text",
        template_id("template_text").alias("template_id"),
        "applied_rules",
        (F.size("applied_rules") > 0).alias("has_placeholder"),
    )
