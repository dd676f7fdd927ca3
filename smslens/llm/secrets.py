"""Secret scan on DataFrame functions alone: fixed patterns, and a battery of randomness tests for other tokens.

Patterns find assignments, access keys and long hex strings.  Every other run of 20 or more encoding characters is a
token: its encoding (hex, base32, base62, base64) is inferred, and its symbols are tested against uniform randomness
over that alphabet: chi-squared of the symbol counts, runs above and below the middle, correlation of neighbours.
Text fails; a secret passes.  Which tokens fail is decided over the whole table by the Benjamini-Hochberg procedure
on the combined p-values, each weighted by its token's length, since longer tokens are better evidence; so at most a
stated share of those told apart as text are in truth random.  Tokens that do not fail are added as `random` spans.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smslens.llm.common import once, text_or_empty

#: The patterns and least lengths of the scan's contract.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS, HEX = "AKIA[A-Z0-9]{16,}", "[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

TOKEN = "[A-Za-z0-9+/_-]{20,}={0,2}"
#: Share of true random tokens among those told apart as text.
FALSE_SHARE = 0.01
#: Places of the p-value grid per power of ten, and its end.
GRID, GRID_END = 20, 6000
BASE64 = string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/"


def spans(text: Column, pattern: str, group: int = 0) -> Column:
    """Matches as (start, end, value of the group), in code points; leftmost, without overlap."""
    found, between = F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.split(text, pattern, -1)
    value = found if group == 0 else F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    steps = F.arrays_zip(F.slice(between, 1, F.size(found)).alias("gap"), found.alias("hit"), value.alias("value"))
    none = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        start = acc["at"] + F.char_length(s["gap"])
        end = start + F.char_length(s["hit"])
        return F.struct(end.alias("at"), F.array_append(acc["out"], F.struct(start.alias("start"), end.alias("end"), s["value"].alias("value"))).alias("out"))

    return F.aggregate(steps, none, step)["out"]


def none() -> Column:
    return F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")


def any_of(text: Column, words: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | F.contains(text, F.lit(w))
    return out


def upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution (Abramowitz and Stegun 26.2.17), at least 1e-300."""
    a = F.least(F.abs(z), F.lit(37.0))
    t = 1 / (1 + 0.2316419 * a)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    tail = F.greatest(F.exp(-a * a / 2) * 0.3989422804014327 * poly, F.lit(1e-300))
    return F.when(z >= 0, tail).otherwise(1 - tail)


def alphabet_size(token: Column) -> Column:
    return F.when(token.rlike("^([0-9a-f]+|[0-9A-F]+)$"), 16.0).when(token.rlike("^[A-Z2-7]+$"), 32.0).when(token.rlike("^[A-Za-z0-9]+$"), 62.0).otherwise(64.0)


def token_p(token: Column) -> Column:
    """Combined p-value of the battery under the hypothesis that a token is random: three tests by Bonferroni."""
    body = F.regexp_replace(F.translate(token, "-_", "+/"), "=+$", "")
    size = alphabet_size(body)
    plain = F.when(size == 16, F.lit("0123456789abcdef")).when(size == 32, F.lit(string.ascii_uppercase + "234567")).otherwise(F.lit(BASE64))
    shown = F.when(size == 16, F.lower(body)).otherwise(body)
    start = F.struct(shown.alias("s"), plain.alias("alphabet"), size.alias("k"), F.char_length(shown).cast("double").alias("n"))
    # each step's values are bound by a one-element transform, so that they are worked out once
    stage = F.transform(F.array(start), lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["n"].alias("n"), F.transform(F.split(x["s"], ""), lambda c: F.instr(x["alphabet"], c).cast("double") - 1).alias("v")))
    stage = F.transform(stage, lambda x: F.struct(
        x["k"].alias("k"), x["n"].alias("n"), x["v"].alias("v"), (F.aggregate(x["v"], F.lit(0.0), lambda a, b: a + b) / x["n"]).alias("mean"),
        F.aggregate(F.array_distinct(x["v"]), F.lit(0.0), lambda a, b: a + F.pow(F.size(F.filter(x["v"], lambda c: c == b)).cast("double"), F.lit(2.0))).alias("squares"),
        F.size(F.filter(x["v"], lambda c: c >= x["k"] / 2)).cast("double").alias("high"),
    ))
    stage = F.transform(stage, lambda x: F.struct(
        x["k"].alias("k"), x["n"].alias("n"), x["squares"].alias("squares"), x["high"].alias("high"),
        F.aggregate(x["v"], F.lit(0.0), lambda a, b: a + (b - x["mean"]) * (b - x["mean"])).alias("spread"),
        F.aggregate(F.zip_with(F.slice(x["v"], F.lit(2), F.size(x["v"])), F.slice(x["v"], F.lit(1), F.size(x["v"]) - 1), lambda a, b: (a - x["mean"]) * (b - x["mean"])), F.lit(0.0), lambda a, b: a + b).alias("together"),
        (1 + F.aggregate(F.zip_with(F.slice(x["v"], F.lit(2), F.size(x["v"])), F.slice(x["v"], F.lit(1), F.size(x["v"]) - 1), lambda a, b: F.when((a >= x["k"] / 2) != (b >= x["k"] / 2), 1.0).otherwise(0.0)), F.lit(0.0), lambda a, b: a + b)).alias("runs"),
    ))

    def combined(x: Column) -> Column:
        n, k = x["n"], x["k"]
        chi = (k / n * x["squares"] - n - (k - 1)) / F.sqrt(2 * (k - 1) * (n - 1) / n)
        mean = 2 * x["high"] * (n - x["high"]) / n + 1
        width = F.sqrt(F.greatest((mean - 1) * (mean - 2) / (n - 1), F.lit(1e-12)))
        runs = F.when((x["high"] == 0) | (x["high"] == n), 37.0).otherwise(F.abs(x["runs"] - mean) / width)
        serial = F.when(x["spread"] == 0, 37.0).otherwise(F.abs(x["together"] / F.greatest(x["spread"], F.lit(1e-12))) * F.sqrt(n))
        least = F.least(upper_tail(chi), 2 * upper_tail(runs), 2 * upper_tail(serial))
        return F.least(3 * least, F.lit(1.0))

    return F.element_at(F.transform(stage, combined), 1)


def found_spans(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, base spans by kind, and the other tokens with p-values."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    text = F.col("text")
    assign = F.filter(spans(text, ASSIGN, 2), lambda s: F.char_length(s["value"]) >= 6)
    rows = once(
        rows, ["doc_id", "text"],
        assign=F.when(any_of(F.lower("text"), ASSIGN_WORDS), assign).otherwise(none()),
        access=F.when(F.contains("text", F.lit("AKIA")), spans(text, ACCESS)).otherwise(none()),
        hex=F.when(text.rlike(HEX), spans(text, HEX)).otherwise(none()),
        tokens=F.when(text.rlike(TOKEN), spans(text, TOKEN)).otherwise(none()),
    )
    base = F.concat("assign", "access", "hex")
    apart = F.filter("tokens", lambda t: ~F.exists(base, lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    return once(rows, ["doc_id", "assign", "access", "hex"], tested=F.transform(apart, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"), (token_p(t["value"]) / F.char_length(t["value"])).alias("p"))))


def text_threshold(found: DataFrame, share: float) -> float:
    """The weighted p up to which tokens count as text: Benjamini-Hochberg on a grid of p-values.

    A token's p was divided by its length; multiplied by the mean length that makes weights of mean 1.
    """
    tested = found.select(F.explode("tested").alias("t")).select((F.col("t.end") - F.col("t.start")).alias("length"), F.col("t.p").alias("p"))
    place = F.greatest(F.least(F.floor(-F.log10("p") * GRID), F.lit(GRID_END)), F.lit(0))
    cells = tested.groupBy(place.alias("place")).agg(F.count("*").alias("n"), F.sum("length").alias("length")).collect()  # GRID_END rows at most
    total, mean = sum(c.n for c in cells), sum(c.length for c in cells) / max(1, sum(c.n for c in cells))
    threshold, below = 0.0, 0
    for c in sorted(cells, key=lambda c: -c.place):
        below += c.n
        edge = 10 ** (-c.place / GRID)
        if edge * mean <= share * below / total:
            threshold = edge
    return threshold


def joined(pairs: list[tuple[str, Column]]) -> Column:
    """kind:start:end of all spans by start, then kind as listed."""
    def shown(kind: str, column: Column) -> Column:
        return F.transform(column, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["end"].cast("string")).alias("shown")))

    each = [shown(kind, column) for kind, column in pairs]
    return F.array_join(F.transform(F.array_sort(F.concat(*each)), lambda s: s["shown"]), ",")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = FALSE_SHARE) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random.

    Assignments whose value has fewer than six characters are dropped.  Spans of different kinds may overlap, except
    that a random one overlaps none of the others.  A null text counts as empty; repeated rows and null ids are
    scanned row by row.  An empty table gives no rows; other columns are not read.
    """
    found = found_spans(docs, id_col, text_col)
    threshold = text_threshold(found, share)
    found = found.withColumn("random", F.filter("tested", lambda t: t["p"] > threshold))
    base = [(kind, F.col(kind)) for kind in KINDS[:3]]
    count = lambda kind: F.size(kind).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(k) for k in KINDS[:3]], F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined([*base, ("random", F.col("random"))]).alias("spans"), count("random")
    )
