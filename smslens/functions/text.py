"""Column expressions on message text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Python's str.isspace() also covers U+001C..U+001F, which Java's Unicode \s leaves out.
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def normalize_text(c: Column | str) -> Column:
    """Null becomes '', anything else its text; lower case, outer blanks off, inner runs to one blank."""
    text = F.lower(F.coalesce(_col(c).cast("string"), F.lit("")))
    return F.trim(F.regexp_replace(text, WHITESPACE_RUN, " "))


def unify_spelling(c: Column | str) -> Column:
    """Drop vowel accents and the inner dots of abbreviations (``e.p.s`` -> ``eps``).

    Off by default everywhere: it changes template ids.
    """
    plain = F.translate(_col(c), "áéíóúüÁÉÍÓÚÜ", "aeiouuAEIOUU")
    return F.regexp_replace(plain, r"(?U)(?<=\b\p{L})\.(?=\p{L}\b)", "")


def template_id(c: Column | str) -> Column:
    """First 16 hex digits of the MD5 of the text."""
    return F.substring(F.md5(_col(c)), 1, 16)


def clean_string(c: Column | str) -> Column:
    """Trimmed text, null when empty."""
    return F.nullif(F.trim(_col(c).cast("string")), F.lit(""))


def bucket_label(c: Column | str, ranges) -> Column:
    """Label of the last range whose lower bound is <= c; ranges ascend."""
    c = _col(c)
    out = F.lit(ranges[0][1])
    for low, label in ranges[1:]:
        out = F.when(c >= low, F.lit(label)).otherwise(out)
    return out
