"""Column expressions on ``category::subcategory`` labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from smslens.functions.text import _col
from smslens.functions.vocabulary import MESSAGE_TYPES, OTHER_MESSAGE_TYPE


def label_category(c: Column | str) -> Column:
    return F.split(_col(c), "::").getItem(0)


def label_subcategory(c: Column | str) -> Column:
    """Second part of the label; '' when there is no separator."""
    c = _col(c)
    return F.when(c.contains("::"), F.split(c, "::").getItem(1)).when(c.isNotNull(), F.lit(""))


def message_type(subcategory: Column | str) -> Column:
    subcategory = _col(subcategory)
    out = F
    for name, members in MESSAGE_TYPES.items():
        out = out.when(subcategory.isin(*members), F.lit(name))
    return out.otherwise(F.lit(OTHER_MESSAGE_TYPE))
