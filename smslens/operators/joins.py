"""Joins and shares that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

# A broadcast side is at most this many rows, counted before the hint is given.
BROADCAST_ROWS = 500_000
# A key is hot when it holds at least 1/HOT_SHARE of the rows, so there are at most HOT_SHARE hot keys.
HOT_SHARE = 1000


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Whether df has no more than ``rows`` rows.  A plain count: tasks send one number each."""
    return df.count() <= rows


def lookup_join(
    left: DataFrame, right: DataFrame, on: str, how: str = "left", max_rows: int | None = BROADCAST_ROWS, salts: int = 32
) -> DataFrame:
    """Join to a side that is unique on ``on`` (or a filter list, for semi and anti joins).

    With ``max_rows`` the right side is counted and broadcast when it fits; the left
    side then does not move.  Otherwise, or with ``max_rows=None`` (no counting, for a right side that is
    costly to compute twice), both sides are shuffled with the key salted, so the rows of one key spread
    over ``salts`` tasks.  The salt is a hash of the row, so a recomputed task repeats it.
    """
    if max_rows is not None and has_at_most(right, max_rows):
        return left.join(F.broadcast(right), on, how)
    salted = left.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in left.columns]), F.lit(salts)))
    copies = right.withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))))
    return salted.join(copies, [on, "__salt"], how).drop("__salt")


def attach_by_key(left: DataFrame, right: DataFrame, on: list[str], count_col: str) -> DataFrame:
    """Inner join of ``left`` to a ``right`` that is unique on ``on`` and counts left's rows per key.

    Keys with at least 1/HOT_SHARE of the left rows number at most HOT_SHARE, whatever the data; their
    right rows are broadcast and the left rows stay where they are.  All other keys are shuffled.
    Both inputs are read more than once: pass checkpointed or stored tables.
    """
    total = right.agg(F.sum(count_col)).scalar()
    is_hot = F.col(count_col) * F.lit(HOT_SHARE) >= total
    hot, cold = right.where(is_hot), right.where(~is_hot)
    hot_rows = left.join(F.broadcast(hot), on)
    cold_left = left.join(F.broadcast(hot.select(*on)), on, "left_anti")
    return hot_rows.unionByName(cold_left.join(cold, on))


def share_of_total(part: str, total: DataFrame) -> Column:
    """part / the single value of ``total`` (a scalar subquery)."""
    return F.col(part).cast("double") / total.scalar()


def share_of_listed(part: str) -> Column:
    """part / its sum over all rows.  Only for reports with a bounded number of rows (ranges, levels, labels)."""
    return F.col(part).cast("double") / F.sum(part).over(Window.partitionBy())


def facet_row(facet: str, value: Column) -> Column:
    """One (facet, value) entry; arrays of these are expanded with ``inline`` to count several columns in one pass."""
    return F.struct(F.lit(facet).alias("facet"), value.cast("string").alias("value"))
