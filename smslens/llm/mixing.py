"""Mixing sources to target weights: each source fills its budget of words by a subset sum over document lengths.

A source gives whole passes first (its documents once or twice), and what is left of its budget is filled with
some of them.  Documents are counted by exact length; every length gives its proportional share, the longest
lengths fill the rest down to a few ten thousand words (or four longest documents), and these are met by a bounded-knapsack table over the
documents still free.  Which documents of a length are taken is decided by a seeded hash.

A source is never brought together: the table of a source has one row per distinct length, of which words W allow
at most sqrt(2 W), and ranks within a length come from counted hash cells.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smslens.llm.common import stored

#: Share of all words that the mix takes, and how often a document may be taken.
SHARE, PASSES = 1.5, 2
#: Weights of the sources in code point order, repeated.
WEIGHTS = (5, 2, 1)
#: Words that are left to the knapsack table, in all and in longest documents, and its greatest number of cells.
KEPT_WORDS, KEPT_LONGEST, CELLS = 1 << 15, 4, 1 << 22
#: Copies of one row that are expanded at a time.
EXPANDED = 1_000
SEED = 29


def word_count(column: str) -> Column:
    """Number of runs of anything but ASCII white space; a null text has none."""
    marked = F.regexp_replace(F.coalesce(F.col(column), F.lit("")), "[^\\x20\\x09-\\x0D]++", "x")
    return F.length(F.translate(marked, " \t\n\x0b\f\r", "")).cast("long")


def numbered(sources: DataFrame) -> DataFrame:
    """sources with `place`, 0 up, in code point order of `source`, null last; no task sees more than one range."""
    ranged = stored(sources.orderBy(F.asc_nulls_last("source")).withColumn("part", F.spark_partition_id()))
    inner = ranged.withColumn("inner", F.row_number().over(Window.partitionBy("part").orderBy(F.asc_nulls_last("source"))) - 1)
    starts = ranged.groupBy("part").agg(F.count("*").alias("n"))  # one row per partition
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return inner.join(starts.select("part", before.alias("before")), "part").withColumn("place", F.col("before") + F.col("inner")).drop("part", "before", "inner")


def targets(sources: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES) -> DataFrame:
    """(source, source_size) plus `target`: share of all words dealt by weight, none above `passes` times its size.

    What stopped sources leave is dealt again by weight among the others until none is above its bound.  One
    aggregate a round; a round without a newly stopped source ends it.  share may be at most `passes`.
    """
    table = F.array(*[F.lit(float(w)) for w in weights])
    weighed = numbered(sources).withColumn("weight", F.get(table, F.pmod(F.col("place"), F.lit(len(weights))).cast("int")))
    weighed = stored(weighed.withColumn("bound", F.col("source_size") * passes).drop("place"))
    budget = share * (weighed.agg(F.sum("source_size")).first()[0] or 0)
    rate, stopped = 0.0, -1
    while True:
        over = F.col("bound") < F.col("weight") * F.lit(rate) if stopped >= 0 else F.lit(False)
        r = weighed.agg(F.count_if(over).alias("n"), F.sum(F.when(over, F.col("bound"))).alias("bounds"), F.sum(F.when(~over, F.col("weight"))).alias("weights")).first()
        if r.n == stopped:
            break
        stopped, rate = r.n, (budget - (r.bounds or 0)) / r.weights if r.weights else float("inf")
    target = F.when(F.col("bound") < F.col("weight") * F.lit(rate), F.col("bound").cast("double")).otherwise(F.col("weight") * F.lit(rate))
    return weighed.withColumn("target", target).drop("bound")


def knapsack(lengths: np.ndarray, free: np.ndarray, budget: int, most: int) -> dict[int, int]:
    """Copies of each length, at most `free` of it, whose words come as near to the budget as can be, up to `most`.

    The table holds for every sum the length that first reached it and how many of it; a sum's own length is
    later than all that its remainder uses, so walking back gives the copies.  It ends once the budget is met.
    """
    by = np.full(most + 1, -1, np.int64)
    used = np.zeros(most + 1, np.int64)
    reached = np.zeros(most + 1, bool)
    reached[0] = True
    for i, (length, n) in enumerate(zip(lengths.tolist(), free.tolist(), strict=True)):
        if length > most or reached[budget]:
            continue
        front = np.flatnonzero(reached)
        for k in range(1, n + 1):
            front = front[: np.searchsorted(front, most - length, "right")] + length
            front = front[~reached[front]]
            if not len(front):
                break
            by[front], used[front], reached[front] = i, k, True
    sums = np.flatnonzero(reached)
    at = int(sums[np.argmin(np.abs(sums - budget))])
    out: dict[int, int] = {}
    while at:
        length = int(lengths[by[at]])
        out[length] = int(used[at])
        at -= length * int(used[at])
    return out


def fill_budget(length: np.ndarray, n: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take (0 to n) so that their words come to the budget or nearest it."""
    total = sum(a * b for a, b in zip(length.tolist(), n.tolist(), strict=True))
    if budget <= 0 or not total:
        return np.zeros(len(length), np.int64)
    budget = min(budget, total)
    take = np.array([c * budget // total for c in n.tolist()], np.int64)
    take[length == 0] = 0
    left = budget - sum(a * b for a, b in zip(length.tolist(), take.tolist(), strict=True))
    order = np.argsort(-length)
    kept = max(KEPT_WORDS, KEPT_LONGEST * int(length.max()))
    for i in order.tolist():  # the longest first, down to what the table holds
        if length[i] and left > kept:
            more = min(int(n[i] - take[i]), (left - kept) // int(length[i]))
            take[i] += more
            left -= more * int(length[i])
    free = n - take
    open_ = [i for i in order.tolist() if length[i] and free[i]]
    if not left or not open_:
        return take
    over = min(left, int(length[open_[0]]))  # beyond it, taking nothing is nearer
    unit = -(-(left + over) // CELLS)  # above 1 only where documents of over a million words are left
    cells = np.maximum(1, (length[open_] + unit // 2) // unit)
    cells, which = np.unique(cells, return_inverse=True)
    room = np.zeros(len(cells), np.int64)
    np.add.at(room, which, free[open_])
    chosen = knapsack(cells[::-1], room[::-1], -(-left // unit) if unit > 1 else left, (left + over) // unit)
    for j, i in enumerate(open_):
        k = min(int(free[i]), chosen.get(int(cells[which[j]]), 0))
        chosen[int(cells[which[j]])] = chosen.get(int(cells[which[j]]), 0) - k
        take[i] += k
    return take


def length_counts(histogram: DataFrame) -> DataFrame:
    """(source_key, length, n, passes, budget) plus `take`, one source's lengths at a time."""

    def fill(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("length", ignore_index=True)
        g["take"] = fill_budget(g["length"].to_numpy("int64"), g["n"].to_numpy("int64"), int(g["budget"].iloc[0]))
        return g[["source_key", "length", "n", "passes", "take"]]

    return histogram.groupBy("source_key").applyInPandas(fill, "source_key string, length long, n long, passes long, take long")


def mix_sources(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, passes: int = PASSES, seed: int = SEED,
    id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, source, copies.

    size counts words, taken is size times copies (0 to `passes`), and each source's taken words come to its target
    rounded to a word, or the nearest sum its documents allow.  A null text has size 0; a null source is a source of
    its own, the last; an empty source name is the first.  Documents of a source and length are taken in the order
    of a seeded hash of id, source and length, ties by id, nulls first.  Rows that agree in id, source and length
    are interchangeable and are counted, not compared.  Documents without words are taken in whole passes only and
    count nothing.  An empty table gives no rows.  Other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(text_col).alias("length"))
    rows = rows.withColumn("source_key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("")))
    counted = stored(rows.groupBy("source_key", "length", "doc_id").agg(F.count("*").alias("m")))
    lengths = stored(counted.groupBy("source_key", "length").agg(F.sum("m").alias("n")))
    name = F.when(F.col("source_key") != "", F.expr("substring(source_key, 2)"))
    sources = lengths.groupBy("source_key").agg(F.sum(F.col("n") * F.col("length")).alias("source_size")).withColumn("source", name)
    goals = stored(targets(sources, weights, share, passes))

    whole = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(passes))).otherwise(0).cast("long")
    budget = F.when(F.col("passes") < passes, F.round("target").cast("long") - F.col("passes") * F.col("source_size")).otherwise(0)
    asked = goals.select("source_key", "source_size", "target", whole.alias("passes")).withColumn("budget", budget)
    chosen = stored(length_counts(lengths.join(asked, "source_key").select("source_key", "length", "n", "passes", "budget")))

    # sqrt(n) hash cells a length: their running sums and the rows of one cell are both that many
    part = F.pmod(F.xxhash64(F.lit(seed), "doc_id", "source_key", "length"), F.ceil(F.sqrt("n")).cast("long"))
    celled = counted.join(chosen.select("source_key", "length", "n", "passes", "take"), ["source_key", "length"]).withColumn("cell", part)
    celled = stored(celled.select("source_key", "length", "doc_id", "m", "passes", "take", "cell"))
    before = Window.partitionBy("source_key", "length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = celled.groupBy("source_key", "length", "cell").agg(F.sum("m").alias("in_cell"))
    cells = cells.select("source_key", "length", "cell", F.coalesce(F.sum("in_cell").over(before), F.lit(0)).alias("before"))
    order = Window.partitionBy("source_key", "length", "cell").orderBy(F.xxhash64(F.lit(seed + 1), "doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = celled.withColumn("inside", F.coalesce(F.sum("m").over(order), F.lit(0))).join(cells, ["source_key", "length", "cell"])
    extra = F.greatest(F.lit(0), F.least(F.col("m"), F.col("take") - F.col("before") - F.col("inside")))
    placed = placed.select("source_key", "length", "doc_id", "m", "passes", extra.alias("extra"))
    placed = placed.join(goals.select("source_key", "source", "source_size", "target"), "source_key")

    steps = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(m - 1) div {EXPANDED}")))
    runs = placed.withColumn("run", steps)
    copy = F.explode(F.sequence(F.col("run") * EXPANDED, F.least(F.col("m"), (F.col("run") + 1) * EXPANDED) - 1))
    single = runs.withColumn("copy", copy).withColumn("copies", F.col("passes") + (F.col("copy") < F.col("extra")).cast("long"))
    return single.select("doc_id", F.col("length").alias("size"), "source_size", "target", (F.col("length") * F.col("copies")).alias("taken"), "source", "copies")
