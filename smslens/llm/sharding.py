"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded hash within their source and ranked there; the rank, less a
fixed offset of the source, divided by the source's size is the fractional rank.  Sorting by it deals the sources out evenly, and cutting the order into equal runs gives
shards that all hold the mixture.

No source or shard is sorted as a whole.  Ranks come from counts: rows fall into cells of the shuffle hash whose
number follows the size of the table, so a cell holds a few thousand rows whatever its source's share; running
sums over the counted cells give each cell's first rank, and only the rows of one cell are sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smslens.llm.common import stored, text_or_empty

#: Rows of a cell on average: what one sort holds.
CELL_ROWS = 4_096


def text_size(column: str = "text") -> Column:
    """UTF-8 bytes of the text plus 16; a null has no bytes."""
    return F.octet_length(text_or_empty(column)).cast("long") + 16


def first_ranks(counts: DataFrame, by: list[str], order: str, n: str) -> DataFrame:
    """counts plus `before`: rows in earlier cells of the same `by`.

    The window sees one row per cell of some thousand rows.  Without `by` the cells are summed in two steps, so
    that a single task sees one row per thousand cells.
    """
    if by:
        w = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumn("before", F.coalesce(F.sum(n).over(w), F.lit(0)))
    super_cell = F.floor(F.col(order) / 1000)
    supers = counts.groupBy(super_cell.alias("super")).agg(F.sum(n).alias("super_n"))
    w = Window.orderBy("super").rowsBetween(Window.unboundedPreceding, -1)
    supers = supers.select("super", F.coalesce(F.sum("super_n").over(w), F.lit(0)).alias("super_before"))
    w = Window.partitionBy("super").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    inner = counts.withColumn("super", super_cell).withColumn("inner", F.coalesce(F.sum(n).over(w), F.lit(0)))
    return inner.join(supers, "super").withColumn("before", F.col("inner") + F.col("super_before")).drop("super", "inner", "super_before")


def offset(seed: int) -> Column:
    """Where in its step a source's rows stand, 0 to 1, by a hash: sources of equal size don't fall together."""
    return (F.pmod(F.xxhash64(F.lit(seed), "src"), F.lit(1 << 20)) + 0.5) / (1 << 20)


def interleave_shards(docs: DataFrame, shards: int, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", seed: int = 17) -> DataFrame:
    """One row per document: doc_id, source, size, text_crc32, rank (global), shard, slot.

    Shard sizes in rows differ by one at most, and each source's rows are spread over the shards in proportion.
    A null source is a source of its own; a null text counts as empty; a null id is shuffled by its text alone;
    rows that agree in id, source and text are interchangeable.  Ties in fractional rank go by source, then by
    shuffle hash, id and text checksum.  An empty table gives no rows.  Other columns of docs are not read.
    """
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        text_size(text_col).alias("size"),
        F.crc32(text_or_empty(text_col).cast("binary")).alias("text_crc32"),
    ).withColumn("u", F.xxhash64(F.lit(seed), "doc_id", "text_crc32", "size"))
    rows = stored(rows)
    total = rows.count()
    cells = max(1, -(-total // CELL_ROWS))
    rows = rows.withColumn("src", F.coalesce(F.concat(F.lit("s"), "source"), F.lit(""))).withColumn("cell", F.pmod(F.shiftrightunsigned("u", 16), F.lit(cells)))
    counts = rows.groupBy("src", "cell").agg(F.count("*").alias("n"))
    counts = stored(first_ranks(counts, ["src"], "cell", "n"))
    sizes = counts.groupBy("src").agg(F.sum("n").alias("src_n"))
    ties = ["u", "doc_id", "text_crc32"]
    ranked = (
        rows.withColumn("in_cell", F.row_number().over(Window.partitionBy("src", "cell").orderBy(*ties)))
        .join(counts.join(sizes, "src").select("src", "cell", "before", "src_n"), ["src", "cell"])
        .withColumn("fraction", (F.col("before") + F.col("in_cell") - 1 + offset(seed)) / F.col("src_n"))
        .withColumn("deal", F.least(F.floor(F.col("fraction") * cells), F.lit(cells - 1)))
        .select("doc_id", "source", "src", "size", "text_crc32", "u", "fraction", "deal")
    )
    ranked = stored(ranked)
    starts = first_ranks(ranked.groupBy("deal").agg(F.count("*").alias("n")), [], "deal", "n")
    order = Window.partitionBy("deal").orderBy("fraction", "src", *ties)
    placed = ranked.withColumn("in_deal", F.row_number().over(order)).join(starts.select("deal", "before"), "deal").withColumn("rank", F.col("before") + F.col("in_deal") - 1)
    placed = placed.withColumn("shard", F.expr(f"cast(rank * {shards} div {max(total, 1)} as int)"))
    first = F.expr(f"(cast(shard as bigint) * {max(total, 1)} + {shards - 1}) div {shards}")
    return placed.select("doc_id", "source", "size", "text_crc32", "rank", "shard", (F.col("rank") - first).alias("slot"))


def write_shards(docs: DataFrame, shards: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Write the documents under shard=N folders in slot order; ids have to be unique and not null."""
    placed = docs.join(shards.select(F.col("doc_id").alias(id_col), "shard", "slot"), id_col)
    placed.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
