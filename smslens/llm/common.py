"""Helpers shared by the training-data operators: tables, shared storage, size-checked joins, text buffers.

Text leaves Spark in Arrow batches.  A batch is cut into blocks of a few megabytes, each a flat byte array with
document offsets, so that numpy works on whole blocks and memory does not follow the batch size.
"""

from __future__ import annotations

import gc
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from smslens.operators.similarity import connected_components
from smslens.session import shared_folder

#: Bytes of text worked on at once; one longer document is a block of its own.
BLOCK_BYTES = 2 << 20
#: Rows and bytes that a joined side may have to be broadcast.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 64 << 20
#: Rows in one Arrow batch: documents may be very long.
ARROW_ROWS = "1000"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of documents small; a session that already asks for fewer rows keeps its value."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= int(ARROW_ROWS):
        spark.conf.set(key, ARROW_ROWS)


def stored(df: DataFrame) -> DataFrame:
    """Write df to the folder all executors share and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def tidy(spark: SparkSession) -> None:
    """Let Spark's cleaner free the shuffle files of steps whose results are stored; it acts when the driver collects
    garbage, which on a busy cluster may not happen before executors' disks are full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def attach(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a narrow table of unique keys to left.

    right should be stored: its rows and bytes are counted first and it is broadcast only up to max_rows rows and
    BROADCAST_BYTES.  Above that both sides are shuffled, and adaptive execution may split a hot key on the left
    because right has one row for it.
    """
    width = F.lit(0).cast("long")
    for name, kind in right.dtypes:
        long = F.size(name) * 8 if kind.startswith("array") else F.octet_length(name) if kind in ("string", "binary") else F.lit(0)
        width += 8 + F.coalesce(long, F.lit(0))
    rows, size = right.agg(F.count("*"), F.coalesce(F.sum(width), F.lit(0))).first()
    fits = rows <= max_rows and size <= BROADCAST_BYTES
    return left.join(F.broadcast(right) if fits else right.hint("shuffle_merge"), keys, how)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def once(df: DataFrame, keep: list[str], **made: Column) -> DataFrame:
    """df's columns `keep` and the made ones, which later steps see as values: a plain projection would be merged
    into the steps that use it, and each use would work it out anew."""
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(name) for name, c in made.items()]))))


def remainder(doc_id: str, modulus: int) -> Column:
    """crc32 of the id's decimal text, modulo; null ids give null."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % modulus


@dataclass
class Block:
    """Consecutive texts of one batch: bytes, offsets (one more than texts) and the rows' place in the batch."""

    data: np.ndarray
    offsets: np.ndarray
    first: int

    @property
    def size(self) -> int:
        return len(self.offsets) - 1


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; a null counts as empty."""
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) and not pa.types.is_large_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, starts, data = column.buffers()
    offsets = np.frombuffer(starts, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8), offsets


def blocks(column: pa.Array, most: int = BLOCK_BYTES) -> Iterator[Block]:
    """The column's texts in blocks of at most `most` bytes, or one text."""
    data, offsets = text_buffers(column)
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield Block(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], i)
        i = j


#: `[\x20\x09-\x0D]`: what separates words.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words(block: Block, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and document numbers of the words of a block, and none that crosses documents; gap: bytes between words."""
    inside = ~gap[block.data]
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    opens = np.zeros(n + 1, bool)
    opens[block.offsets] = True  # a document's first byte begins a word, whatever stands before
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | opens[1:n]
    ends = np.zeros(n, bool)
    ends[:-1] = inside[:-1] & (~inside[1:] | opens[1:n])
    ends[-1] = inside[-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(block.offsets, starts, "right") - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the splitmix finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class RollingHash:
    """Karp-Rabin hashes modulo 2**64 of any spans of a byte block, from running sums.

    The sum over a span is divided by the power at its start (an odd base has an inverse), so that equal spans at
    different places agree.
    """

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.values = rng.integers(1, 1 << 63, 256, dtype=np.uint64)
        self.base = int(rng.integers(1 << 40, 1 << 62)) | 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", self.base), ("down", self.inverse)):
                powers = np.full(size, base, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))

    def sums(self, data: np.ndarray, lut: np.ndarray | None = None) -> np.ndarray:
        """Running sums, one more than bytes; lut maps bytes first."""
        self._grow(len(data) + 1)
        values = self.values if lut is None else self.values[lut]
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values[data] * self.up[: len(data)], out=out[1:])
        return out

    def spans(self, sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((sums[ends] - sums[starts]) * self.down[starts] + (ends - starts).astype(np.uint64))

    def windows(self, values: np.ndarray, length: int) -> np.ndarray:
        """Running hashes of every `length` consecutive values."""
        self._grow(len(values) + 1)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=sums[1:])
        n = max(0, len(values) - length + 1)
        return mixed((sums[length : length + n] - sums[:n]) * self.down[:n])


def shingles(word_hash: np.ndarray, doc: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of `length` consecutive words of a document, and their documents."""
    n = len(word_hash) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = np.zeros(n, np.uint64)
    for k in range(length):
        acc = mixed(acc * np.uint64(0x9E3779B97F4A7C15) + word_hash[k : n + k])
    whole = doc[:n] == doc[length - 1 :]
    return acc[whole], doc[:n][whole]


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """Arrow lists from flat values and one length per list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of undirected links: (node, component), the component being its smallest node; stored.

    Nodes without links are absent; null ends and loops are ignored.  See similarity.connected_components.
    """
    ends = links.select(F.col(a).alias("src"), F.col(b).alias("dst")).where("src <> dst")
    return stored(connected_components(ends).withColumnRenamed("id", "node"))


def group_links(posted: DataFrame, fits, check) -> tuple[DataFrame, DataFrame]:
    """Links and their components among nodes that share a token, without listing all pairs of a token.

    posted: (token, node, x), each token and node once; nodes of one x have the same tokens.  fits(x1, x2) tells from x
    whether two nodes can link at all; check(pairs) returns those of the pairs (a, b), all of which fit, that do link.
    First every node is held against the head of its group, the smallest node of the smallest x; then only pairs of a
    group of three or more that lie in different components are looked at.  The components are those
    of all links, as a link inside a component changes nothing; links has the ones that were needed.
    """
    merged = lambda df: df.hint("shuffle_merge")  # nothing of these sizes passes the driver
    spread = posted.repartition("token")  # shuffled once, for the heads and for their members
    heads = spread.groupBy("token").agg(F.min("x").alias("hx"), F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("n"))
    heads = heads.where("low < high").drop("low", "high")
    shared = stored(spread.join(heads.hint("shuffle_hash"), "token"))
    tidy(posted.sparkSession)
    leads = shared.where("x = hx").groupBy("hx").agg(F.min("node").alias("head"))
    star = shared.where(fits(F.col("x"), F.col("hx"))).select("node", "hx").distinct().join(merged(leads), "hx").where("node <> head")
    star = stored(star.select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b")).distinct())
    shared = shared.where("n > 2").drop("hx", "n")
    links = check(star)
    tidy(posted.sparkSession)
    found = components(links)
    placed = shared.join(merged(found), "node", "left").select("token", "node", "x", F.coalesce("component", "node").alias("component"))
    split = placed.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("token")
    open_ = stored(placed.join(merged(split), "token"))
    other = open_.select("token", *[F.col(c).alias(f"{c}2") for c in ("node", "x", "component")])
    cross = open_.join(merged(other), "token").where((F.col("component") != F.col("component2")) & (F.col("node") < F.col("node2")) & fits(F.col("x"), F.col("x2")))
    cross = cross.select(F.col("node").alias("a"), F.col("node2").alias("b")).distinct().join(merged(star), ["a", "b"], "left_anti")
    cross = stored(cross)
    tidy(posted.sparkSession)
    more = check(cross)
    if not more.isEmpty():
        links = stored(links.unionByName(more))
        found = components(links)
    return links, found
