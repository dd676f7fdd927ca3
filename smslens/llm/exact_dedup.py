"""Exact deduplication by Grace hashing.

Records are dealt into buckets by digits of a content hash.  A bucket whose bytes exceed the limit is dealt again
by the next digits, level after level, until it fits; the shuffle's files are the spill files, so no bucket waits
in memory.  A bucket that fits is read into an open-addressing table which compares complete contents.

Two kinds of bucket need no further splitting by hash.  A hash that one record has is settled where it is read:
its content is not moved.  A single hash value whose records exceed the limit (many copies of one text) cannot
be split by digits; its records are dealt at random, each part keeps one record per content, and the kept ones
are deduplicated again as records of their own.  A part gets some eight records at least, however long they are, so
that each round leaves an eighth of the copies of a text: a table never holds more than the limit or a few texts.

The hash is one of the text's SHA-256, so that nobody can make many texts of one hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smslens.llm.common import attach, stored, text_or_empty

#: Bytes of one bucket: what a table holds, contents and so many bytes for each record besides.
BUCKET_BYTES, RECORD_BYTES = 16 << 20, 256
#: Bits of the hash used by each level.
DIGIT_BITS = 6
#: Records of one hash that meet in a table, whatever their length.
TOGETHER = 8
SPACES = " \t\n\u000b\f\r"


class OpenTable:
    """Open addressing with linear probing; a slot refers to a distinct content, found by hash and then by bytes."""

    def __init__(self, expected: int):
        self.mask = (1 << max(4, (2 * expected).bit_length())) - 1
        self.slots = np.full(self.mask + 1, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []

    def number(self, hashed: int, content: bytes) -> int:
        """Number of the content, a new one if it was not there."""
        at = hashed & self.mask
        while (k := self.slots[at]) >= 0:
            if self.hashes[k] == hashed and self.contents[k] == content:
                return int(k)
            at = (at + 1) & self.mask
        self.slots[at] = len(self.contents)
        self.hashes.append(hashed)
        self.contents.append(content)
        return len(self.contents) - 1


def table_pass(pdf: pd.DataFrame) -> pd.DataFrame:
    """One bucket: each record with the best record of its content and the content's weight here.

    Best is the longest, then the smallest id (an absent one last), then the smallest row key.  Where the bucket is
    one part of a split hash, kept records carry their content on to the next round.
    """
    table = OpenTable(len(pdf))
    number = np.fromiter((table.number(h, c) for h, c in zip(pdf["h"].tolist(), pdf["content"].tolist(), strict=True)), np.int64, len(pdf))
    ranked = pdf.assign(number=number, absent=pdf["doc_id"].isna()).sort_values(["number", "length", "absent", "doc_id", "row"], ascending=[True, False, True, True, True])
    best = ranked.drop_duplicates("number")  # in the order of their numbers
    keep, weight = best["row"].to_numpy()[number], np.bincount(number, pdf["weight"].to_numpy(), len(best)).astype("int64")[number]
    onward = (pdf["parts"] > 1) & (pdf["row"] == keep)
    return pd.DataFrame({
        "row": pdf["row"], "doc_id": pdf["doc_id"], "h": pdf["h"], "length": pdf["length"], "keep_row": keep, "keep_id": best["doc_id"].array[number], "weight": weight, "content": pdf["content"].where(onward, None)
    })


SETTLED = "row string, doc_id long, h long, length long, keep_row string, keep_id long, weight long, content binary"


def bucket_plan(sizes: DataFrame, limit: int, together: int = TOGETHER) -> DataFrame:
    """(h, bucket, parts) of sizes (h, n, bytes): digits of h are added until a bucket fits or holds one hash value.

    A hash value above the limit gets parts of the limit's size, but none of fewer than `together` records on average.
    """
    digit = lambda level: F.shiftrightunsigned("h", level * DIGIT_BITS).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).cast("string")
    open_, done = sizes.select("h", "n", "bytes", digit(0).alias("bucket")), None
    for level in range(1, 11):
        totals = open_.groupBy("bucket").agg(F.sum("bytes").alias("total"), F.count("*").alias("hashes"))
        over = totals.where((F.col("total") > limit) & (F.col("hashes") > 1)).select("bucket", F.lit(True).alias("over"))
        marked = stored(open_.join(over, "bucket", "left"))
        fits = marked.where("over is null").drop("over")
        done = fits if done is None else done.unionByName(fits)
        open_ = marked.where("over").select("h", "n", "bytes", F.concat("bucket", F.lit("."), digit(level)).alias("bucket"))
        if marked.where("over").isEmpty():
            break
    parts = F.least(F.ceil(F.col("bytes") / limit), F.ceil(F.col("n") / together)).cast("int")
    return stored(done.unionByName(open_).select("h", "bucket", parts.alias("parts")))


def settle(records: DataFrame, sizes: DataFrame, limit: int, together: int = TOGETHER) -> DataFrame:
    """Records (row, doc_id, h, length, weight, content) with keep_row, keep_id and weight of their content."""
    plan = bucket_plan(sizes, limit, together)
    dealt = attach(records, plan, ["h"], "inner").withColumn("part", F.pmod(F.xxhash64("row"), F.greatest("parts", F.lit(1))))
    out = stored(dealt.groupBy("bucket", "part").applyInPandas(table_pass, SETTLED))
    kept = out.where("content is not null").select("row", "doc_id", "h", "length", "weight", "content")
    if plan.where("parts > 1").isEmpty():
        return out
    sizes = stored(kept.groupBy("h").agg(F.count("*").alias("n"), F.sum(F.octet_length("content") + RECORD_BYTES).alias("bytes")))
    before = out.join(plan.where("parts > 1"), "h", "left_semi").count()
    shrunk = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] < before
    # nothing found: a hash has many contents, twice as many records meet in the next round
    upper = settle(kept, sizes, limit, together if shrunk else 2 * together)
    upper = stored(upper.select(F.col("row").alias("keep_row"), F.col("keep_row").alias("top"), F.col("keep_id").alias("top_id"), F.col("weight").alias("top_weight")))
    merged = attach(out, upper, ["keep_row"])
    merged = merged.withColumn("keep_id", F.when(F.col("top").isNull(), F.col("keep_id")).otherwise(F.col("top_id")))
    merged = merged.withColumn("weight", F.coalesce("top_weight", "weight")).withColumn("keep_row", F.coalesce("top", "keep_row"))
    return stored(merged.select("row", "doc_id", "h", "length", "keep_row", "keep_id", "weight", "content"))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = BUCKET_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when they agree without the characters `[\\x20\\x09-\\x0D]`; a null text counts as empty, and
    empty texts form a group.  Of a group the row with the most code points in its original text stays, then the
    smallest id; a row without id stays only where no other row is as long.  Of rows that agree in id and text one
    stays and the others count as its copies.  An empty table gives no rows; other columns are not read.
    """
    text = text_or_empty(text_col)
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("original"), F.translate(text, SPACES, "").alias("normal"))
    base = base.withColumn("text_sha256", F.sha2(F.col("normal").cast("binary"), 256))
    base = base.withColumn("h", F.xxhash64("text_sha256")).withColumn("length", F.char_length("original").cast("long"))
    key = [F.hex(F.xxhash64(F.lit(i), "doc_id", F.col("doc_id").isNull(), "original")) for i in (1, 2)]
    base = base.withColumn("row", F.concat(*key))
    narrow = base.select("row", "doc_id", "h", "length", (F.octet_length("normal").cast("long") + RECORD_BYTES).alias("bytes"), "text_sha256")
    # identical rows are one record with a weight
    narrow = stored(narrow.groupBy("row", "doc_id", "h", "length", "bytes", "text_sha256").agg(F.count("*").alias("copies")))
    sizes = stored(narrow.groupBy("h").agg(F.count("*").alias("n"), F.sum("bytes").alias("bytes")).where("n > 1"))
    # identical rows cannot be dealt apart: they are added up before they are dealt
    several = attach(base, sizes.select("h"), ["h"], "left_semi")
    records = several.groupBy("row", "doc_id", "h", "length", F.col("normal").cast("binary").alias("content")).agg(F.count("*").alias("weight"))
    settled = settle(records, sizes, limit)
    best = stored(settled.select("row", "keep_row", "keep_id", F.col("weight").alias("group_size")).dropDuplicates(["row"]))
    joined = narrow.join(best, "row", "left").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    alone = F.col("keep_row").isNull()
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(alone, F.col("copies")).otherwise(F.col("group_size")).alias("group_size"),
        ((alone | (F.col("row") == F.col("keep_row"))) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents that stay, with all their columns; ids have to be unique and not null."""
    stays = exact_groups(docs, id_col, text_col).where("kept").select(F.col("doc_id").alias(id_col))
    return docs.join(stays, id_col, "left_semi")
