"""Removal of repeated byte strings over the whole corpus, by prefix-free parsing.

A rolling hash of eight bytes triggers phrase borders: of every run of 69 places the smallest hash is a trigger.
So each 100-byte string holds a trigger that its own bytes decide, equal strings hold it at the same place, and the
strings of a document fall into ranges with one trigger each.  A range's phrase is what any string with its trigger
holds, the 32 bytes from there; its context is all bytes that the range's own strings touch.

The dictionary holds each distinct context once, at its earliest occurrence; the parse is the list of occurrences.
Sorted by phrase, context and place, an occurrence after the first of its context repeats in full.  A phrase with
several contexts can still hide equal strings: the dictionary's entries for it are cut into shorter ranges, at fixed
distances from the trigger and with longer phrases, which are sorted in the same way, down to single strings.  Phrases that one context has are settled at once, which is
nearly all of them.  Phrases and contexts are compared by two independent 64-bit Karp-Rabin hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smslens.llm.common import Block, RollingHash, attach, blocks, mixed, stored, text_or_empty, tidy

#: Bytes of a string, of the hash that triggers, and places that share a trigger at least.
LENGTH, GRAM, REACH = 100, 8, 69
#: Strings of a range at each level of cutting.
CUTS = (8, 1)
#: A range is one number: its first string's place, its further strings, and how far the last one starts before the
#: trigger.
MORE_BITS, OFF_BITS = 7, 7
ONE, TWO = RollingHash(81), RollingHash(82)


def packed(first: np.ndarray, more: np.ndarray, off: np.ndarray) -> np.ndarray:
    return (first.astype(np.int64) << MORE_BITS | more) << OFF_BITS | off


def unpacked(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    off, more = x & ((1 << OFF_BITS) - 1), x >> OFF_BITS & ((1 << MORE_BITS) - 1)
    return x >> (OFF_BITS + MORE_BITS), more, off


def row_key() -> Column:
    """Tells rows of one id apart; all rows without an id share one, so this has to hold over a whole table."""
    return F.xxhash64("text").alias("row")


def trigger_ranges(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First strings, further strings, distances of the last ones to the trigger, and documents of a block's ranges."""
    data, size = block.data, np.diff(block.offsets)
    n = len(data) - LENGTH + 1
    whole = np.flatnonzero(size >= LENGTH)
    if n <= 0 or not len(whole):
        return (np.zeros(0, np.int64),) * 4
    gram = data.astype(np.uint64)
    for step in (1, 2, 4):  # bytes to pairs, to fours, to eights
        gram = gram[:-step] | (gram[step:] << np.uint64(8 * step))
    key = gram * np.uint64(0x9E3779B97F4A7C15)
    key ^= key >> np.uint64(29)
    key *= np.uint64(0xBF58476D1CE4E5B9)
    bits = np.uint64(max(24, len(key).bit_length()))
    low = (key >> bits << bits) | np.arange(len(key), dtype=np.uint64)
    span = 1
    while 2 * span <= REACH:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    low = np.minimum(low[: len(low) - (REACH - span)], low[REACH - span :])[:n]
    inside = np.zeros(n + 1, np.int8)
    np.add.at(inside, block.offsets[whole], 1)
    np.add.at(inside, block.offsets[whole + 1] - LENGTH + 1, -1)
    inside = np.cumsum(inside[:n]) > 0
    place = np.flatnonzero(inside)
    of = np.searchsorted(block.offsets, place, "right") - 1
    new = np.r_[True, (low[place][1:] != low[place][:-1]) | (of[1:] != of[:-1])]
    at = np.flatnonzero(new)
    first, more = place[at], np.diff(np.r_[at, len(place)]) - 1
    trigger = (low[first] & np.uint64((1 << int(bits)) - 1)).astype(np.int64)
    return first, more, trigger - first - more, of[at]


def range_rows(block: Block, first: np.ndarray, more: np.ndarray, off: np.ndarray, strings: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the phrases and of the contexts of ranges that were cut at every `strings` places before the trigger."""
    one, two = ONE.sums(block.data), TWO.sums(block.data)
    start = first + more + off % strings
    phrase = ONE.spans(one, start, start + LENGTH - strings + 1)
    context = TWO.spans(two, first, first + more + LENGTH)
    return phrase.view(np.int64), mixed(context + off.astype(np.uint64)).view(np.int64)


ROWS = "phrase long, context long, doc_id long, range long, row long"


def emitted(block: Block, ranges: tuple[np.ndarray, ...], strings: int, ids: pa.Array, row: np.ndarray) -> pa.RecordBatch:
    first, more, off, doc = ranges
    phrase, context = range_rows(block, first, more, off, strings)
    where = packed(first - block.offsets[doc], more, off)
    return pa.RecordBatch.from_arrays([pa.array(phrase), pa.array(context), ids.take(pa.array(doc)), pa.array(where), pa.array(row[doc])], ["phrase", "context", "doc_id", "range", "row"])


def parsed(docs: DataFrame) -> DataFrame:
    """The parse: a row for each range of docs (doc_id, row, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2)):
                part = slice(block.first, block.first + block.size)
                yield emitted(block, trigger_ranges(block), REACH, batch.column(0)[part], batch.column(1).to_numpy()[part])

    return docs.select("doc_id", "row", "text").mapInArrow(run, ROWS)


def cut_ranges(docs: DataFrame, ranges: DataFrame, strings: int) -> DataFrame:
    """The parse of ranges (doc_id, range, row), each cut into pieces of so many strings."""
    listed = stored(ranges.groupBy("doc_id", "row").agg(F.collect_set("range").alias("ranges")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            for block in blocks(batch.column(2)):
                part = slice(block.first, block.first + block.size)
                mine = lists[part]
                first, more, off = unpacked(mine.flatten().to_numpy())
                doc = np.repeat(np.arange(block.size), mine.value_lengths().to_numpy())
                pieces = (off + more) // strings - off // strings + 1
                cell = np.repeat(off // strings, pieces) + np.arange(int(pieces.sum())) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                near = np.maximum(np.repeat(off, pieces), cell * strings)
                far = np.minimum(np.repeat(off + more, pieces), cell * strings + strings - 1)
                doc = np.repeat(doc, pieces)
                first = np.repeat(first + more + off, pieces) - far + block.offsets[doc]
                yield emitted(block, (first, far - near, near, doc), strings, batch.column(0)[part], batch.column(1).to_numpy()[part])

    return attach(docs, listed, ["doc_id", "row"], "inner").select("doc_id", "row", "text", "ranges").mapInArrow(run, ROWS)


def sorted_out(parse: DataFrame) -> DataFrame:
    """(doc_id, range, row, repeated): ranges that repeat in full, and dictionary entries whose phrase has other contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # phrase, context, doc, range, row of the last row; its entry if that still waits; whether the phrase has two contexts
        for batch in batches:
            if not batch.num_rows:
                continue
            phrase, context, doc, where, row = [c.to_numpy() for c in batch.columns]
            before = lambda x, k: np.r_[x[0] if last is None else last[k], x[:-1]]
            new_phrase = before(phrase, 0) != phrase
            new = new_phrase | (before(context, 1) != context)
            if last is None:
                new_phrase[0] = new[0] = True
            at = np.flatnonzero(new)  # dictionary entries
            group = np.cumsum(new) - 1
            head_doc = np.r_[0 if last is None else last[2], doc[at]][group + 1]
            head_where = np.r_[0 if last is None else last[3], where[at]][group + 1]
            head_row = np.r_[0 if last is None else last[4], row[at]][group + 1]
            again = ~new & ((head_doc != doc) | (head_where != where) | (head_row != row))  # not the same row once more
            # an entry is checked if a neighbour entry has the same phrase
            follows = ~new_phrase[at]
            leads = np.r_[follows[1:], False] if len(at) else follows
            out_doc, out_where, out_row, repeated = [doc[again]], [where[again]], [row[again]], [np.ones(int(again.sum()), bool)]
            waiting = last is not None and len(at) and follows[0] and not last[5]
            checked = at[follows | leads]
            out_doc.append(doc[checked])
            out_where.append(where[checked])
            out_row.append(row[checked])
            repeated.append(np.zeros(len(checked), bool))
            if waiting:
                out_doc.append(np.array([last[2]]))
                out_where.append(np.array([last[3]]))
                out_row.append(np.array([last[4]]))
                repeated.append(np.zeros(1, bool))
            if len(at):
                last = (phrase[-1], context[-1], doc[at[-1]], where[at[-1]], row[at[-1]], bool(follows[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(out_doc)), pa.array(np.concatenate(out_where)), pa.array(np.concatenate(out_row)), pa.array(np.concatenate(repeated))], ["doc_id", "range", "row", "repeated"])

    dealt = parse.repartition("phrase").sortWithinPartitions("phrase", "context", "doc_id", "range", "row")
    return dealt.mapInArrow(run, "doc_id long, range long, row long, repeated boolean")


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, range, row) of all strings of docs (doc_id, row, text) that also start earlier."""
    found = stored(sorted_out(parsed(docs)))
    tidy(docs.sparkSession)
    out = found.where("repeated").select("doc_id", "range", "row")
    for strings in CUTS:
        found = stored(sorted_out(cut_ranges(docs, found.where("not repeated"), strings)))
        tidy(docs.sparkSession)
        out = out.unionByName(found.where("repeated").select("doc_id", "range", "row"))
    return out


NO_ID = (1 << 63) - 1


def strip_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the kept bytes if asked for.

    A byte is removed if a 100-byte string over it also starts earlier, in a row with a smaller id or before it in
    the same row; strings are judged on the input.  A null text counts as empty; texts of fewer than 100 bytes lose
    nothing.  Absent ids come last, in one place.  Rows that agree in id and text count as one and get the same
    result; rows that share an id but not the text are ordered by the place in their texts.  An empty table gives no
    rows; other columns are not read.
    """
    base = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), text_or_empty(text_col).alias("text")).select("doc_id", row_key(), "text")
    ranges = repeated_ranges(base)
    listed = stored(ranges.groupBy("doc_id", "row").agg(F.collect_set("range").alias("ranges")))
    tidy(docs.sparkSession)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if with_text else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, ranges in zip(batch.column(1), batch.column(2), strict=True):
                data, spans, removed, kept, at = text.as_buffer().to_pybytes(), 0, 0, [], 0
                if ranges.is_valid:
                    first, more, _ = unpacked(np.sort(ranges.values.to_numpy()))
                    end = np.maximum.accumulate(first + more + LENGTH)
                    opens = np.flatnonzero(np.r_[True, first[1:] > end[:-1]])
                    for a, b in zip(first[opens].tolist(), end[np.r_[opens[1:] - 1, len(end) - 1]].tolist(), strict=True):
                        kept.append(data[at:a])
                        at, spans, removed = b, spans + 1, removed + b - a
                rest = b"".join([*kept, data[at:]])
                out.append((len(data), removed, spans, hashlib.sha256(rest).hexdigest(), rest))
            columns = list(zip(*out, strict=True))[: 5 if with_text else 4] if out else [[]] * (5 if with_text else 4)
            kinds = [pa.int64()] * 3 + [pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=False)]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 1 + len(columns)])

    joined = base.join(listed, ["doc_id", "row"], "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(run, schema).withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
