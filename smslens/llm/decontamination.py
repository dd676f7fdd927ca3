"""Benchmark decontamination by greedy string tiling.

Texts are sequences of words (letters and digits, lower case).  Running Karp-Rabin hashes of five words find the
seeds that a document shares with a test item; seeds in a row on one diagonal are a match.  The longest match whose
words are unmarked on both sides becomes a tile and marks them, and so on until no match of five words is left.
A document is contaminated by an item whose words its tiles cover to at least half, in whatever order they stand.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smslens.llm.common import Block, RollingHash, attach, blocks, stored, words

#: Words of the shortest tile; items of fewer words are not searched.
TILE = 5
COVERAGE = 0.5
#: Bytes of item texts up to which every task gets the index; beyond, documents and items meet by a shuffle.
INDEX_BYTES = 8 << 20
HASH, RUNNING = RollingHash(6), RollingHash(66)

GAP = np.ones(256, bool)
GAP[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False


def word_hashes(column: pa.Array) -> Iterator[tuple[Block, np.ndarray, np.ndarray]]:
    """Blocks of lower-cased texts with the hashes of their words and the words' documents."""
    for block in blocks(pc.utf8_lower(column)):
        starts, ends, doc = words(block, GAP)
        yield block, HASH.spans(HASH.sums(block.data), starts, ends), doc


def seeds(hashes: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running hashes of TILE words that lie in one document, and where they begin."""
    found = RUNNING.windows(hashes, TILE)
    at = np.flatnonzero(doc[: len(found)] == doc[TILE - 1 :]) if len(found) else np.zeros(0, np.int64)
    return found[at], at


class Items:
    """The test items' seeds, sorted by hash, with their item and place."""

    def __init__(self, item_ids: list, texts: list[str | None]):
        self.item_ids, sizes, hashes, owner, place = item_ids, [], [], [], []
        for block, hashed, doc in word_hashes(pa.array(texts, pa.string())):
            found, at = seeds(hashed, doc)
            first = np.searchsorted(doc, np.arange(block.size))
            sizes.append(np.bincount(doc, minlength=block.size))
            hashes.append(found)
            owner.append(doc[at] + block.first)
            place.append(at - first[doc[at]])
        join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
        self.sizes, hashes = join(sizes, np.int64), join(hashes, np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.owner, self.place = hashes[order], join(owner, np.int64)[order], join(place, np.int64)[order]

    def matches(self, hashes: np.ndarray, doc: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """(document, item, tiles, covered words) of every pair that shares a seed."""
        found, at = seeds(hashes, doc)
        low, high = np.searchsorted(self.hashes, found, "left"), np.searchsorted(self.hashes, found, "right")
        hit = np.flatnonzero(high > low)
        many = (high - low)[hit]
        entry = np.repeat(low[hit] - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        position, item = np.repeat(at[hit], many), self.owner[entry]
        order = np.lexsort((item, doc[position]))
        position, item, place = position[order], item[order], self.place[entry][order]
        of = doc[position]
        cuts = np.flatnonzero(np.r_[True, (item[1:] != item[:-1]) | (of[1:] != of[:-1])]) if len(of) else np.zeros(0, np.int64)
        for a, b in zip(cuts, np.r_[cuts[1:], len(of)][: len(cuts)], strict=True):
            tiles = tile(position[a:b], place[a:b])
            yield int(of[a]), int(item[a]), len(tiles), sum(n for _, _, n in tiles)


def tile(x: np.ndarray, y: np.ndarray) -> list[tuple[int, int, int]]:
    """Tiles (place in x, place in y, words) from shared seeds (x, y): longest first, then leftmost, without overlap."""
    order = np.lexsort((x, x - y))
    x, y = x[order], y[order]
    cut = np.flatnonzero(np.r_[True, (np.diff(x) != 1) | (np.diff(y) != 1)])
    heap = [(-int(n + TILE - 1), int(a), int(b)) for a, b, n in zip(x[cut], y[cut], np.diff(np.r_[cut, len(x)]), strict=True)]
    heapq.heapify(heap)
    marked_x, marked_y, tiles = set(), set(), []
    while heap:
        n, a, b = heapq.heappop(heap)
        free = [a + k not in marked_x and b + k not in marked_y for k in range(-n)]
        if all(free):
            tiles.append((a, b, -n))
            marked_x.update(range(a, a - n))
            marked_y.update(range(b, b - n))
            continue
        run = 0
        for k, ok in enumerate([*free, False]):  # what is left of the match goes back, if it is long enough
            if not ok and run >= TILE:
                heapq.heappush(heap, (-run, a + k - run, b + k - run))
            run = run + 1 if ok else 0
    return tiles


def fitting_items(benchmark: DataFrame, most: int) -> Items | None:
    """The index, if the items' texts are within `most` bytes."""
    used = benchmark.select("item_id", "text").where("text is not null")
    size = used.agg(F.coalesce(F.sum(F.octet_length("text") + 32), F.lit(0))).first()[0]
    if size > most:
        return None
    rows = sorted(used.collect(), key=lambda r: (r.item_id is None, r.item_id or 0, r.text))
    return Items([r.item_id for r in rows], [r.text for r in rows])


SCHEMA = "item_id long, tiles int, covered int, item_words int"
NAMES = ["item_id", "tiles", "covered", "item_words"]


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """One row per document and item that contaminates it: doc_id, item_id, tiles, covered, item_words, coverage.

    Null and empty texts contaminate nothing and are not contaminated.  Rows with a repeated or null id are judged
    one by one.  An empty table on either side gives no rows; other columns are not read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    items = fitting_items(benchmark, index_bytes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, hashed, doc in word_hashes(batch.column(1)):
                found = [(block.first + d, i, t, c) for d, i, t, c in items.matches(hashed, doc) if c >= coverage * items.sizes[i]]
                if found:
                    d, i, t, c = zip(*found, strict=True)
                    out = [pa.array([items.item_ids[k] for k in i], pa.int64()), pa.array(t, pa.int32()), pa.array(c, pa.int32()), pa.array(items.sizes[list(i)], pa.int32())]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(d)), *out], ["doc_id", *NAMES])

    if items is not None:
        found = rows.mapInArrow(run, f"doc_id long, {SCHEMA}")
    else:
        keyed = rows.select("doc_id", "text", *text_keys())
        found = keyed.drop("text").join(shuffled_matches(keyed.drop("doc_id"), benchmark, coverage), ["k1", "k2"]).drop("k1", "k2")
    return found.withColumn("coverage", F.col("covered") / F.col("item_words"))


def text_keys(column: str = "text") -> list[Column]:
    """Two hashes that stand for a text: what an item covers depends on the text alone."""
    return [F.xxhash64(column).alias("k1"), F.xxhash64(F.lit("b"), column).alias("k2")]


def shuffled_matches(texts: DataFrame, benchmark: DataFrame, coverage: float) -> DataFrame:
    """(k1, k2, item_id, tiles, covered, item_words) for items of any number: texts (k1, k2, text) and items meet on
    shared seeds, then each pair is tiled.  Repeated texts are tiled once."""

    def seed_rows(df: DataFrame, keys: list[str]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for block, hashed, doc in word_hashes(batch.column(len(keys))):
                    found, at = seeds(hashed, doc)
                    row = pa.array(doc[at] + block.first)
                    yield pa.RecordBatch.from_arrays([*[batch.column(k).take(row) for k in range(len(keys))], pa.array(found.view(np.int64))], [*keys, "seed"])

        return df.select(*keys, "text").mapInArrow(run, ", ".join([*[f"{k} long" for k in keys], "seed long"])).distinct()

    texts = texts.where("text is not null")
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").withColumn("item", F.xxhash64("item_id", "text"))
    pairs = stored(seed_rows(texts, ["k1", "k2"]).join(seed_rows(items, ["item"]), "seed").select("k1", "k2", "item").distinct())
    first = texts.join(pairs.select("k1", "k2").distinct(), ["k1", "k2"], "left_semi").dropDuplicates(["k1", "k2"])
    both = first.join(pairs, ["k1", "k2"]).join(items.withColumnRenamed("text", "item_text"), "item").select("k1", "k2", "text", "item_id", "item_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = Items([batch.column(3)[k].as_py()], [batch.column(4)[k].as_py()])
                for _, hashed, doc in word_hashes(batch.column(2).slice(k, 1)):
                    for _, _, t, c in one.matches(hashed, doc):
                        if c >= coverage * one.sizes[0]:
                            values = [batch.column(0)[k].as_py(), batch.column(1)[k].as_py(), one.item_ids[0], t, c, int(one.sizes[0])]
                            yield pa.RecordBatch.from_pylist([dict(zip(["k1", "k2", *NAMES], values, strict=True))], pa.schema([*[(n, pa.int64()) for n in ("k1", "k2", "item_id")], *[(n, pa.int32()) for n in NAMES[1:]]]))

    return both.mapInArrow(run, f"k1 long, k2 long, {SCHEMA}")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """The documents that no item contaminates, with all their columns, whatever their names.

    Each row is judged by its own text: a null or repeated id changes nothing, and repeated rows go or stay together.  Null
    and empty texts stay.  Without documents or items all rows stay.  The index's size decides how texts and items
    meet, not what goes.
    """
    items = fitting_items(benchmark, index_bytes)
    if items is None:
        keys = dict(zip(("__contaminated_1", "__contaminated_2"), text_keys(), strict=True))
        found = shuffled_matches(docs.select(*text_keys(), "text"), benchmark, coverage)
        gone = stored(found.select(F.col("k1").alias("__contaminated_1"), F.col("k2").alias("__contaminated_2")).distinct())
        return attach(docs.withColumns(keys), gone, list(keys), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            clean = np.ones(batch.num_rows, bool)
            for block, hashed, doc in word_hashes(batch.column(at)):
                for d, i, _, c in items.matches(hashed, doc):
                    if c >= coverage * items.sizes[i]:
                        clean[block.first + d] = False
            yield batch.filter(pa.array(clean))

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))
