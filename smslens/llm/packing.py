"""Packing documents into token windows by lexical retrieval.

Texts are tokenised once, whole.  Shards are lexical: a document is signed with a few of its rare terms, each the
smallest of its terms under one weighted random order (min-hash, a term's chance grows with its rarity), the table is
sorted by signature over all tasks, and consecutive documents form a shard.  So documents that share rare terms meet at
any size of the table, a term that too many share is split by the next ones, and terms with few documents fill up
a shard together.

Each shard has its own BM25 inverted index over token ids, weighted by document frequencies of the whole table.  A
seed document opens a window; its index scores all its terms and returns the unused neighbours by score, and they
fill the window greedily.  The best one that does not fit is cut there, and what is left of it seeds the next
window, so only a shard's last window is padded.  What fills whole windows of a long document stands alone and is
not indexed.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smslens.llm.alignment import ranges
from smslens.llm.common import LOWER, Block, RollingHash, blocks, stored, words

WINDOW = 2048
#: Most documents of a shard, and most ids (a longer document is a shard of its own).
SHARD_ROWS, SHARD_IDS = 1_000, 4 << 20
#: Terms of a signature.
SIGNED = 4
#: Best neighbours that are tried before the seed's scores are looked at again.
NEIGHBOURS = 48
K1, B = 1.2, 0.75
#: Words whose ids a worker keeps, and words of one letter run that are encoded as one string.
KEPT_WORDS, RUN_WORDS = 400_000, 256
HASH = RollingHash(3)
TOKENIZERS: dict[str, WordIds] = {}


class WordIds:
    """A tokenizer and the ids of words seen before: word k has ids[begin[k] : begin[k + 1]]."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        if len(vocabulary) > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        self.closes = np.zeros(1 << 16, bool)  # ids that end a run of letters
        self.closes[[i for name, i in vocabulary.items() if name.endswith("</w>")]] = True
        self.clear()

    def clear(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids, self.begin = [np.zeros(0, np.int64)], [np.zeros(1, np.int64)]

    def encoded(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and their counts."""
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        counts = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), np.int64, int(counts.sum())), counts

    def learn(self, new: list[bytes]) -> None:
        """Words of letters alone end in one closing id each, so many are encoded as one string and told apart by it.
        A run in which that does not hold, and words with other characters, are encoded word by word."""
        texts = [w.decode() for w in new]
        plain = [k for k, t in enumerate(texts) if t.isalpha()]
        other = [k for k, t in enumerate(texts) if not t.isalpha()]
        runs = [plain[k : k + RUN_WORDS] for k in range(0, len(plain), RUN_WORDS)]
        ids, counts = self.encoded([" ".join([texts[k] for k in run]) for run in runs])
        parts, order, size, at = [], [], [], 0
        for run, n in zip(runs, counts.tolist(), strict=True):
            mine, at = ids[at : at + n], at + n
            last = np.flatnonzero(self.closes[mine])
            if len(last) == len(run) and last[-1] == n - 1:
                parts.append(mine)
                order += run
                size.append(np.diff(last, prepend=-1))
            else:
                other += run
        ids, counts = self.encoded([texts[k] for k in other])
        begin, first = self.begin[-1][-1], sum(map(len, self.begin)) - 1
        self.ids += [*parts, ids]
        self.begin.append(begin + np.cumsum(np.concatenate([*size, counts])))
        self.number.update(zip([new[k] for k in order + other], range(first, first + len(new)), strict=True))

    def look_up(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All kept ids, and where each of the words begins and ends there."""
        new = [w for w in words if w not in self.number]
        if len(self.number) + len(new) > KEPT_WORDS:
            self.clear()
            new = words
        if new:
            self.learn(new)
        self.ids, self.begin = [np.concatenate(self.ids)], [np.concatenate(self.begin)]
        which = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        return self.ids[0], self.begin[0][which], self.begin[0][which + 1]


def tokenizer(path: str) -> WordIds:
    """The worker's tokenizer."""
    if path not in TOKENIZERS:
        TOKENIZERS[path] = WordIds(path)
    return TOKENIZERS[path]


#: Marks that are split off a word's end, where a letter or digit stands before: there the tokenizer splits too.
MARK = np.zeros(256, bool)
MARK[[ord(c) for c in ".,;:!?*$&#%"]] = True
ALNUM = np.zeros(256, bool)
ALNUM[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def pieces_of_words(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, starts, ends and documents of words without their closing marks, and of the marks.

    A word's first ASCII letter is lower-cased, as the tokenizer would, unless a character that could join it
    follows; both make more words alike.
    """
    starts, ends, doc = words(block)
    if not len(starts):
        return block.data, starts, ends, doc
    lower = block.data.copy()
    first = starts[(ends - starts == 1) | (lower[np.minimum(starts + 1, len(lower) - 1)] < 128)]
    lower[first] = LOWER[lower[first]]
    body = np.maximum.accumulate(np.where(MARK[lower], -1, np.arange(len(lower))))[ends - 1]
    split = (body >= starts) & (body < ends - 1)
    split[split] = ALNUM[lower[body[split]]]
    cut = body[split] + 1
    order = np.argsort(np.r_[starts, cut], kind="stable")
    out_ends = ends.copy()
    out_ends[split] = cut
    return lower, np.r_[starts, cut][order], np.r_[out_ends, ends[split]][order], np.r_[doc, doc[split]][order]


def block_ids(block: Block, path: str, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of the texts of a block, each closed by end_id, and their counts.

    The tokenizer drops ASCII white space and never joins across it, so each distinct word is encoded once.
    """
    lower, starts, ends, doc = pieces_of_words(block)
    distinct, which = np.unique(HASH.spans(HASH.sums(lower), starts, ends), return_inverse=True)
    first = np.empty(len(distinct), np.int64)  # one place of each word; asking unique for the first would cost a slower sort
    first[which] = np.arange(len(which))
    data = lower.tobytes()
    flat, begin, end = tokenizer(path).look_up([data[s:e] for s, e in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
    length = end - begin
    # every word's ids, with one place left at the end of each document
    taken = length[which] if len(which) else np.zeros(0, np.int64)
    counts = np.bincount(doc, taken, block.size).astype(np.int64) + 1
    out = np.full(int(counts.sum()), end_id, np.int64)
    place = np.cumsum(taken) - taken + doc  # one closing id for each document before
    at = np.arange(int(taken.sum())) - np.repeat(np.cumsum(taken) - taken, taken)
    out[np.repeat(place, taken) + at] = flat[np.repeat(begin[which], taken) + at]
    return out, counts


def tokenized(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, spread, ids): ids as little-endian 16-bit numbers; spread numbers the rows of a task apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            for block in blocks(batch.column(1)):
                ids, counts = block_ids(block, path, end_id)
                data, at = ids.astype("<u2").tobytes(), np.r_[0, np.cumsum(counts)].tolist()
                cut = pa.array([data[2 * a : 2 * b] for a, b in zip(at, at[1:], strict=False)], pa.binary())
                spread = pa.array(((task << 32) + seen + np.arange(block.size)).astype(np.int64))
                seen += block.size
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.first, block.size), spread, cut], ["doc_id", "spread", "ids"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, spread long, ids binary")


def token_frequencies(tokens: DataFrame) -> tuple[np.ndarray, int, float]:
    """Documents holding each id, documents, and mean length; a row for each id of the vocabulary reaches the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, rows, length = np.zeros(1 << 16, np.int64), 0, 0
        for batch in batches:
            for ids in batch.column(0):
                each = np.frombuffer(ids.as_buffer(), "<u2")
                df[each] += 1  # once for each id: repeated places are set to the same value
                rows, length = rows + 1, length + len(each)
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[held, -1, -2]), pa.array(np.r_[df[held], rows, length])], ["id", "n"])

    found = tokens.select("ids").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    n = dict(zip(found["id"].tolist(), found["n"].tolist(), strict=True))
    df = np.zeros(1 << 16)
    for k, v in n.items():
        if k >= 0:
            df[k] = v
    return df, n.get(-1, 0), n.get(-2, 0) / max(1, n.get(-1, 0))


class InvertedIndex:
    """BM25 postings of one shard: for each term the units that hold it and their weights."""

    def __init__(self, units: list[np.ndarray], idf: np.ndarray, mean: float):
        self.n = len(units)
        length = np.array([len(u) for u in units], np.int64)
        flat = np.concatenate(units).astype(np.int64) if units else np.zeros(0, np.int64)
        key, tf = np.unique(flat * max(1, self.n) + np.repeat(np.arange(self.n), length), return_counts=True)
        term, self.unit = np.divmod(key, max(1, self.n))
        self.weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[self.unit] / max(mean, 1)))
        terms, self.start = np.unique(term, return_index=True)
        self.end = np.r_[self.start[1:], len(term)]
        # the terms of each unit that another unit shares
        slot = np.searchsorted(terms, term)
        own = np.flatnonzero(self.end[slot] - self.start[slot] > 1)
        own = own[np.argsort(self.unit[own], kind="stable")]
        self.slot, self.at = slot[own], np.searchsorted(self.unit[own], np.arange(self.n + 1))

    def scores(self, unit: int) -> np.ndarray:
        """Every unit's score for all terms of one unit."""
        slots = self.slot[self.at[unit] : self.at[unit + 1]]
        rows = ranges(self.start[slots], self.end[slots] - self.start[slots])
        return np.bincount(self.unit[rows], self.weight[rows], self.n)

    def neighbours(self, scores: np.ndarray, unused: np.ndarray) -> np.ndarray:
        """The best unused units by falling score; units without a shared term are absent."""
        score = scores * unused
        best = np.argpartition(-score, NEIGHBOURS)[:NEIGHBOURS] if self.n > NEIGHBOURS else np.arange(self.n)
        best = best[score[best] > 0]
        return best[np.lexsort((best, -score[best]))]


def pack_shard(doc_ids: list, tokens: list[np.ndarray], idf: np.ndarray, mean: float, window: int = WINDOW) -> list[tuple]:
    """Pieces (row, start, length, sequence, offset) of the shard's documents."""
    pieces, sequence, units, rows, begin = [], 0, [], [], []
    for row, ids in enumerate(tokens):
        whole = len(ids) // window
        for k in range(whole):
            pieces.append((row, k * window, window, sequence, 0))
            sequence += 1
        if len(ids) % window:
            units.append(ids[whole * window :])
            rows.append(row)
            begin.append(whole * window)
    index = InvertedIndex(units, idf, mean)
    unused = np.ones(len(units), bool)
    length = [len(u) for u in units]
    order = np.argsort([-x for x in length], kind="stable").tolist()
    seed, taken, at = None, 0, 0  # a cut unit and how much of it is placed
    while True:
        if seed is None:
            while at < len(order) and not unused[order[at]]:
                at += 1
            if at == len(order):
                return pieces
            seed, taken = order[at], 0
            unused[seed] = False
        filled = length[seed] - taken
        pieces.append((rows[seed], begin[seed] + taken, filled, sequence, 0))
        spare, scores = None, index.scores(seed) if filled < window else None
        while filled < window:
            near = index.neighbours(scores, unused).tolist()
            fits = False
            for unit in near:
                if length[unit] <= window - filled:
                    pieces.append((rows[unit], begin[unit], length[unit], sequence, filled))
                    filled += length[unit]
                    unused[unit] = False
                    fits = True
                    if filled == window:
                        break
            if filled == window:
                break
            spare = next((u for u in near if unused[u]), None)
            if spare is None and not fits:  # nothing related is left: the next unused one
                while at < len(order) and not unused[order[at]]:
                    at += 1
                spare = order[at] if at < len(order) else None
                if spare is None:
                    break
            if spare is not None:
                unused[spare] = False
                part = min(length[spare], window - filled)
                pieces.append((rows[spare], begin[spare], part, sequence, filled))
                filled += part
                if part < length[spare]:
                    break
                spare = None
        seed, taken = (spare, part) if spare is not None else (None, 0)
        sequence += 1


def term_orders(df: np.ndarray, idf: np.ndarray) -> list[np.ndarray]:
    """Ranks of the terms under SIGNED random orders in which a term comes first with a chance in proportion to its idf.

    Terms that fewer than two documents hold come last: no other document can share them.
    """
    rng = np.random.default_rng(5)
    orders = []
    for _ in range(SIGNED):
        wait = np.where(df > 1, rng.exponential(size=len(df)) / np.maximum(idf, 1e-6), np.inf)
        rank = np.empty(len(df), np.uint16)
        rank[np.argsort(wait, kind="stable")] = np.arange(len(df))
        orders.append(rank)
    return orders


def signed(tokens: DataFrame, orders: list[np.ndarray]) -> DataFrame:
    """tokens (doc_id, spread, ids) with the smallest ranks s0, s1, ... of their terms; every document has a closing id."""
    names = [f"s{k}" for k in range(len(orders))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found = np.array([[order[ids].min() for order in orders] for ids in (np.frombuffer(x.as_buffer(), "<u2") for x in batch.column(2))], np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, *[pa.array(c) for c in found.T]], ["doc_id", "spread", "ids", *names])

    return tokens.select("doc_id", "spread", "ids").mapInArrow(run, "doc_id long, spread long, ids binary, " + ", ".join(f"{s} int" for s in names))


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 1, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, shard, and ids if asked for.

    Every id of every document, its closing end_id included, lies in one piece; sequences hold at most 2048 ids
    without gaps.  A null text counts as empty and has its closing id only.  Repeated rows and null ids are packed
    row by row.  An empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    tokens = stored(tokenized(docs, tokenizer_path, end_id, id_col, text_col))
    df, rows, mean = token_frequencies(tokens)
    idf = np.log1p((rows - df + 0.5) / (df + 0.5)).astype(np.float32)
    # as many tasks as the session asks for, but more where a task would get more than 64 shards
    parts = max(1, min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // (2 * shard_rows)), rows // (64 * shard_rows))
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, shard long"
    schema += ", ids array<int>" if with_ids else ""
    names = [f.split(" ")[0] for f in schema.split(", ")]

    def packed(doc_ids: list, arrays: list[np.ndarray], shard: int) -> pa.RecordBatch:
        pieces = pack_shard(doc_ids, arrays, idf, mean)
        cut = [arrays[r][s : s + n].astype("<u4") for r, s, n, _, _ in pieces]
        columns = [
            pa.array([doc_ids[p[0]] for p in pieces], pa.int64()), pa.array([p[1] for p in pieces], pa.int64()), pa.array([p[2] for p in pieces], pa.int64()),
            pa.array([zlib.crc32(c.tobytes()) for c in cut], pa.int64()), pa.array([len(arrays[p[0]]) for p in pieces], pa.int64()),
            pa.array([(shard << 24) + p[3] for p in pieces], pa.int64()), pa.array([p[4] for p in pieces], pa.int64()), pa.array([shard] * len(pieces), pa.int64()),
        ]
        if with_ids:
            columns.append(pa.array([c.astype(np.int32) for c in cut], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(columns, names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, doc_ids, arrays, held = TaskContext.get().partitionId() << 20, [], [], 0
        for batch in batches:
            for doc_id, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                array = np.frombuffer(ids.as_py(), "<u2")
                if arrays and (len(arrays) == shard_rows or held + len(array) > SHARD_IDS):
                    yield packed(doc_ids, arrays, shard)
                    shard, doc_ids, arrays, held = shard + 1, [], [], 0
                doc_ids.append(doc_id)
                arrays.append(array)
                held += len(array)
        if arrays:
            yield packed(doc_ids, arrays, shard)

    order = [*[f"s{k}" for k in range(SIGNED)], "spread"]
    dealt = signed(tokens, term_orders(df, idf)).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return dealt.select("doc_id", "ids").mapInArrow(pack, schema)
