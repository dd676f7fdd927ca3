"""Quality classifier: histogram gradient-boosted trees over document statistics.

One map-only pass turns whole texts into a short row of statistics.  The trees are fitted on a bounded sample of
labelled rows: statistics are cut into quantile bins, each level takes the split with the best gain from gradient
histograms.  A fitted model is a handful of flat arrays (feature, threshold, leaf value per heap position), which
numpy walks for a whole batch at once, one step per level and tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from smslens.llm.common import LOWER, Block, RollingHash, blocks, lists, remainder, shingles, stored, words

FEATURES = (
    "log_bytes", "log_words", "upper", "digit", "odd", "stop", "non_ascii", "newline", "blank", "word_length", "word_spread",
    "distinct_words", "top_word", "repeats", "distinct_trigrams", "one_byte_words", "long_words", "odd_words", "upper_words", "log_lines",
)
#: Labelled rows used for fitting, about; further ones are left out by a hash of their id.
FIT_ROWS = 20_000
HASH = RollingHash(4)

KIND = np.full(256, 7, np.uint8)  # 0 lower, 1 upper, 2 digit, 3 blank, 4 newline, 5 sentence mark, 6 odd mark, 7 other, 8 beyond ASCII
KIND[97:123], KIND[65:91], KIND[48:58], KIND[[9, 11, 12, 13, 32]], KIND[10] = 0, 1, 2, 3, 4
KIND[[ord(c) for c in ".,;:?'\"()-"]] = 5
KIND[[ord(c) for c in "!#$%&*+/<=>@[\\]^_`{|}~"]] = 6
KIND[128:] = 8


def statistics(block: Block) -> np.ndarray:
    """Statistics of each text of a block, len(FEATURES) columns; an empty text has zeros."""
    n, size = block.size, np.diff(block.offsets).astype(float)
    kinds = KIND[block.data]
    doc_of = np.repeat(np.arange(n), np.diff(block.offsets))
    by_kind = np.bincount(doc_of * 9 + kinds, minlength=9 * n).reshape(n, 9).astype(float)
    starts, ends, doc = words(block)
    length = (ends - starts).astype(float)
    count = lambda which, weights=None: np.bincount(doc[which], weights, n).astype(float)
    everything = np.ones(len(doc), bool)
    n_words = count(everything)
    per = lambda x, of: np.divide(x, of, out=np.zeros(n), where=of > 0)
    mean = per(count(everything, length), n_words)
    spread = np.sqrt(np.maximum(per(count(everything, length**2), n_words) - mean**2, 0))
    hashed = HASH.spans(HASH.sums(block.data, LOWER), starts, ends)
    distinct, top = distinct_per_doc(hashed, doc, n)
    again = np.zeros(len(doc), bool)
    again[1:] = (hashed[1:] == hashed[:-1]) & (doc[1:] == doc[:-1])
    trigram, tri_doc = shingles(hashed, doc, 3)
    tri_distinct, _ = distinct_per_doc(trigram, tri_doc, n)
    inside = lambda mask: np.diff(np.r_[0, np.cumsum(mask)][np.c_[starts, ends]])[:, 0] if len(doc) else np.zeros(0)
    odd, upper = inside(kinds == 6) > 0, (inside(kinds == 1) > 1) & (inside(kinds == 0) == 0)
    letters = by_kind[:, 0] + by_kind[:, 1]
    return np.column_stack([
        np.log1p(size), np.log1p(n_words), per(by_kind[:, 1], letters), per(by_kind[:, 2], size), per(by_kind[:, 6], size), per(by_kind[:, 5], size),
        per(by_kind[:, 8], size), per(by_kind[:, 4], size), per(by_kind[:, 3], size), mean, spread, per(distinct, n_words), per(top, n_words),
        per(count(again), n_words), per(tri_distinct, np.bincount(tri_doc, minlength=n).astype(float)), per(count(length == 1), n_words),
        per(count(length > 14), n_words), per(count(odd), n_words), per(count(upper), n_words), np.log1p(by_kind[:, 4]),
    ])


def distinct_per_doc(hashed: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each document and the count of its most frequent one."""
    if not len(hashed):
        return np.zeros(n), np.zeros(n)
    order = np.lexsort((hashed, doc))
    h, d = hashed[order], doc[order]
    first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])])
    runs = np.diff(np.r_[first, len(h)])
    top = np.zeros(n)
    np.maximum.at(top, d[first], runs)
    return np.bincount(d[first], minlength=n).astype(float), top


@dataclass
class Trees:
    """Complete binary trees as arrays of shape (trees, nodes): a row with x[feature] > threshold goes right."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    depth: int
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of statistics."""
        raw, rows = np.full(len(x), self.prior), np.arange(len(x))
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, feature[at]] > threshold[at])
            raw += value[at - (len(value) - 1)]
        return 1 / (1 + np.exp(-raw))


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64, smooth: float = 2.0) -> Trees:
    """Boost on the logistic loss.  Without rows of both labels the model is the share of ones, without rows 0.5."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    prior = float(np.log(share / (1 - share)))
    nodes, leaves = (1 << depth) - 1, 1 << depth
    feature, threshold, value = np.zeros((trees, nodes), np.int64), np.full((trees, nodes), np.inf), np.zeros((trees, leaves))
    if len(y) == 0 or y.min() == y.max():
        return Trees(feature[:0], threshold[:0], value[:0], depth, prior)
    cuts = [np.unique(np.quantile(x[:, j], np.arange(1, bins) / bins)) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(c, x[:, j], "left") for j, c in enumerate(cuts)])  # bin b: cuts[b-1] < x <= cuts[b]
    columns, rows = x.shape[1], np.arange(len(y))
    raw = np.full(len(y), prior)
    for t in range(trees):
        p = 1 / (1 + np.exp(-raw))
        grad, hess = y - p, p * (1 - p)
        at = np.zeros(len(y), np.int64)
        for level in range(depth):
            width, base = 1 << level, (1 << level) - 1
            key = ((at - base)[:, None] * columns + np.arange(columns)) * bins + binned
            shape = (width, columns, bins)
            g = np.bincount(key.ravel(), np.repeat(grad, columns), width * columns * bins).reshape(shape).cumsum(2)
            h = np.bincount(key.ravel(), np.repeat(hess, columns), width * columns * bins).reshape(shape).cumsum(2)
            g_all, h_all = g[:, :1, -1:], h[:, :1, -1:]
            gain = g**2 / (h + smooth) + (g_all - g) ** 2 / (h_all - h + smooth) - g_all**2 / (h_all + smooth)
            gain[(h < 1) | (h_all - h < 1)] = 0
            best = gain.reshape(width, -1).argmax(1)
            for node in range(width):
                if gain.reshape(width, -1)[node, best[node]] > 1e-6:
                    j, b = divmod(int(best[node]), bins)
                    if b < len(cuts[j]):
                        feature[t, base + node], threshold[t, base + node] = j, cuts[j][b]
            at = 2 * at + 1 + (x[rows, feature[t][at]] > threshold[t][at])
        leaf = at - nodes
        value[t] = rate * np.bincount(leaf, grad, leaves) / (np.bincount(leaf, hess, leaves) + smooth)
        raw += value[t][leaf]
    return Trees(feature, threshold, value, depth, prior)


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, stats): one row per document, from its whole text; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(1)):
                stats = statistics(block).astype(np.float32)
                ids = batch.column(0).slice(block.first, block.size)
                yield pa.RecordBatch.from_arrays([ids, lists(stats.ravel(), np.full(block.size, len(FEATURES)), pa.float32())], ["doc_id", "stats"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, stats array<float>")


def fit_quality(stats: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Trees:
    """Fit on labelled rows whose id's crc32 is not divisible by 5, at most about fit_rows of them, picked by hash.

    Labels of one id that disagree count as their majority (a tie as 1); null labels and ids are not used.
    """
    known = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.round(F.avg("quality")).cast("int").alias("label"))
    known = stored(known.where(remainder("doc_id", 5) != 0).withColumn("pick", F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000))))
    share = min(1.0, fit_rows / max(1, known.count()))
    sample = stats.join(known.where(F.col("pick") < int(share * 1_000_000)).drop("pick"), "doc_id").select("doc_id", "stats", "label").toArrow()
    if sample.num_rows == 0:
        return fit_trees(np.zeros((0, len(FEATURES))), np.zeros(0))
    sample = sample.sort_by([("doc_id", "ascending"), ("label", "ascending")])
    flat = sample["stats"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return fit_trees(flat.reshape(-1, len(FEATURES)).astype(float), sample["label"].to_numpy().astype(float))


def score_statistics(stats: DataFrame, model: Trees) -> DataFrame:
    """stats plus score, walked batch by batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES)).astype(float)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(model.score(x), pa.float64())], ["doc_id", "stats", "score"])

    return stats.select("doc_id", "stats").mapInArrow(run, "doc_id long, stats array<float>, score double")


def score_texts(docs: DataFrame, model: Trees, text_col: str = "text", score_col: str = "quality_score") -> DataFrame:
    """docs with all its columns plus the score, in one map-only pass; score_col replaces a column of that name."""
    docs = docs.drop(score_col)
    schema = T.StructType([*docs.schema.fields, T.StructField(score_col, T.DoubleType())])
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.score(statistics(block).astype(np.float32).astype(float)) for block in blocks(batch.column(at))]
            scores = pa.array(np.concatenate(found) if found else np.zeros(0), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, score_col])

    return docs.mapInArrow(run, schema)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, stats.

    Only the text makes the score.  Rows with a repeated id are scored one by one; a null id is never held out.
    An empty table of documents gives no rows; without usable labels every score is 0.5.
    """
    stats = stored(document_statistics(docs))
    scored = score_statistics(stats, fit_quality(stats, labels))
    held_out = F.coalesce(remainder("doc_id", 5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "stats")
