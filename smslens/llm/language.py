"""Language identification by nearest centroid.

A text becomes a TF-IDF vector of hashed one- to three-byte n-grams of its lower-cased letters, of length 1.  Each
language has several centroids, found by spherical k-means on a bounded sample of its texts; document frequencies
come from every text that may be learned from.  A text takes the language of the centroid with the largest cosine
and is marked as rejected where that cosine is below what nearly all learned texts of the cluster reach.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from smslens.llm.common import Block, blocks, remainder, stored

#: Places of the hashed vector.
SIZE = 4096
#: Texts of one language that clustering sees, about, picked by a hash of the id.
SAMPLE = 600
CLUSTERS = 3
#: Share of a cluster's learned texts that may lie beyond its rejection distance.
BEYOND = 0.01
#: Texts in one dense matrix.
TEXTS = 256

#: Letters stay (bytes beyond ASCII are parts of letters); everything else is a gap.
LETTER = np.full(256, 32, np.uint8)
LETTER[97:123] = np.arange(97, 123)
LETTER[128:] = np.arange(128, 256)


def lowered(column: pa.Array) -> pa.Array:
    return pc.utf8_lower(column)


def counts(block: Block) -> np.ndarray:
    """N-gram counts, one row of SIZE places per text."""
    out = np.zeros(block.size * SIZE, np.int64)
    byte = LETTER[block.data].astype(np.uint32)
    doc = np.repeat(np.arange(block.size), np.diff(block.offsets))
    code, gap = np.zeros(len(byte), np.uint32), np.ones(len(byte), bool)
    for n in (1, 2, 3):
        last = len(byte) - n + 1
        if last <= 0:
            break
        code = code[:last] * np.uint32(256) + byte[n - 1 :]
        gap = gap[:last] & (byte[n - 1 :] == 32)
        use = ~gap & (doc[:last] == doc[n - 1 :])
        place = ((code[use] + np.uint32(n)) * np.uint32(2654435761)) >> np.uint32(20)
        out += np.bincount(doc[:last][use] * SIZE + place, minlength=len(out))
    return out.reshape(block.size, SIZE)


def weighted(count: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """TF-IDF rows of length 1; a row without n-grams stays zero."""
    x = np.log1p(count).astype(np.float32) * idf
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, length, out=x, where=length > 0)


def text_blocks(column: pa.Array) -> Iterator[tuple[int, Block]]:
    """Blocks of lower-cased texts, few enough for a dense matrix, with their first row."""
    low = lowered(column)
    for start in range(0, len(low), TEXTS):
        for block in blocks(low.slice(start, TEXTS)):
            yield start + block.first, block


@dataclass
class Centroids:
    """languages[i] has centroid vectors[i] and rejects texts whose cosine is under reach[i]."""

    languages: list[str]
    vectors: np.ndarray
    reach: np.ndarray
    idf: np.ndarray

    def nearest(self, block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Centroid, cosine and rejection of each text."""
        cosine = weighted(counts(block), self.idf) @ self.vectors.T
        best = cosine.argmax(1)
        score = np.clip(cosine[np.arange(len(best)), best], 0, 1).astype(float)
        return best, score, score < self.reach[best]


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart starts: centroids of length 1 and each row's cluster."""
    chosen = [int((x @ x.sum(0)).argmax())]
    while len(chosen) < min(k, len(x)):
        chosen.append(int((x @ x[chosen].T).max(1).argmin()))
    centre = x[chosen]
    for _ in range(rounds):
        cluster = (x @ centre.T).argmax(1)
        sums = np.stack([x[cluster == c].sum(0) if (cluster == c).any() else centre[c] for c in range(len(centre))])
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centre = np.divide(sums, length, out=centre.copy(), where=length > 0)
    return centre, (x @ centre.T).argmax(1)


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Centroids:
    """Learn from rows with a language and a text with letters whose id's crc32 leaves no 1 on division by 3."""
    learn = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    learn = learn.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (remainder("doc_id", 3) != 1) & F.col("text").rlike(r"\p{L}"))

    def frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, found = 0, np.zeros(SIZE, np.int64)
        for batch in batches:
            for _, block in text_blocks(batch.column(0)):
                found += (counts(block) > 0).sum(0)
                texts += block.size
        place = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[place, -1]), pa.array(np.r_[found[place], texts])], ["place", "n"])

    totals = learn.select("text").mapInArrow(frequencies, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).collect()
    df, texts = np.zeros(SIZE), 0
    for r in totals:  # SIZE + 1 rows at most
        if r.place < 0:
            texts = r.n
        else:
            df[r.place] = r.n
    idf = (np.log((1 + texts) / (1 + df)) + 1).astype(np.float32)

    sizes = stored(learn.groupBy("lang").agg(F.count("*").alias("n")))
    picked = learn.join(F.broadcast(sizes) if sizes.count() <= 10_000 else sizes, "lang")
    picked = picked.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.lit(SAMPLE * 1_000_000) / F.col("n")).select("lang", "text")

    def cluster(pdf: pd.DataFrame) -> pd.DataFrame:
        column = pa.array(pdf["text"].sort_values().tolist(), pa.string())
        x = np.concatenate([weighted(counts(block), idf) for _, block in text_blocks(column)])
        centre, of = k_means(x, CLUSTERS)
        cosine = (x * centre[of]).sum(1)
        rows = [(pdf["lang"].iloc[0], centre[c].astype(np.float32).tobytes(), float(np.quantile(cosine[of == c], BEYOND))) for c in range(len(centre)) if (of == c).any()]
        return pd.DataFrame(rows, columns=["lang", "vector", "reach"])

    found = picked.groupBy("lang").applyInPandas(cluster, "lang string, vector binary, reach double").collect()
    found.sort(key=lambda r: (r.lang, bytes(r.vector)))
    vectors = np.stack([np.frombuffer(r.vector, np.float32) for r in found]) if found else np.zeros((0, SIZE), np.float32)
    return Centroids([r.lang for r in found], vectors, np.array([r.reach for r in found]), idf)


def predict_languages(docs: DataFrame, model: Centroids, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score, rejected.

    A null text, a text without letters and, if nothing was learned, any text is `und` with score 0 and rejected.
    Rows with a repeated or null id are predicted one by one; a null id is not held out.  An empty table gives none.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)).alias("lettered"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*model.languages, "und"], object)
        for batch in batches:
            n = batch.num_rows
            best, score, rejected = np.full(n, len(names) - 1), np.zeros(n), np.ones(n, bool)
            if model.languages:
                for first, block in text_blocks(batch.column(1)):
                    part = slice(first, first + block.size)
                    best[part], score[part], rejected[part] = model.nearest(block)
                none = ~batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
                best[none], score[none], rejected[none] = len(names) - 1, 0, True
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(names[best], pa.string()), pa.array(score), pa.array(rejected)], ["doc_id", "lang_pred", "score", "rejected"])

    found = rows.mapInArrow(run, "doc_id long, lang_pred string, score double, rejected boolean")
    return found.select("doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")
