"""Hard negatives by exact search that bounds inner products from segment summaries.

A vector is cut into segments; of each its mean m and its deviation d (root of the summed squares about the mean)
are stored.  For two segments of w components the inner product lies within w m m' plus or minus d d', so the sums
over segments bound a score.  Segments are refined level by level: a pair that a level's bounds rule out is never
looked at again, and only pairs that the finest level leaves are scored exactly.  Coarser summaries follow from the
stored finest ones.

Anchors are the stated query set.  They are searched in blocks of a fixed number of bytes, each sent to all
tasks, against all rows; a task returns its best few of every anchor.  The positives come first (rows of the
anchor's own label), then the negatives, whose score window each positive sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smslens.llm.common import stored

#: Components of a segment, level by level, each a multiple of the next.
LEVELS = (16, 4, 2)
#: Bytes of an anchor block sent to the tasks, and of the score table of one step.
ANCHOR_BYTES, STEP_BYTES = 32 << 20, 16 << 20
#: Sums of products below this are exact in doubles.
EXACT = float(1 << 53)


def prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, scale: int) -> DataFrame:
    """(id, label, vec, means, devs) of the rows that take part: whole-number components and finest summaries, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(2).cast(pa.list_(pa.float64()))
            out = []
            for i, v in enumerate(column):
                x = np.floor(v.values.to_numpy(zero_copy_only=False) * scale) if v.is_valid and not v.values.null_count else None
                if x is None or not np.isfinite(x).all():
                    continue
                x += 0.0  # no negative zeros: equal vectors have equal bytes
                out.append((i, x.tobytes(), *(s.tobytes() for s in summary(x[None, :]))))
            at = pa.array([o[0] for o in out], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), *(pa.array([o[k] for o in out], pa.binary()) for k in (1, 2, 3))], ["id", "label", "vec", "means", "devs"])

    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<double>").alias("v"))
    rows = rows.where("id is not null and label is not null and v is not null")
    return rows.mapInArrow(run, "id long, label long, vec binary, means binary, devs binary")


def summary(x: np.ndarray, width: int = LEVELS[-1]) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of each segment of each row; missing components at the end count as zero."""
    n = -(-x.shape[1] // width)
    x = np.pad(x, ((0, 0), (0, n * width - x.shape[1]))).reshape(len(x), n, width)
    mean = x.mean(2)
    return mean, np.sqrt(np.square(x - mean[:, :, None]).sum(2))


def coarser(mean: np.ndarray, dev: np.ndarray, width: int, times: int) -> tuple[np.ndarray, np.ndarray]:
    """Summaries of segments made of `times` segments of `width` components: the parallel-axis rule."""
    n = -(-mean.shape[1] // times)
    fill = ((0, 0), (0, n * times - mean.shape[1]))
    mean, dev = (np.pad(a, fill).reshape(len(a), n, times) for a in (mean, dev))
    middle = mean.mean(2)
    return middle, np.sqrt(np.square(dev).sum(2) + width * np.square(mean - middle[:, :, None]).sum(2))


class Vectors:
    """Rows as matrices: id, label, components, and for each level [sqrt(w) means] and [deviations]."""

    def __init__(self, ids, labels, vec: list[bytes], means: list[bytes], devs: list[bytes], dims: int):
        self.id, self.label = np.asarray(ids, np.int64), np.asarray(labels, np.int64)
        self.x = padded(vec, dims)
        fine = -(-dims // LEVELS[-1])
        mean, dev = padded(means, fine), padded(devs, fine)
        self.levels = []
        for k in range(len(LEVELS) - 1, -1, -1):
            if k < len(LEVELS) - 1:
                mean, dev = coarser(mean, dev, LEVELS[k + 1], LEVELS[k] // LEVELS[k + 1])
            self.levels.insert(0, (mean * np.sqrt(LEVELS[k]), dev))
        self.greatest = float(np.abs(self.x).max(initial=0))

    def __len__(self) -> int:
        return len(self.id)


def padded(parts: list[bytes], width: int) -> np.ndarray:
    out = np.zeros((len(parts), width))
    for row, part in zip(out, parts, strict=True):
        values = np.frombuffer(part)
        row[: len(values)] = values
    return out


def products(x: np.ndarray, y: np.ndarray, greatest: float) -> np.ndarray:
    """Exact inner products of all rows of x and y; whole numbers too large for doubles go through Python's integers."""
    if greatest < EXACT:
        return x @ y.T
    whole = lambda a: np.array([[int(c) for c in row] for row in a], object).reshape(a.shape)
    return np.clip(whole(x) @ whole(y).T, -(1 << 63), (1 << 63) - 1).astype(np.int64)


def surviving(a: Vectors, rows: np.ndarray, b: Vectors, columns: np.ndarray, mask: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (i, j) of a's rows and b's columns whose bounds meet [least, most] of the row, with exact scores.

    Each level bounds only what the coarser one left: rows and columns without a pair are cut away.
    """
    for (am, ad), (bm, bd) in zip(a.levels, b.levels, strict=True):
        r, c = np.flatnonzero(mask.any(1)), np.flatnonzero(mask.any(0))
        rows, columns, mask, least, most = rows[r], columns[c], mask[np.ix_(r, c)], least[r], most[r]
        middle, spread = am[rows] @ bm[columns].T, ad[rows] @ bd[columns].T
        slack = 1e-9 * (np.abs(middle) + spread) + 1e-6  # rounding of the bounds themselves
        mask = mask & (middle + spread + slack >= least[:, None]) & (middle - spread - slack <= most[:, None])
    i, j = np.nonzero(mask)
    if not len(i):
        return rows[i], columns[j], np.zeros(0)
    greatest = a.greatest * b.greatest * max(1, a.x.shape[1])
    if len(i) * 8 > mask.size or greatest >= EXACT:
        score = products(a.x[rows], b.x[columns], greatest)[i, j]
    else:
        score = np.concatenate([np.einsum("ij,ij->i", a.x[rows[i[k : k + 65536]]], b.x[columns[j[k : k + 65536]]]) for k in range(0, len(i), 65536)])
    return rows[i], columns[j], score.astype(np.int64)


class Best:
    """The `k` best (score, then smallest id) of each of n lists, fed in steps."""

    def __init__(self, n: int, k: int):
        self.k, self.floor = k, np.full(n, -np.inf)
        self.of = self.score = self.id = np.zeros(0, np.int64)

    def add(self, of: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(of):
            return
        of, score, ids = np.r_[self.of, of], np.r_[self.score, score], np.r_[self.id, ids]
        order = np.lexsort((ids, ~score, of))
        of, score, ids = of[order], score[order], ids[order]
        place = np.arange(len(of)) - np.searchsorted(of, of)
        kept = place < self.k
        last = place == self.k - 1
        self.floor[of[last]] = score[last] - np.abs(score[last]) * 2.0**-50  # a double, not above the score
        self.of, self.score, self.id = of[kept], score[kept], ids[kept]


def steps(batches: Iterator[pa.RecordBatch], dims: int, width: int) -> Iterator[Vectors]:
    """The rows of a task, as many at once as keep a score table of `width` anchors small."""
    most = max(64, STEP_BYTES // 8 // max(1, width))
    for batch in batches:
        for at in range(0, batch.num_rows, most):
            part = batch.slice(at, most)
            yield Vectors(part.column(0), part.column(1), *[part.column(k).to_pylist() for k in (2, 3, 4)], dims)


#: Anchors held against one step of rows at a time.
ANCHOR_STEP = 512


def search(rows: DataFrame, anchors: Vectors, dims: int, k: int, least: np.ndarray | None, most: np.ndarray | None, same: bool) -> DataFrame:
    """(anchor, list, id, score): of every task the k best rows of each anchor, or of each of its score windows.

    same: rows of the anchor's label other than itself; otherwise rows of other labels.  least, most: windows as
    (anchors, lists) tables of whole scores, or none for one unbounded list.
    """
    lists = 1 if least is None else least.shape[1]
    sent = rows.sparkSession.sparkContext.broadcast((anchors, least, most))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, low, high = sent.value
        if low is None:
            low, high = np.full((len(a), 1), -(1 << 63)), np.full((len(a), 1), (1 << 63) - 1)
        best = Best(len(a) * lists, k)
        wanted = (low <= high).any(1)
        below, above = np.where(low <= high, low, np.inf), np.where(low <= high, high, -np.inf)
        for b in steps(batches, dims, ANCHOR_STEP):
            for at in range(0, len(a), ANCHOR_STEP):
                r = np.arange(at, min(at + ANCHOR_STEP, len(a)))
                r = r[wanted[r]]
                if same:
                    r = r[np.isin(a.label[r], b.label)]
                if not len(r):
                    continue
                equal = a.label[r][:, None] == b.label[None, :]
                if same:
                    mask = equal
                    own = a.id[r][:, None] == b.id[None, :]
                    if own.any():
                        i, j = np.nonzero(own & equal)
                        itself = (a.x[r[i]] == b.x[j]).all(1)
                        mask[i[itself], j[itself]] = False
                else:
                    mask = ~equal
                floor = np.maximum(below[r], best.floor.reshape(-1, lists)[r])
                i, j, score = surviving(a, r, b, np.arange(len(b)), mask, floor.min(1), above[r].max(1))
                for p in range(lists):
                    fits = (score >= low[i, p]) & (score <= high[i, p]) & (score >= best.floor[i * lists + p])
                    best.add(i[fits] * lists + p, score[fits], b.id[j[fits]])
        yield pa.RecordBatch.from_arrays([pa.array(best.of // lists), pa.array(best.of % lists), pa.array(best.id), pa.array(best.score)], ["anchor", "list", "id", "score"])

    found = rows.mapInArrow(run, "anchor long, list long, id long, score long")
    order = Window.partitionBy("anchor", "list").orderBy(F.desc("score"), "id")
    return stored(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k))


def anchor_blocks(rows: DataFrame, is_anchor: Column, dims: int) -> Iterator[Vectors]:
    """The anchors in blocks of at most ANCHOR_BYTES, by ranges of a hash of their id."""
    anchors = stored(rows.where(is_anchor))
    n = anchors.count()
    blocks = max(1, -(-n * max(dims, 8) * 48 // ANCHOR_BYTES))
    for k in range(blocks):
        part = anchors.where(F.pmod(F.xxhash64("id", "vec"), F.lit(blocks)) == k).toPandas()
        if len(part):
            part = part.sort_values(["id", "label", "vec"], ignore_index=True)
            yield Vectors(part["id"], part["label"], *[[bytes(v) for v in part[c]] for c in ("vec", "means", "devs")], dims)


def windows(anchors: Vectors, positives: list, count: int, low: int, high: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per anchor and positive: its score window (least above most where there is none), the positive's id and score."""
    least, most, ids, scores = (np.full((len(anchors), count), v, np.int64) for v in (1, 0, 0, 0))
    for r in positives:
        at = (r.anchor, r.rank - 1)
        ids[at], scores[at] = r.id, r.score
        least[at], most[at] = -(-low * r.score // 100), high * r.score // 100
    return least, most, ids, scores


def hard_negatives(
    vectors: DataFrame, is_anchor: Column | None = None, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, scale: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """Rows anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components count as floor(scale * x); a score is the inner product.  An anchor's positives are its `positives`
    best other rows of the same label; for each, its negatives are the `negatives` best rows of other labels with
    low * positive <= 100 * score <= high * positive.  Ties go to the smaller id.  is_anchor is a condition on `id`
    (default: all ids divisible by 50).

    Rows without id, label or vector, or with a null or non-finite component, take no part.  Vectors of unequal
    length are compared as if zeros followed; an empty vector has score 0 with all.  Repeated rows (same id, label
    and components) count once; rows of one id that differ are rows of their own, as anchors too.  Scores beyond 64 bits
    stop there.  An empty table, or one without anchors, gives no rows.  Other columns are not read.
    """
    spark = vectors.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = stored(prepared(vectors, id_col, vector_col, label_col, scale).dropDuplicates(["id", "label", "vec"]).repartition(tasks, "id"))
    dims = (rows.agg(F.max(F.octet_length("vec"))).first()[0] or 0) // 8
    results = []
    for anchors in anchor_blocks(rows, F.col("id") % 50 == 0 if is_anchor is None else is_anchor, dims):
        own = search(rows, anchors, dims, positives, None, None, True).collect()  # at most `positives` rows an anchor of the block
        least, most, ids, scores = windows(anchors, own, positives, low, high)
        if not len(own):
            continue
        found = search(rows, anchors, dims, negatives, least, most, False)
        table = [(int(a), int(p), int(anchors.id[a]), int(ids[a, p]), int(scores[a, p])) for a, p in np.argwhere(least <= most)]
        names = spark.createDataFrame(table, "anchor long, list long, anchor_id long, positive_id long, positive_score long")
        results.append(found.join(names, ["anchor", "list"]).select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
    if not results:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
