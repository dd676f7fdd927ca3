import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from smslens.llm import negatives
from smslens.llm.negatives import LEVELS, Vectors, hard_negatives, summary

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, every=50, positives=5, count=3):
    """The definition, over all pairs."""
    kept = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            x = tuple(math.floor(float(np.float32(c)) * 256) for c in v)
            kept[(i, label, x)] = None
    kept = list(kept)
    dot = lambda x, y: sum(a * b for a, b in zip(x, y))
    out = []
    for i, label, x in kept:
        if i % every:
            continue
        near = sorted((-dot(x, y), j) for j, other, y in kept if other == label and (i, x) != (j, y))[:positives]
        for score, p in near:
            score = -score
            fits = sorted((-dot(x, y), j) for j, other, y in kept if other != label and 50 * score <= 100 * dot(x, y) <= 95 * score)[:count]
            out += [(i, p, k + 1, j, score, -s) for k, (s, j) in enumerate(fits)]
    return sorted(out)


def mined(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).select("*", F.lit(1).alias("id"), F.lit("x").alias("score"), F.lit(None).cast("int").alias("means"))
    return sorted(map(tuple, hard_negatives(df, **options).collect()))


def table(n, dims, seed=0, labels=4):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(labels, dims))
    label = rng.integers(0, labels, n)
    x = 0.6 * centre[label] + rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1)[:, None]
    return [(i, [float(c) for c in x[i]], int(label[i])) for i in range(n)]


def test_equals_all_pairs(spark):
    rows = table(1_200, 64)
    want = plain(rows)
    assert len(want) > 200 and mined(spark, rows) == want


def test_several_anchor_blocks_and_steps(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHOR_BYTES", 48 * 30 * 12)
    rows = table(700, 30, 1)
    assert mined(spark, rows) == plain(rows)


def test_nulls_ties_repeats_and_odd_lengths(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (0, [0.5, 0.5], 1), (0, [1.0, 0.0], 2), (1, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (3, [0.8], 2), (4, [0.8, 0.0], 2),
        (5, [0.8, 0.1, 0.2], 3), (6, [], 3), (7, None, 1), (8, [nan, 1.0], 1), (9, [inf], 1), (10, [None, 1.0], 1), (11, [0.7, 0.7], None), (None, [1.0, 0.0], 1),
        (50, [-1.0, 0.0], 4), (51, [1.0, 0.0], 4), (100, [0.0], 5), (101, [0.0], 5), (150, [0.3, 0.3], 77),
    ]
    assert mined(spark, rows) == plain(rows) != []


def test_empty_tables_and_no_anchor(spark):
    assert mined(spark, []) == [] == mined(spark, [(1, [1.0], 1), (2, [1.0], 1)]) == mined(spark, [(50, [1.0], 1), (2, [1.0], 2)])


def test_components_beyond_doubles_stay_exact(spark):
    rows = [(i, [float(900_001 - 7_000 * (i % 60)), float(-899_999 + 7_111 * i)] * 3, i % 2) for i in range(60)]
    assert mined(spark, rows) == plain(rows) != []


def test_many_equal_vectors(spark):
    rows = [(i, [0.5, 0.5, 0.1], i % 2) for i in range(900)] + [(1_000 + i, [0.4, 0.4, 0.1 * (i % 5)], 2) for i in range(100)]
    assert mined(spark, rows) == plain(rows) != []


@pytest.mark.parametrize("dims", [1, 5, 16, 33, 64])
def test_every_level_bounds_the_score(dims):
    x = np.floor(np.random.default_rng(dims).normal(size=(40, dims)) * 256)
    means, devs = summary(x)
    v = Vectors(range(40), [0] * 40, [r.tobytes() for r in x], [r.tobytes() for r in means], [r.tobytes() for r in devs], dims)
    exact = x @ x.T
    widths = []
    for mean, dev in v.levels:
        middle, spread = mean @ mean.T, dev @ dev.T
        assert (np.abs(exact - middle) <= spread + 1e-6 * (1 + spread)).all()
        widths.append(spread.sum())
    assert len(v.levels) == len(LEVELS) and widths == sorted(widths, reverse=True)
