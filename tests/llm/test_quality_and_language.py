import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from smslens.llm import language, quality
from smslens.llm.common import blocks
from smslens.llm.queries import LLM_QUERIES


def stats_of(*texts):
    return np.concatenate([quality.statistics(b) for b in blocks(pa.array(texts))])


def test_statistics_of_small_texts():
    rows = dict(zip(quality.FEATURES, stats_of("", "ab AB ab\n12!", "x")[1], strict=True))
    assert not stats_of("", None)[0].any() and not stats_of("", None)[1].any()
    assert np.isclose(rows["log_words"], np.log(5)) and np.isclose(rows["upper"], 2 / 6) and np.isclose(rows["digit"], 2 / 12)
    assert np.isclose(rows["distinct_words"], 2 / 4) and np.isclose(rows["top_word"], 3 / 4) and np.isclose(rows["repeats"], 2 / 4)
    assert np.isclose(rows["upper_words"], 1 / 4) and np.isclose(rows["odd_words"], 1 / 4) and np.isclose(rows["log_lines"], np.log(2))
    one, many = stats_of("a b c d " * 50_000)[0], stats_of("q", "a b c d " * 50_000, "")[1]
    assert np.allclose(one, many)


def test_flat_trees_agree_with_walking_them():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(800, len(quality.FEATURES)))
    y = ((x[:, 0] > 0) & (x[:, 3] < 0.5) | (x[:, 7] > 1.5)).astype(float)
    model = quality.fit_trees(x[:600], y[:600], trees=40)

    def walk(row):
        raw = model.prior
        for f, t, v in zip(model.feature, model.threshold, model.value, strict=True):
            at = 0
            while at < len(f):
                at = 2 * at + (2 if row[f[at]] > t[at] else 1)
            raw += v[at - len(f)]
        return 1 / (1 + np.exp(-raw))

    assert np.allclose(model.score(x[600:]), [walk(r) for r in x[600:]])
    assert ((model.score(x[600:]) > 0.5) == y[600:]).mean() > 0.93
    assert quality.fit_trees(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]


def test_quality_query_beats_the_share_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in LLM_QUERIES["op4_quality_trees"](spark, d).collect()}
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    held = [(got[r.doc_id], r.quality) for r in spark.read.parquet(f"{d}/labels.parquet").collect() if got[r.doc_id].held_out]
    assert np.mean([r.predicted == q for r, q in held]) > 0.95
    good, bad = [r.score for r, q in held if q], [r.score for r, q in held if not q]
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_quality_edges(spark, make):
    docs = make([(1, None), (2, ""), (None, "some text"), (5, "x " * 300_000), (6, "a"), (6, "a")], ["stats", "score", "label"])
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 0)], "doc_id long, quality int")
    got = quality.quality_scores(docs, labels).collect()
    assert len(got) == 6 and all(r.held_out is False for r in got if r.doc_id is None)
    assert quality.quality_scores(docs, labels.where("quality = 7")).agg(F.min("score"), F.max("score")).first()[:] == (0.5, 0.5)
    assert quality.quality_scores(make([]), labels).count() == 0
    model = quality.Trees(np.zeros((1, 1), int), np.array([[3.0]]), np.array([[-1.0, 1.0]]), 1, 0.0)
    scored = quality.score_texts(docs, model)
    assert scored.columns == [*docs.columns, "quality_score"] and scored.count() == 6


def plain_vector(text, idf):
    data = bytes(b if 97 <= b <= 122 or b >= 128 else 32 for b in text.lower().encode())
    count = np.zeros(language.SIZE)
    for n in (1, 2, 3):
        for i in range(len(data) - n + 1):
            if data[i : i + n].strip(b" "):
                code = int.from_bytes(data[i : i + n], "big")
                count[(((code + n) * 2654435761) & 0xFFFFFFFF) >> 20] += 1
    x = np.log1p(count) * idf
    return x / (np.linalg.norm(x) or 1)


def test_vectors_match_plain_counting():
    texts = ["Ab, cd", "", "É à", "x", "12 3"]
    idf = np.linspace(1, 2, language.SIZE).astype(np.float32)
    got = np.concatenate([language.weighted(language.counts(b), idf) for _, b in language.text_blocks(pa.array(texts))])
    assert np.allclose(got, [plain_vector(t, idf) for t in texts], atol=1e-5)


def test_language_query_on_held_out_rows(spark):
    d = "/root/testdata/sf0.01"
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang").collect()}
    got = LLM_QUERIES["op10_nearest_centroid"](spark, d).collect()
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.lang_pred in {"en", "de", "fr", "es", "und"} for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in got if r.held_out]) > 0.95
    assert 0 < np.mean([r.rejected for r in got]) < 0.1


def test_language_edges(make):
    rows = [(i, "the house and the garden", "en") for i in range(20)] + [(20 + i, "über die grüne wiese", "de") for i in range(20)]
    rows += [(50, None), (51, "12 !?"), (None, "the garden and house"), (53, "grüne " * 200_000, None), (54, "")]
    docs = make(rows, ["place", "vector", "lettered"])
    model = language.fit_languages(docs)
    got = {r.doc_id: r for r in language.predict_languages(docs, model).collect()}
    assert {got[i].lang_pred for i in range(20)} == {"en"} and {got[20 + i].lang_pred for i in range(20)} == {"de"}
    assert [got[i].lang_pred for i in (50, 51, 54)] == ["und"] * 3 and got[50].score == 0 and got[53].lang_pred == "de"
    assert got[None].lang_pred == "en" and got[None].held_out is False
    nothing = language.fit_languages(make([]))
    assert language.predict_languages(make([]), nothing).count() == 0
    assert [r.lang_pred for r in language.predict_languages(make([(1, "abc")]), nothing).collect()] == ["und"]
