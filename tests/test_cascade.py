import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from smslens.operators import cascade, learn, similarity
from smslens.operators.classify import classify_rules
from smslens.operators.store import TemplateStore, conform
from smslens.operators.votes import resolve_votes
from smslens.plans.daily import DayPaths, run_day
from smslens.sources import jsonl
from smslens.streaming import classify as sc
from tests.test_similarity import gram_sets, ident, jaccard, minima, word_case, word_distance

KNOWN = "template_id string, template_text string, client_name string, label string, confidence double"
NEW = "template_id string, template_text string, applied_rules array<string>, client_name string, frequency bigint"


def known_frame(spark, rows):
    return spark.createDataFrame([(ident(t), t, c, label, conf) for t, c, label, conf in rows], KNOWN)


def new_frame(spark, rows):
    return spark.createDataFrame([(ident(t), t, [], c, n) for t, c, n in rows], NEW)


@pytest.mark.parametrize("most", [1, 2])
def test_probe_words_equals_brute_force(spark, most):
    case = word_case(140, 5)
    known, new = case[::2], case[1::2]
    index = cascade.word_index(spark.createDataFrame([(ident(t), t, s) for t, s in known], "template_id string, template_text string, sender string"), most)
    half = len(known) // 2
    frame = lambda rows: spark.createDataFrame([(ident(t), t, s) for t, s in rows], "template_id string, template_text string, sender string")
    merged = cascade.merge_word_index(cascade.word_index(frame(known[:half]), most), cascade.word_index(frame(known[half:]), most))
    want = {}
    for t, s in new:
        near = [(word_distance(t.split(" "), o.split(" ")), ident(o)) for o, so in known if so == s and set(t.split(" ")) & set(o.split(" "))]
        near = [x for x in near if x[0] <= most]
        if near:
            want[ident(t)] = min(near)
    for kept in (index, merged):
        got = {r.template_id: (int(r.score), r.similar_id) for r in cascade.probe_words(frame(new), kept, most).collect()}
        assert got == want and len(want) > 20


def test_probe_grams_equals_brute_force(spark):
    rnd = random.Random(4)
    base = [" ".join(rnd.choice("abcdefghijklmnop") * 3 for _ in range(40)) for _ in range(15)]
    new = []
    for t in base[:10]:
        words = t.split(" ")
        words[rnd.randrange(40)] = "nuevo"
        new.append(" ".join(words))
    both = list(enumerate(base + new))
    sets, n = gram_sets(both), len(base)
    sig = {i: minima(s) for i, s in sets.items()}
    share = lambda i, j: any(sig[i][b * 4 : b * 4 + 4] == sig[j][b * 4 : b * 4 + 4] for b in range(8))
    want = {}
    for i, t in both[n:]:
        near = [(-jaccard(sets[i], sets[j]), ident(base[j])) for j in range(n) if share(i, j) and jaccard(sets[i], sets[j]) >= 0.6]
        if near:
            want[ident(t)] = min(near)
    frame = lambda texts: spark.createDataFrame([(ident(t), t) for t in texts], "template_id string, template_text string")
    got = {r.template_id: (-r.score, r.similar_id) for r in cascade.probe_grams(frame(new), cascade.gram_index(frame(base)), 0.6).collect()}
    assert got == want and len(want) >= 8


def test_probe_vectors_takes_the_closest_known(spark):
    known = [(ident("k1"), [1.0, 0.0, 0.0]), (ident("k2"), [0.9, 0.1, 0.0]), (ident("k3"), [0.0, 0.0, 1.0])]
    new = [(ident("n1"), [1.0, 0.02, 0.0]), (ident("n2"), [2.0, 0.0, 0.0]), (ident("n3"), [0.0, 1.0, 0.0]), (ident("n4"), [1.0, 0.02, 0.0])]
    schema = "template_id string, vector array<double>"
    got = {r.template_id: r.similar_id for r in cascade.probe_vectors(spark.createDataFrame(new, schema), spark.createDataFrame(known, schema), 0.9).collect()}
    assert got == {ident("n1"): ident("k1"), ident("n2"): ident("k1"), ident("n4"): ident("k1")}


def test_only_unresolved_templates_go_on(spark):
    known = known_frame(spark, [
        ("pague su cuota hoy mismo", "c", "banking::loan", 0.8), ("su pedido va en camino a casa", "c", "retail::delivery", 1.0),
        ("sin etiqueta por ahora aqui", "c", " ", 1.0), ("con fallo en el juez uno", "c", "ERROR", 0.0),
    ])
    new = new_frame(spark, [
        ("pague su cuota hoy", "c", 3), ("su pedido ya va en camino a casa", "c", 2), ("[APPS] codigo [OTP]", "c", 9),
        ("sin etiqueta por ahora", "c", 1), ("con fallo en el juez dos", "c", 1), ("algo muy distinto", None, 4),
    ])
    done = cascade.cascade(classify_rules(new), known)
    got = {r.template_text: (r.level_used, r.label, r.confidence, r.similar_id, r.similar_score) for r in done.collect()}
    assert got["pague su cuota hoy"] == ("similar", "banking::loan", 0.8, ident("pague su cuota hoy mismo"), 1.0)
    assert got["su pedido ya va en camino a casa"][:2] == ("similar", "retail::delivery") and got["[APPS] codigo [OTP]"][0] == "rule"
    assert {t for t, v in got.items() if v[0] == "pending"} == {"sin etiqueta por ahora", "con fallo en el juez dos", "algo muy distinto"}
    assert {r.level_used: (r.templates, r.messages) for r in cascade.level_counts(done).collect()} == {"similar": (2, 5), "rule": (1, 9), "pending": (3, 6)}
    votes = spark.createDataFrame([], "template_id string, judge int, label string, confidence double")
    arbiter = spark.createDataFrame([], "template_id string, label string, confidence double, reasoning string, error string")
    final = {r.template_text: (r.level_used, r.agreement, r.panel_judge_1) for r in resolve_votes(done, votes, arbiter).collect()}
    assert final["pague su cuota hoy"] == ("similar", True, None) and final["algo muy distinto"] == ("error", False, None)


def training(spark, n=60):
    """Two categories; inside the first the labels differ by a word that few rows have."""
    rnd = random.Random(9)
    noise = [f"w{k}" for k in range(30)]
    rows = []
    for _ in range(n):
        for label, words in (("banking::loan", "cuota credito"), ("banking::card", "cuota tarjeta"), ("retail::sale", "oferta tienda descuento"), ("travel::flight", "vuelo abordaje sala")):
            text = " ".join([*words.split(), *rnd.sample(noise, 4)])
            rows.append((label, text))
    return spark.createDataFrame([(ident(f"{t}{i}"), t, label) for i, (label, t) in enumerate(rows)], "template_id string, template_text string, label string")


def test_submodels_in_one_pass_equal_the_plain_loop(spark):
    rows = training(spark)
    flat = learn.fit_text_classifier(rows, features=1 << 10)
    subs = learn.fit_submodels(flat, rows, ["banking", "retail", "none"])
    assert {r.category for r in subs.select("category").distinct().collect()} == {"banking", "retail"}
    tagged = rows.withColumn("category", F.split("label", "::")[0])
    got = {r.template_id: (r.predicted_label, r.prediction_confidence) for r in learn.predict_submodels(flat, subs, tagged, "category").collect()}
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import StringIndexer
    from pyspark.ml.functions import vector_to_array

    mine = learn.text_features(flat, rows.where("label like 'banking::%'"))
    indexer = StringIndexer(inputCol="label", outputCol="i", stringOrderType="alphabetAsc").fit(mine)
    fitted = LogisticRegression(featuresCol="features", labelCol="i", maxIter=30, regParam=0.01, family="multinomial").fit(indexer.transform(mine))
    want = {r.template_id: (indexer.labels[int(r.prediction)], max(r.p)) for r in fitted.transform(mine).select("template_id", "prediction", vector_to_array("probability").alias("p")).collect()}
    banking = {k: v for k, v in got.items() if k in want}
    assert len(want) == 120 and {k: v[0] for k, v in banking.items()} == {k: v[0] for k, v in want.items()}
    assert all(abs(banking[k][1] - want[k][1]) < 1e-9 for k in want)
    assert {got[r.template_id] for r in rows.where("label = 'retail::sale'").collect()} == {("retail::sale", 1.0)}
    assert len(got) == 180


def test_cuts_and_acceptance(spark):
    rows = [("a", "a", 0.95)] * 8 + [("b", "a", 0.6)] * 2 + [("a", "a", 0.7)] + [("c", "b", 0.9)] * 3 + [("b", "b", 0.5)] + [("c", "c", 0.31)]
    p = spark.createDataFrame(rows, "label string, predicted_label string, prediction_confidence double")
    cuts = learn.label_cuts(learn.threshold_curve(p), 0.9)
    got = {r.label: (round(r.cut, 2), r.precision) for r in cuts.collect()}
    assert got == {"a": (0.65, 1.0), "c": (0.0, 1.0)}
    kept = learn.accept_by_cut(p, cuts).where("accepted").groupBy("predicted_label").count().collect()
    assert {r.predicted_label: r["count"] for r in kept} == {"a": 9, "c": 1}


@pytest.fixture(scope="module")
def model(spark):
    rows = training(spark)
    held = training(spark, 30).withColumn("label", F.when(F.col("label").startswith("banking") & (F.crc32("template_id") % 2 == 0), F.lit("banking::loan")).otherwise(F.col("label")))
    return learn.fit_cascade(rows, held, features=1 << 10)


def test_saved_model_predicts_the_same(spark, tmp_path, model):
    assert {r.category for r in model.submodels.select("category").distinct().collect()} == {"banking"}
    model.save(str(tmp_path / "m"))
    back = learn.CascadeModel.load(spark, str(tmp_path / "m"))
    rows = training(spark, 20).unionByName(spark.createDataFrame([(ident("?"), "nada de esto se conoce", "x")], "template_id string, template_text string, label string"))
    seen = lambda m: {r.template_id: (r.predicted_label, r.level, r.accepted, round(r.prediction_confidence, 9)) for r in m.predict(rows).collect()}
    first = seen(model)
    assert first == seen(back) and len(first) == 81
    by = {r.template_id: r.label for r in rows.collect()}
    assert all(v[0] == by[k] and v[1] == ("l3" if by[k].startswith("banking") else "l2") and v[2] for k, v in first.items() if by[k] != "x")
    assert not first[ident("?")][2]


def texts(n):
    return [(f"cuota credito w{k} w{k + 1}", "c", 1) for k in range(n)] + [(f"vuelo abordaje sala w{k}", "c", 1) for k in range(n)] + [("nada de esto se conoce", "c", 1), ("[APPS] codigo [OTP]", "c", 1)]


def test_stream_writes_model_and_similar_results_across_a_restart(spark, tmp_path, model):
    model.save(str(tmp_path / "m"))
    store = TemplateStore(spark, str(tmp_path / "s"))
    seed = known_frame(spark, [("nada de esto se sabe", "c", "other::known", 0.9)]).withColumn("level_used", F.lit("arbiter"))
    store.insert(conform(seed.withColumn("classified_at", F.lit(datetime(2024, 1, 1))).withColumn("category", F.lit("other"))), "seed")
    frame = new_frame(spark, texts(6))
    frame.coalesce(1).write.parquet(str(tmp_path / "t"))
    votes = spark.createDataFrame([], "template_id string, judge int, label string, confidence double")
    arbiter = spark.createDataFrame([], "template_id string, label string, confidence double, reasoning string, error string")

    def run():
        stream = spark.readStream.schema(frame.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "t"))
        reloaded = learn.CascadeModel.load(spark, str(tmp_path / "m"))
        sc.classify_stream(stream, votes, arbiter, store, str(tmp_path / "log"), str(tmp_path / "ck"), "2024-01-31 00:00:00", model=reloaded, similar=True).awaitTermination()
        return {r.template_text: (r.level_used, r.label) for r in store.table().collect()}

    got = run()
    assert got["nada de esto se conoce"] == ("similar", "other::known") and got["[APPS] codigo [OTP]"][0] == "rule"
    assert got["cuota credito w0 w1"] == ("l3", "banking::loan") and got["vuelo abordaje sala w0"] == ("l2", "travel::flight")
    new_frame(spark, [("oferta tienda descuento w1", "c", 1)]).coalesce(1).write.mode("append").parquet(str(tmp_path / "t"))
    again = run()  # the next start goes on with the new file only
    assert again.pop("oferta tienda descuento w1") == ("l2", "retail::sale") and again == got
    log = jsonl.read_results(spark, str(tmp_path / "log"))
    assert {r.level_used for r in log.select("level_used").distinct().collect()} == {"l2", "l3", "similar", "rule"}
    assert log.count() == len(texts(6)) + 1


def test_daily_plan_writes_model_results(spark, tmp_path, model):
    messages = spark.createDataFrame([(i, t, datetime(2024, 1, 1), 3) for i, (t, _, _) in enumerate(texts(3))], "MTMessageId bigint, Message string, ArrivalDate timestamp_ntz, StatusId int")
    for c in ("PhoneNumber", "ClientName", "PriorityDescription", "OperatorName", "AccountName", "Variables"):
        messages = messages.withColumn(c, F.lit("c"))
    messages = messages.withColumns({c: F.lit(1) for c in ("ClientId", "PriorityId")})
    paths = DayPaths(str(tmp_path / "run"))
    run_day(messages, paths, "2024-01-31", include_pure=True, split=False, model=model, known=known_frame(spark, [("nada de esto se sabe", "c", "other::known", 0.9)]))
    got = {r.template_text: r.level_used for r in jsonl.read_results(spark, paths.of("rule_classifications")).collect()}
    assert got["nada de esto se conoce"] == "similar" and got["cuota credito w0 w1"] == "l3" and got["vuelo abordaje sala w0"] == "l2"
