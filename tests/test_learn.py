from smslens.operators import learn


def test_classifier_and_reports(spark):
    rows = [(f"{w} aviso {i % 5}", label, 0.9) for i in range(40) for w, label in (("pago factura agua", "u::water"), ("clave codigo", "b::otp"), ("saldo cuenta", "b::balance"))]
    df = spark.createDataFrame(rows, "template_text string, label string, confidence double")
    model = learn.fit_text_classifier(df, features=1 << 10)
    p = learn.predict_labels(model, df, 0.5)
    assert p.where("label <> predicted_label").count() == 0 and p.where("accepted").count() == 120
    c = learn.confusion(p)
    assert {r.category: r.needs_submodel for r in learn.submodel_categories(c).collect()} == {"u": False, "b": False}
    ready = {r.label: r.ready for r in learn.training_readiness(df, 0.8, 40).collect()}
    assert ready == {"u::water": True, "b::otp": True, "b::balance": True}
    assert learn.training_rows(df, 0.95).count() == 0


def test_threshold_curve(spark):
    rows = [("a", "a", 0.95), ("a", "a", 1.0), ("b", "a", 0.5), ("a", "b", 0.2), ("c", "b", 0.0)]
    df = spark.createDataFrame(rows, "label string, predicted_label string, prediction_confidence double")
    got = {(r.label, round(r.threshold, 2)): (r.predicted, r.correct, r.precision, r.recall) for r in learn.threshold_curve(df, steps=10).collect()}
    assert got[("a", 0.0)] == (3, 2, 2 / 3, 2 / 3) and got[("a", 0.5)] == (3, 2, 2 / 3, 2 / 3) and got[("a", 0.6)] == (2, 2, 1.0, 2 / 3)
    assert got[("b", 0.3)] == (0, 0, None, 0.0) and len(got) == 20


def test_fitting_reads_every_text_once(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(frames):
        for f in frames:
            read.add(len(f))
            yield f

    df = spark.createDataFrame([(f"a::{i % 3}", f"word{i % 3} other{i} same") for i in range(60)], "label string, template_text string")
    model = learn.fit_text_classifier(df.mapInPandas(seen, df.schema), features=1 << 10)
    assert read.value == 60
    got = learn.predict_labels(model, df).collect()
    assert all(r.predicted_label == r.label for r in got)
