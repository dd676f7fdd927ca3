import pytest

from smslens.operators import classify, reports, votes
from smslens.operators.classify import ClassificationRule, classify_rules, extract_tokens

CASES = [
    ("x", "Temu", "temu_sender"), ("x", "SHEIN", "shein_sender"), ("x", "Temu S.A.", None), ("x", "", None), ("x", None, None),
    ("[ACUEDUCTO] [FACTURA] [URL]", None, "utilities_water"), ("[LUZ] [FACTURA] [URL]", None, "utilities_light"),
    ("[SEGUROS] [ACTIVAR] [SOAT]", None, "utilities_insurance_renewal"), ("[TELEGRAM] [LOGIN]", None, "telegram_login"),
    ("[APPS] [OTP]", None, "apps_otp"), ("[ENTIDAD_BANCARIA] [ALTERNATIVA_PAGO] [PRODUCTO_BANCARIO]", None, "banking_payment_solutions"),
    ("[PHONE] [OTP] [ENTIDAD_BANCARIA]", None, "exclude_phone_otp"), ("[ENTIDAD_BANCARIA] [OTP] [PRODUCTO_BANCARIO]", None, "banking_otp_con_producto"),
    ("[ENTIDAD_BANCARIA] [MOVIMIENTO_BANCARIO] [AMT]", None, "banking_tx_completa"), ("[ENTIDAD_BANCARIA] [PLATAFORMA]", None, "banking_fraud_plataforma"),
    ("[ENTIDAD_BANCARIA] [PLATAFORMA] [OTP]", None, "banking_otp_2fa"), ("[ENTIDAD_BANCARIA] [MOVIMIENTO_BANCARIO] [PRODUCTO_BANCARIO]", None, "banking_transaction"),
    ("[ENTIDAD_BANCARIA] [MOVIMIENTO_BANCARIO]", None, None), ("[ENTIDAD_BANCARIA] [AMT]", None, "banking_balance"),
    ("[ENTIDAD_BANCARIA] [AMT] [PLATAFORMA]", None, None), ("[ENTIDAD_EPS] [OTP]", None, "healthcare_eps"), ("[OTP]", None, "digital_otp"),
    ("[otp]", None, None), (None, None, None),
]


def templates(spark, rows):
    return spark.createDataFrame([(str(i), t, c, 1 + i, []) for i, (t, c) in enumerate(rows)],
                                 "template_id string, template_text string, client_name string, frequency int, applied_rules array<string>")


def test_catalog(spark):
    rows = classify_rules(templates(spark, [c[:2] for c in CASES])).collect()
    got = {r.template_id: r for r in rows}
    for i, (_, _, rule) in enumerate(CASES):
        assert got[str(i)].rule_name == rule, CASES[i]
        assert got[str(i)].level_used == ("rule" if rule else "pending")
    x = got["11"]
    assert (x.label, x.category, x.subcategory, x.confidence, x.matched_tokens) == ("", "", "", 0.0, ["OTP", "PHONE"])
    assert got["21"].confidence == 0.85 and got["18"].subcategory == "balance_alerts"


def test_tokens(spark):
    got = spark.createDataFrame([("[[APPS]] [OTP] [x] [OTP] [A B]",)], "t string").select(extract_tokens("t")).first()[0]
    assert got == ["APPS", "OTP"]


def test_custom_rules_keep_their_order(spark):
    rules = [ClassificationRule("late", "single", priority=9), ClassificationRule("early", "a::b::c", priority=1)]
    r = classify_rules(templates(spark, [("x", None)]), rules).first()
    assert (r.rule_name, r.category, r.subcategory) == ("late", "single", "")
    r = classify_rules(templates(spark, [("x", None)]), rules[1:]).first()
    assert (r.category, r.subcategory) == ("a", "b")
    assert classify_rules(templates(spark, [("[OTP]", None)]), []).first().level_used == "pending"


def test_coverage(spark):
    done = classify_rules(templates(spark, [("[OTP]", None), ("x", None)]))
    assert classify.rule_coverage(done).first() == (2, 1, 1, 50.0)
    assert classify.rule_coverage(done.limit(0)).first() == (0, 0, 0, 0.0)


def resolve(spark, threshold=0.7, **kw):
    base = classify_rules(templates(spark, [("[OTP]", None)] + [("x", None)] * 7))
    v = [("1", 1, "a::b", 0.95), ("1", 2, "a::b", 0.92), ("2", 1, "a::b", 0.9), ("2", 2, "a::c", 0.9), ("3", 1, "a::b", 0.6), ("3", 2, "a::b", 0.65),
         ("4", 1, "a::b", 0.9), ("5", 1, "a::b", 0.9), ("5", 2, "z::c", 0.9), ("6", 1, "a::b", 0.9), ("6", 2, "z::c", 0.9), ("0", 1, "q", 1.0), ("0", 2, "q", 1.0)]
    a = [("2", "k::l", 0.8, "why", None), ("3", "ABSTAIN", 0.1, "unsure", None), ("4", "k::l", 0.5, "w", None), ("5", "k::l", 0.5, "w", "timeout")]
    return {r.template_id: r for r in votes.resolve_votes(
        base, spark.createDataFrame(v, "template_id string, judge int, label string, confidence double"),
        spark.createDataFrame(a, "template_id string, label string, confidence double, reasoning string, error string"), threshold, **kw).collect()}


def test_resolution(spark):
    r = resolve(spark)
    assert (r["0"].level_used, r["0"].label, r["0"].panel_judge_1) == ("rule", "digital_services::otp_2fa", None)
    assert (r["1"].level_used, r["1"].confidence, r["1"].agreement) == ("panel_agreement", 0.92, True)
    assert (r["2"].level_used, r["2"].label, r["2"].confidence, r["2"].panel_judge_2) == ("arbiter", "k::l", 0.8, "a::c")
    assert (r["3"].level_used, r["3"].needs_human_review, r["3"].arbiter_abstained, r["3"].subcategory) == ("human_review", True, True, "")
    assert (r["4"].level_used, r["4"].panel_judge_2, r["4"].panel_judge_2_conf) == ("arbiter", "error", 0.0)
    assert (r["5"].level_used, r["5"].label, r["5"].confidence, r["5"].error) == ("error", "ERROR", 0.0, "timeout")
    assert r["6"].level_used == "error" and r["6"].needs_human_review
    assert resolve(spark, 0.5)["3"].level_used == "panel_agreement"
    assert resolve(spark, 0.0)["7"].label == "error"  # two missing votes agree at threshold 0
    p = resolve(spark, partial_agreement=True)["2"]
    assert (p.level_used, p.label) == ("partial_agreement", "a")


def test_vote_reports(spark):
    res = spark.createDataFrame([("arbiter", "a::b", "a", "x", "y"), ("arbiter", "a::b", "a", "x", "y"), ("arbiter", "c", "c", "y", "x"), ("error", "ERROR", "ERROR", None, None)],
                                "level_used string, label string, category string, panel_judge_1 string, panel_judge_2 string")
    s = votes.level_summary(res).first()
    assert (s.total, s.arbiter, s.error, s.arbiter_pct) == (4, 3, 1, 75.0)
    assert votes.level_summary(res.limit(0)).first().error_pct == 0.0
    assert [tuple(r) for r in votes.disagreements(res).collect()] == [("x vs y", 2, pytest.approx(200 / 3)), ("y vs x", 1, pytest.approx(100 / 3))]
    assert [r.label for r in votes.top_labels(res, n=1).collect()] == ["a::b"]
    assert sorted(r.label for r in votes.taxonomy_violations(res, labels=["a::b"]).collect()) == ["ERROR", "c"]
    merged = votes.merge_labels(res, {"c": "a::b"})
    assert merged.where("label = 'a::b'").count() == 3
    assert votes.merge_labels(res, {}) is res
    assert votes.extrapolate_shares(spark.createDataFrame([(0.01,)], "s double"), "s", 6.7e6).first().expected_messages == 67000


def test_judges(spark):
    def judge(text, rules, client):
        if text == "boom":
            raise RuntimeError
        return f"{client}::{len(rules)}", 0.5

    got = {r.template_id: r for r in votes.judge_templates(templates(spark, [("ok", "c"), ("boom", None)]), judge, 2, 2).collect()}
    assert (got["0"].label, got["0"].judge, got["1"].label, got["1"].confidence) == ("c::0", 2, "error", 0.0)


def test_message_metadata(spark):
    df = spark.createDataFrame([("hi", "c"), ("", "c"), (None, "c")], "original_message string, client_name string")
    assert [r.message.client_name if r.message else None for r in votes.message_metadata(df).collect()] == ["c", None, None]


def test_reports(spark):
    rows = [("a", "t", ["url", "otp"], 5, "x::y", "x", "y", 1.0, "rule", "r2"), ("b", "t", ["url"], 3, "x::y", "x", "y", 0.5, "rule", "r1"),
            ("c", "t", [], 9, " ", "", "", 0.0, "rule", "r3"), ("d", "t", ["url", "number"], 4, None, None, None, 0.0, "pending", None), ("e", "t", ["url"], 4, None, None, None, 0.0, "pending", None)]
    df = spark.createDataFrame(rows, "template_id string, template_text string, applied_rules array<string>, frequency bigint, label string, category string, subcategory string, confidence double, level_used string, rule_name string")
    r = reports.label_report(df).collect()
    assert len(r) == 1 and (r[0].frequency, r[0].templates, r[0].rules, r[0].avg_confidence, r[0].rank, r[0].share) == (8, 2, "r1, r2", 0.75, 1, 1.0)
    e = reports.label_export(df).collect()
    assert [(x.template_id, x.confidence, x.applied_rules) for x in e] == [("a", "1.00", "url, otp"), ("b", "0.50", "url")]
    top = reports.pending_top(df, 1)
    assert [(x.template_id, x.rank, x.pct) for x in top.collect()] == [("d", 1, 100.0)]
    s = reports.pending_summary(reports.pending_top(df)).first()
    assert (s.templates, s.total, s.mean, s.largest, s.smallest) == (2, 8, 4.0, 4, 4)
    assert reports.pending_summary(df.limit(0)).first().total == 0
    assert [tuple(x) for x in reports.pending_rules(df.where("level_used = 'pending'")).collect()] == [("url", 2), ("number", 1)]
