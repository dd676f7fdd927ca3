import random

import pytest
from pyspark.sql import functions as F

from smslens.functions.text import normalize_text, template_id, unify_spelling
from smslens.operators.extract import DEFAULT_RULES, PlaceholderRule, extract_templates
from smslens.operators.normalize import changed_samples, normalization_report, with_normalized
from tests import plain


def run(spark, texts, rules=None):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, cleaned_message string")
    rows = extract_templates(df, rules=rules).orderBy("i").collect()
    return [(r.template_text, list(r.applied_rules)) for r in rows]


@pytest.mark.parametrize("raw", ["HOLA Mundo", "  a  b ", "a\t\nb", None, "", "Ñandú ÁÉÍ", "a b c", "x\x1cy", "İstanbul ΣΑΣ"])
def test_normalize(spark, raw):
    got = spark.createDataFrame([(raw,)], "t string").select(normalize_text("t")).first()[0]
    assert got == plain.normalize(raw)


def test_normalize_number(spark):
    assert spark.range(12, 13).select(normalize_text("id")).first()[0] == "12"


def test_with_normalized_needs_message(spark):
    df = spark.createDataFrame([("a",)], "Other string")
    assert with_normalized(df).columns == ["Other"]


def test_normalization_report(spark):
    df = with_normalized(spark.createDataFrame([("A  b", 1), ("ok", 2), (None, 3)], "Message string, id int"))
    r = normalization_report(df).first()
    assert (r.total, r.changed, r.chars_before, r.chars_after, r.chars_removed, r.max_length_before) == (3, 1, 6, 5, 1, 4)
    assert [x.id for x in changed_samples(df, "id").collect()] == [1]
    empty = normalization_report(df.limit(0)).first()
    assert (empty.total, empty.changed_pct) == (0, 0.0)


VECTORS = [
    ("descarga la app en https://banco.com/app ahora", ["plataforma", "url"]),
    ("visita www.mitienda.co para más info", ["url"]),
    ("su pago de $1.250.000 fue exitoso", ["movimiento_bancario", "amount"]),
    ("saldo disponible: $85,000.50", ["amount"]),
    ("vence el 31-01-2026", ["date"]),
    ("próximo pago: 5 de enero de 2026", ["movimiento_bancario", "date"]),
    ("recordatorio: 20 dic 2025", ["date"]),
    ("tasa base 5% + comisión 0.5% = 5.5% total", ["percentage"]),
    ("apertura a las 9:00 a.m.", ["time"]),
    ("llama al 3001234567.", ["phone"]),
    ("contáctenos al +573001234567", ["phone"]),
    ("tu código es 482931 no lo compartas", ["otp"]),
    ("ingresa el token 99312 para continuar", ["otp"]),
    ("tienes 3 días y 4500 puntos acumulados", ["number"]),
    ("hola, gracias por contactarnos", []),
    ("itaú y banco de bogotá", ["entidad_bancaria"]),
    ("tarjeta débito", ["producto_bancario"]),
    ("débito en tu cuenta", ["movimiento_bancario"]),
    ("bancolombia: visita www.bancolombia.com", ["entidad_bancaria", "url"]),
    ("telegram code 123456 log in https://t.me/x", ["telegram", "login", "apps", "url", "number"]),
    ("su opinion vale 2500 puntos", ["otp"]),
]


def test_vectors(spark):
    got = run(spark, [t for t, _ in VECTORS])
    for (text, rules), (out, fired) in zip(VECTORS, got):
        assert fired == rules, text
        assert out == plain.extract(text)[0]


def test_known_texts(spark):
    got = run(spark, ["telegram code 123456 log in https://t.me/x", "llama al 3001234567.", "eps sanitas cita el 14 de marzo de 2024 9:00 a.m."])
    assert [g[0] for g in got] == ["[[APPS]] code [NUM] [LOGIN] [URL]", "llama al [PHONE].", "[ENTIDAD_EPS] cita el [DATE] [TIME]."]


def generated(n, seed=5):
    rnd = random.Random(seed)
    words = (
        "bancolombia bbva itaú itau banco de bogotá popular av villas app móvil portal web banca virtual aplicación factura telegram temu "
        "whatsapp log in iniciar sesión opciones método pago seguros mundial soat activar activación nueva eps sura sanitas medimás cuenta "
        "ahorros tarjeta crédito débito cdp transferencia consignación tránsacción compra cargo https://a.co/x?y=1 www.b.co $5.000 $ 12,5. "
        "14/12/2025 5 enero 20 dic 99 50% 3,5% 14:30 2:30 p.m. 3001234567 +57 300 123 4567 código clave pin otp 4821 12345678 123456789 1.5 "
        "2024/01/03 señor ñ é [otp] (web) app. eaab-celsia ſoat kelvin K ſeguros nequı NEQUI Factura ²"
    ).split(" ")
    seps = [" ", " ", " ", " ", "", ".", ",", "-", ":", "/", "\n", "é"]
    return ["".join(rnd.choice(words) + rnd.choice(seps) for _ in range(rnd.randint(1, 12))) for _ in range(n)]


def test_matches_plain_python(spark):
    texts = [plain.normalize(t) for t in generated(1500)] + generated(300, 6)
    texts = [t for t in texts if "²" not in t]  # a word character in Python only
    for text, got in zip(texts, run(spark, texts)):
        assert got == plain.extract(text), text


def test_prefilter_changes_nothing(spark):
    texts = generated(800, 9)
    bare = [PlaceholderRule(r.name, r.pattern, r.placeholder, r.priority) for r in DEFAULT_RULES]
    assert run(spark, texts) == run(spark, texts, bare)


def test_custom_and_disabled_rules(spark):
    rules = [
        PlaceholderRule("b", "b+", "<$x\\>", priority=2),
        PlaceholderRule("a", "a", "b", priority=1),
        PlaceholderRule("off", "c", "X", priority=0, enabled=False),
        PlaceholderRule("otp", r"\d+", "#", priority=3),
    ]
    assert run(spark, ["aac 12", "clave 12"], rules) == [("<$x\\>c 12", ["a", "b"]), ("cl<$x\\>ve #", ["a", "b", "otp"])]
    assert run(spark, ["abc"], []) == [("abc", [])]
    many = [PlaceholderRule(f"r{i}", f"x{i}y", f"[{i}]", i) for i in range(70)]
    assert run(spark, ["x1y x65y x69y"], many) == [("[1] [65] [69]", ["r1", "r65", "r69"])]


def test_template_id(spark):
    import hashlib

    got = spark.createDataFrame([("tu código",)], "t string").select(template_id("t")).first()[0]
    assert got == hashlib.md5("tu código".encode()).hexdigest()[:16]


def test_filters_on_the_result_do_not_explode(spark):
    df = spark.createDataFrame([("clave 1234", 1)], "cleaned_message string, k int")
    t = extract_templates(df).where("template_id < 'z' and size(applied_rules) > 0 and template_text like 'c%' and k = 1")
    assert len(t._jdf.queryExecution().optimizedPlan().toString()) < 200_000
    assert t.count() == 1


def test_unify_spelling(spark):
    df = spark.createDataFrame([("e.p.s teléfono a.m. 1.5 sr. ñandú",)], "t string")
    assert df.select(unify_spelling("t")).first()[0] == "eps telefono am. 1.5 sr. ñandu"
    assert extract_templates(df, "t", unify=True).select(F.size("applied_rules")).first()[0] >= 1


def test_sql_functions(spark):
    from smslens.functions.sql import register_sql_functions

    register_sql_functions(spark)
    r = spark.sql("SELECT normalize_message('  A \t B ') AS n, normalize_message(NULL) AS e, template_id('x') AS i").first()
    assert (r.n, r.e, r.i) == ("a b", "", "9dd4e461268c8034")
