import json
from collections import Counter, defaultdict
from datetime import date, datetime

import pytest

from smslens.functions.vocabulary import MESSAGE_TYPES, WEEKDAYS
from smslens.operators import scoring
from smslens.plans.scoring import score_phones
from tests import plain


@pytest.fixture(scope="module")
def case(spark):
    texts = ["Tu clave Davivienda es 123456", "BBVA saldo disponible $500", "hola", "La EAAB informa factura https://e.co/1"]
    rows = [("57300", texts[(i * i) % 4], 3, datetime(2024, 1, 1 + i % 28, (i * 7) % 24, 5, 3, i)) for i in range(100)]
    rows += [("57301", texts[0], 3, datetime(2024, 1, 2, 23)), ("57301", texts[0], 1, datetime(2024, 1, 2)), ("57301", texts[0], 3, datetime(2022, 1, 2)), ("57399", "x", 3, datetime(2024, 1, 3))]
    lake = spark.createDataFrame(rows, "PhoneNumber string, Message string, StatusId int, ArrivalDate timestamp_ntz")
    ids = {t: __import__("hashlib").md5(plain.extract(plain.normalize(t))[0].encode()).hexdigest()[:16] for t in texts}
    known = {ids[texts[0]]: ("banking", "otp_2fa"), ids[texts[1]]: ("banking", "unknown"), ids[texts[3]]: ("utilities", "water")}
    lookup = spark.createDataFrame([(k, c, s) for k, (c, s) in known.items()], "template_id string, categoria string, subcategoria string")
    requests = spark.createDataFrame([(1, "57301"), (0, "57300"), (2, "57777")], "ordinal int, phone_number string")
    kept = defaultdict(list)
    for p, m, st, at in rows:
        if st == 3 and at >= datetime(2023, 6, 5):
            kept[p].append((at, *known.get(ids.get(m), ("unknown", "unknown"))))
    return lake, lookup, requests, kept


def expected(phone, msgs):
    n = len(msgs)
    hours = Counter(at.hour for at, _, _ in msgs)
    days = Counter(at.weekday() for at, _, _ in msgs)
    types = Counter(next((t for t, subs in MESSAGE_TYPES.items() if s in subs), "service_notifications") for _, _, s in msgs)
    cats = []
    for c in {c for _, c, _ in msgs} - {"unknown"}:
        mine = [m for m in msgs if m[1] == c]
        subs = Counter(s for _, _, s in mine if s != "unknown")
        cats.append({"category": c, "messages_last_365d": len(mine), "share_last_365d": len(mine) / n,
                     "first_seen_at": min(m[0] for m in mine).isoformat() + "Z", "last_seen_at": max(m[0] for m in mine).isoformat() + "Z",
                     "subcategories": [{"subcategory": s, "messages_last_365d": k, "share_within_category": k / len(mine)} for s, k in subs.most_common()]})
    part = lambda a, b: sum(hours[h] for h in range(a, b)) / n if n else 0.0
    return {
        "phone_number": phone,
        "temporal_patterns": {
            "hourly_distribution": [{"hour": h, "messages_last_365d": hours[h]} for h in range(24)],
            "daypart_distribution": {"night_00_06_share_last_365d": part(0, 6), "morning_06_12_share_last_365d": part(6, 12),
                                     "afternoon_12_18_share_last_365d": part(12, 18), "evening_18_24_share_last_365d": part(18, 24)},
            "weekday_distribution": [{"weekday": WEEKDAYS[d], "messages_last_365d": days[d]} for d in range(7) if days[d]],
        },
        "categories": sorted(cats, key=lambda c: -c["messages_last_365d"]),
        "message_types": {"lookback_days": 240, "counts_last_365d": {t: types[t] for t in scoring.TYPES}},
        "metadata": {"generated_at": "now", "request_reference": "ref", "granularity": "standard", "data_lookback_days": 240, "version": "1.0.0"},
    }


def test_documents(spark, case, tmp_path):
    lake, lookup, requests, kept = case
    docs = score_phones(lake, requests, lookup, date(2024, 1, 31), "now", 240, "ref")
    scoring.write_documents(docs, str(tmp_path / "d"))
    lines = [json.loads(r.value) for r in spark.read.text(str(tmp_path / "d")).collect()]
    assert [d["phone_number"] for d in sorted(lines, key=lambda d: ["57300", "57301", "57777"].index(d["phone_number"]))] == ["57300", "57301", "57777"]
    for d in lines:
        assert d == expected(d["phone_number"], kept[d["phone_number"]])
    assert [r.phone_number for r in docs.orderBy("ordinal").collect()] == ["57300", "57301", "57777"]


def test_flat_tables(spark, case):
    lake, lookup, requests, kept = case
    from smslens.sources.lake import scan_messages

    cells = scoring.phone_cells(scoring.categorise(scan_messages(lake, requests, date(2024, 1, 31), 240), lookup, max_lookup_rows=None)).cache()
    want = expected("57300", kept["57300"])
    assert [r.messages for r in scoring.phone_hours(cells).where("phone_number = '57300'").orderBy("hour").collect()] == [h["messages_last_365d"] for h in want["temporal_patterns"]["hourly_distribution"]]
    d = scoring.phone_dayparts(cells).where("phone_number = '57300'").first().asDict()
    d.pop("phone_number")
    assert d == pytest.approx(want["temporal_patterns"]["daypart_distribution"])
    assert sum(d.values()) == pytest.approx(1.0)
    assert {r.category: r.share for r in scoring.phone_categories(cells).where("phone_number = '57300'").collect()} == {c["category"]: c["share_last_365d"] for c in want["categories"]}
    t = scoring.phone_types(cells).where("phone_number = '57300'").first().asDict()
    t.pop("phone_number")
    assert t == want["message_types"]["counts_last_365d"]
    assert scoring.phone_subcategories(cells).where("phone_number = '57301'").first().share == 1.0
    assert scoring.phone_weekdays(cells).where("phone_number = '57301'").collect()[0].weekday == "TUE"
