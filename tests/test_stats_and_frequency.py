from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from checks.queries import delivered, raw_messages
from smslens.operators import frequency, profiles, split, stats
from smslens.operators.extract import extract_templates
from tests import plain


@pytest.fixture(scope="module")
def rows(spark, data):
    return delivered(spark, data).collect()


def test_stats(spark, data, rows):
    df = delivered(spark, data)
    r = stats.message_report(df).first()
    assert r.total_messages == len(rows) and r.unique_clients == len({x.ClientName for x in rows} - {None})
    assert r.unique_operators == len({x.OperatorName for x in rows} - {None}) and r.unique_phones == len({x.PhoneNumber for x in rows})
    assert r.unique_priorities == 3 and r.min_timestamp == min(x.ArrivalDate for x in rows)
    top = stats.top_values(df, "ClientName", n=3).collect()
    want = Counter(x.ClientName for x in rows if x.ClientName)
    assert [t.messages for t in top] == [n for _, n in want.most_common(3)]
    assert top[0].pct == pytest.approx(100 * top[0].messages / len(rows))


def test_stats_edges(spark):
    df = spark.createDataFrame([(None, "c", None, None, None, "bad", ""), ("1", None, 1, "x", "o", "2024-01-01 00:00:00", "abc")],
                               "PhoneNumber string, ClientName string, PriorityId int, PriorityDescription string, OperatorName string, ArrivalDate string, Message string")
    assert stats.distinct_phones(df).first()[0] == 2
    r = stats.message_report(df).first()
    assert (r.unique_phones, r.unique_clients, r.unique_priorities, r.min_timestamp) == (2, 1, 1, datetime(2024, 1, 1))
    assert stats.time_range(df).first().duration_hours == 0.0
    c = {x.column_name: x.filled for x in stats.completeness(df, ("PhoneNumber", "Message")).collect()}
    assert c == {"PhoneNumber": 1, "Message": 1}
    assert {x.band: x.messages for x in stats.length_bands(df).collect()} == {"0-50": 2}
    assert stats.message_report(df.limit(0)).first().total_messages == 0
    assert stats.distinct_phones(df.limit(0)).first()[0] == 0
    assert stats.distinct_phones(df, approximate=True).first()[0] == 2


def test_frequency_matches_plain_python(spark, data, rows):
    want, first = Counter(), {}
    for x in sorted(rows, key=lambda x: x.ArrivalDate):
        text, fired = plain.extract(plain.normalize(x.Message))
        want[text] += 1
        first.setdefault(text, (x.ClientName, fired))
    got = {r.template_text: r for r in frequency.template_frequency(delivered(spark, data), include_pure=True).collect()}
    assert {t: r.frequency for t, r in got.items()} == dict(want)
    assert {t: (r.client_name, list(r.applied_rules)) for t, r in got.items()} == first
    assert sum(r.frequency for r in got.values()) == len(rows)
    again = {r.template_text: r for r in frequency.template_frequency(delivered(spark, data), include_pure=True, text_first=False).collect()}
    assert again == got


def test_template_stats(spark, data, rows):
    by = {}
    for x in rows:
        by.setdefault(plain.extract(plain.normalize(x.Message))[0], []).append(x)
    got = {r.template_text: r for r in frequency.template_stats(delivered(spark, data)).collect()}
    assert set(got) == set(by)
    for text, xs in by.items():
        r = got[text]
        assert r.frequency == len(xs) and r.phone_count == len({x.PhoneNumber for x in xs})
        assert list(r.client_names) == sorted({x.ClientName for x in xs} - {None}) and list(r.priority_ids) == sorted({x.PriorityId for x in xs})
        assert (r.first_seen, r.last_seen) == (min(x.ArrivalDate for x in xs), max(x.ArrivalDate for x in xs))


def test_reports_on_frequencies(spark):
    freq = spark.createDataFrame([("a", 1), ("b", 1), ("c", 5), ("d", 60), ("e", 20000)], "template_id string, frequency bigint")
    c = frequency.frequent_coverage(freq).first()
    assert (c.templates, c.messages, c.frequent_templates, c.frequent_messages) == (5, 20067, 3, 20065)
    assert c.messages_per_template == pytest.approx(20067 / 5) and c.reduction_pct == pytest.approx(100 * (1 - 5 / 20067))
    h = {r.frequency_range: r.templates for r in frequency.frequency_histogram(freq).collect()}
    assert h == {"1": 2, "2-5": 1, "51-100": 1, "10001+": 1}
    assert [r.template_id for r in frequency.top_frequent(freq, 2).collect()] == ["e", "d"]
    assert frequency.top_templates(freq, 1).first().pct == pytest.approx(100 * 20000 / 20067)
    assert frequency.frequent_coverage(freq.limit(0)).first().reduction_pct == 0.0


def test_split(spark, data, rows):
    t = frequency.templates_of(delivered(spark, data))
    s = split.split_summary(t).first()
    assert s.total == len(rows) == s.with_placeholders + s.pure
    assert s.placeholder_ratio == pytest.approx(s.with_placeholders / s.total)
    assert split.with_placeholders(t).count() == s.with_placeholders and split.pure_texts(t).count() == s.pure
    assert split.split_summary(t.limit(0)).first().placeholder_ratio == 0.0
    d = frequency.distinct_counts(delivered(spark, data)).first()
    assert d.unique_templates + d.unique_pure_messages == frequency.template_frequency(delivered(spark, data), include_pure=True).count()
    assert frequency.pure_text_frequency(delivered(spark, data)).agg(F.sum("frequency")).first()[0] == s.pure


def test_profiles(spark, data, rows):
    m = delivered(spark, data)
    p = profiles.phone_profile(m)
    assert p.agg(F.sum("appearances")).first()[0] == len(rows)
    cut = F.col("MTMessageId") % 2 == 0
    merged = profiles.merge_profiles(profiles.phone_profile(m.where(cut)), profiles.phone_profile(m.where(~cut)))
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key, merged.collect())) == sorted(map(key, p.collect()))


def test_plan_shape(spark, data):
    m = delivered(spark, data)
    plan = frequency.template_frequency(m)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo" in plan or "PushedFilters" in plan
    assert "Python" not in plan and "ArrowEval" not in plan and "CartesianProduct" not in plan
    # the first aggregation over all messages is a hash aggregation with fixed-width values
    first = [line for line in plan.splitlines() if "Aggregate(" in line][-1]
    assert "HashAggregate" in first and "partial_count" in first
    raw = spark.read.parquet(f"{data}/lineitem.parquet").where("l_returnflag = 'R'").select("l_comment" if False else "l_orderkey")
    assert "PushedFilters: [IsNotNull(l_returnflag), EqualTo(l_returnflag,R)]" in raw._jdf.queryExecution().executedPlan().toString()
    t = extract_templates(spark.createDataFrame([("x",)], "cleaned_message string"))
    assert "Python" not in t._jdf.queryExecution().executedPlan().toString()
    assert raw_messages(spark, data).columns[0] == "MTMessageId"
