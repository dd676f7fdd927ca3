from datetime import datetime

import pytest
from pyspark.sql import functions as F

from smslens.operators import store
from smslens.operators.store import TemplateStore, conform

T0 = datetime(2024, 1, 1)


def result(i, label="a::b", level="rule", conf=1.0, day=1, client="c", review=False, text="t"):
    return (i, text, label, label.split("::")[0], level, conf, client, review, datetime(2024, 1, day), 2, ["url", "otp"])


def frame(spark, rows):
    return spark.createDataFrame(rows, "template_id string, template_text string, label string, category string, level_used string, confidence double, client_name string,"
                                       " needs_human_review boolean, classified_at timestamp_ntz, frequency bigint, applied_rules array<string>")


def test_conform_and_checks(spark):
    good, bad = store.check_rows(conform(frame(spark, [result("a"), result("b", text=None)])))
    r = good.first()
    assert (r.template_id, r.subcategory, r.arbiter_abstained, r.first_seen, r.last_seen, r.frequency) == ("a", "", False, T0, T0, 2)
    assert [x.template_id for x in bad.collect()] == ["b"] and good.columns == store.COLUMNS and len(store.COLUMNS) == 30


def test_first_wins(spark):
    table = conform(frame(spark, [result("a", "old::x")]))
    new = conform(frame(spark, [result("a", "new::x"), result("b", "two::x", day=3), result("b", "one::x", day=2), result("c")]))
    got = {r.template_id: r.label for r in store.upsert_first_wins(table, new).collect()}
    assert got == {"a": "old::x", "b": "one::x", "c": "a::b"}


def test_frequency(spark):
    table = conform(frame(spark, [result("a"), result("b")]))
    seen = spark.createDataFrame([("a", datetime(2024, 2, 1)), ("a", datetime(2024, 3, 1)), ("zz", T0)], "template_id string, last_seen timestamp_ntz")
    got = {r.template_id: (r.frequency, r.last_seen) for r in store.apply_frequency(table, seen).collect()}
    assert got == {"a": (4, datetime(2024, 3, 1)), "b": (2, T0)}


def test_queries(spark, tmp_path):
    rows = [result(f"r{i}", day=1 + i) for i in range(5)] + [result(f"p{i}", level="panel_agreement", conf=0.87, client="d") for i in range(3)]
    rows += [result(f"x{i}", level="arbiter", conf=0.78, review=i == 0) for i in range(3)]
    t = conform(frame(spark, rows))
    assert [r.template_id for r in store.query_by_level(t, "rule", 2).collect()] == ["r4", "r3"]
    assert [r.confidence for r in store.query_by_confidence(t, 0.78, 0.87).collect()] == [0.78] * 3 + [0.87] * 3
    assert store.query_by_client(t, "d").count() == 3 and store.query_needing_review(t).first().template_id == "x0"
    assert {r.level_used: (r.templates, r.avg_confidence) for r in store.stats_by_level(t).collect()}["rule"] == (5, 1.0)
    assert store.get_template(t, "nope").count() == 0
    store.export_csv(t, str(tmp_path / "csv"), 4)
    out = spark.read.option("header", True).csv(str(tmp_path / "csv"))
    assert out.count() == 4 and out.first().applied_rules == "url, otp"


def test_snapshots(spark, tmp_path):
    s = TemplateStore(spark, str(tmp_path / "s"))
    assert s.version() == -1 and s.table().count() == 0 and s.get("a").count() == 0
    assert s.insert(frame(spark, [result("aa"), result("bb"), result("cc", text=None)]), "b1") == 0
    assert s.insert(frame(spark, [result("aa", "new::x"), result("dd")]), "b2") == 1
    assert s.insert(frame(spark, [result("ee")]), "b2") == 1  # a repeated batch changes nothing
    assert {r.template_id: r.label for r in s.table().collect()} == {"aa": "a::b", "bb": "a::b", "dd": "a::b"}
    seen = spark.createDataFrame([("aa", datetime(2024, 5, 1))], "template_id string, last_seen timestamp_ntz")
    assert s.count_sightings(seen, "f1") == 2
    assert s.get("aa").first().frequency == 3
    plan = s.get("aa")._jdf.queryExecution().executedPlan().toString()
    assert "id_prefix" in plan.split("PartitionFilters: [")[1].split("]")[0]
    # an unfinished snapshot is not read
    s.table().limit(1).withColumn("id_prefix", F.lit("a")).write.partitionBy("id_prefix").parquet(str(tmp_path / "s" / "data" / "v=3"))
    assert s.version() == 2 and s.table().count() == 3


@pytest.mark.parametrize("n", [1, 3])
def test_id_digits(spark, tmp_path, n):
    s = TemplateStore(spark, str(tmp_path / "s"), id_digits=n)
    s.insert(frame(spark, [result("abcd"), result("abff")]), "x")
    assert s.get("abff").count() == 1
