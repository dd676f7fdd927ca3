from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from smslens.operators.joins import attach_by_key, lookup_join
from smslens.sources import jsonl, lake, lookups, messages, outputs

RAW = (
    "Message string, PhoneNumber string, StatusId int, ClientId string, ClientName string, PriorityId int, PriorityDescription string,"
    " OperatorName string, ArrivalDate timestamp_ntz, AccountName string, MTMessageId bigint, Segments int, Tool string"
)


def raw(spark):
    t = datetime(2024, 1, 5, 10)
    return spark.createDataFrame(
        [
            ("a", "57300", 3, "7", " Temu ", 1, "Alto", "Claro", t, "acc", 1, 0, "3.7"),
            ("b", "57301", 1, "8", "x", 1, "Alto", "Claro", t, "acc", 2, 2, "x"),
            (None, "57302", 3, "bad", "  ", 2, "", None, None, "acc", 3, None, "4"),
            ("d", "57303", None, "9", "y", 2, "Bajo", "Tigo", t, "acc", 4, 1, None),
        ],
        RAW,
    )


def test_delivered_and_types(spark, tmp_path):
    raw(spark).write.parquet(str(tmp_path / "m"))
    rows = messages.read_messages(spark, str(tmp_path / "m")).orderBy("mt_message_id").collect()
    assert [r.mt_message_id for r in rows] == [1, 3]
    a, b = rows
    assert (a.client_id, a.client_name, a.segments, a.part, a.attempt, a.tool) == (7, "Temu", 1, 1, 1, None)
    assert (b.message, b.client_id, b.client_name, b.priority_description, b.timestamp, b.segments, b.tool) == ("", None, None, None, None, 1, 4)
    assert b.sender_id is None and b.variables is None
    assert messages.read_messages_raw(spark, str(tmp_path / "m")).count() == 2
    with pytest.raises(Exception):
        messages.read_raw(spark, str(tmp_path / "none")).count()


def test_missing_columns(spark):
    with pytest.raises(ValueError, match="ClientName.*available"):
        messages.typed_messages(raw(spark).drop("ClientName"))


def test_first_days_and_filters(spark):
    df = raw(spark)
    assert [r.MTMessageId for r in messages.first_messages(df, 1).collect()] == [1]
    days = df.withColumn("day", F.col("MTMessageId"))
    assert messages.select_days(days, 2).count() == 1 and messages.select_days(days, [1, 2]).count() == 2 and messages.select_days(days, None).count() == 4
    assert messages.filter_messages(df, client="x", priority="Alto", operator="Claro").count() == 1


def test_lake(spark, tmp_path):
    root = str(tmp_path / "lake")
    rows = [("57300", "m1", 3, datetime(2023, 1, 1), 2023, 1, 1), ("57300", "m2", 3, datetime(2024, 1, 20, 5), 2024, 1, 20),
            ("57300", "m3", 1, datetime(2024, 1, 21), 2024, 1, 21), ("57301", "m4", 3, datetime(2024, 1, 9), 2024, 1, 9),
            ("57302", "m5", 3, datetime(2024, 1, 25), 2024, 1, 25)]
    spark.createDataFrame(rows, "PhoneNumber string, Message string, StatusId int, ArrivalDate timestamp_ntz, year int, month int, day int").write.partitionBy(
        "year", "month", "day").parquet(root)
    table = lake.open_lake(spark, root)
    phones = lookups.phone_requests(spark, None, ["57300", " ", "57301"])
    got = lake.in_phone_order(lake.scan_messages(table, phones, date(2024, 1, 31), 20)).collect()
    assert [(r.PhoneNumber, r.Message) for r in got] == [("57300", "m2")]
    plan = lake.lookback_filter(table, date(2024, 1, 31), 20)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert "EqualTo(StatusId,3)" in plan
    lake.write_slice(table, str(tmp_path / "slice"), date(2024, 1, 31), 30)
    kept = spark.read.parquet(str(tmp_path / "slice"))
    assert kept.count() == 3
    assert [r.Message for r in lake.phone_timeline(kept, "57300").collect()] == ["m2"]


def test_joins_agree(spark):
    left = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id")
    right = spark.createDataFrame([("hot", 1), ("4", 2), ("none", 3)], "k string, v int")
    want = sorted((r.k, r.id, r.v) for r in left.join(right, "k", "left").collect() if r.v)
    for bound in (10, 1, None):
        joined = lookup_join(left, right, "k", "left", bound)
        assert joined.count() == 1000
        assert sorted((r.k, r.id, r.v) for r in joined.collect() if r.v) == want
    assert lookup_join(left, right.select("k"), "k", "left_semi", None).count() == len(want)
    sizes = left.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    got = attach_by_key(left, sizes, ["k"], "n")
    assert got.count() == 1000 and got.where("k = 'hot'").agg(F.min("n"), F.max("top")).first() == (334, 999)


def test_jsonl(spark, tmp_path):
    f = tmp_path / "log.jsonl"
    f.write_text('{"template_id": "a", "frequency": 2}\n\n{"template_id": "b"\n{"template_id": "b", "metadata": {"rule_name": "r"}}\n')
    good, bad = jsonl.read_jsonl(spark, str(f), jsonl.RESULT_SCHEMA)
    assert sorted(r.template_id for r in good.collect()) == ["a", "b"]
    assert [r.line for r in bad.collect()] == ['{"template_id": "b"']
    with pytest.raises(Exception):
        jsonl.read_jsonl(spark, str(tmp_path / "none"), "a int")[0].count()
    log = str(tmp_path / "out")
    jsonl.append_results(good, log)
    jsonl.append_results(good, log)
    done = jsonl.processed_ids(jsonl.read_results(spark, log))
    assert sorted(r.template_id for r in done.collect()) == ["a", "b"]
    todo = spark.createDataFrame([("a", 1), ("c", 5), ("d", 9)], "template_id string, frequency int")
    assert [r.template_id for r in jsonl.not_processed(todo, done, 1).collect()] == ["d"]


def test_classification_csv(spark, tmp_path):
    f = tmp_path / "c.csv"
    f.write_text('ID Plantilla,Categoría,Subcategoría,Etiqueta (Label)\na,banking,otp,banking::otp\nb,,x,y\na,health,eps,"h,1"\n', encoding="utf-8")
    rows = {r.template_id: r for r in lookups.read_classification_csv(spark, str(f)).collect()}
    assert (rows["a"].categoria, rows["a"].subcategoria, rows["a"].label) == ("health", "eps", "h,1")
    assert rows["b"].categoria == "unknown"
    with pytest.raises(KeyError):
        lookups.classification_lookup(spark.createDataFrame([("a",)], "id_plantilla string"))


def test_export_feeds_lookup(spark, tmp_path):
    export = spark.createDataFrame([("a", 'he said "x", y', "l::m", "l", "m", "r", 3, "1.00", "url, otp")],
                                   "template_id string, template_text string, label string, category string, subcategory string, rule_name string, frequency int, confidence string, applied_rules string")
    outputs.write_classification_csv(export, str(tmp_path / "e"))
    r = lookups.read_classification_csv(spark, str(tmp_path / "e")).first()
    assert (r.template_id, r.categoria, r.subcategoria, r.label) == ("a", "l", "m", "l::m")


def test_taxonomy_and_phones(spark, tmp_path):
    f = tmp_path / "t.json"
    f.write_text('{"version": "1",\n "labels": [{"label": "a::b", "description": "d"}, {"label": "c::d", "description": "e"}]}')
    assert sorted((r.category, r.subcategory) for r in lookups.read_taxonomy(spark, str(f)).collect()) == [("a", "b"), ("c", "d")]
    assert lookups.default_taxonomy(spark).count() == 39
    p = tmp_path / "p.txt"
    p.write_text("57301\n\n 57302 \n")
    got = lookups.phone_requests(spark, str(p), ["57303"]).orderBy("ordinal").collect()
    assert [r.phone_number for r in got] == ["57301", "57302", "57303"]


def test_text_status_drops_rows_that_are_no_number(spark):
    from smslens.sources.messages import delivered_only

    rows = spark.createDataFrame([("3", 1), ("x", 2), (None, 3), ("3.0", 4), ("5", 5)], "StatusId string, k int")
    assert sorted(r.k for r in delivered_only(rows).collect()) == [1, 4]


def test_last_duplicate_wins_by_file_name(spark, tmp_path):
    from smslens.sources.lookups import read_classification_csv

    head = "ID Plantilla,Categoria,Subcategoria,Etiqueta\n"
    (tmp_path / "b.csv").write_text(head + "t1,banca,pagos,b\n")
    (tmp_path / "a.csv").write_text(head + "t1,salud,citas,a\n" + "".join(f"x{i},c,s,l\n" for i in range(3000)))
    got = read_classification_csv(spark, str(tmp_path))
    assert [r.label for r in got.where("template_id = 't1'").collect()] == ["b"]
