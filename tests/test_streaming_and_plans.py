import json
from datetime import datetime
from pathlib import Path

from pyspark.sql import functions as F

from checks.queries import delivered, raw_messages
from smslens.operators import frequency
from smslens.operators.classify import classify_rules
from smslens.operators.store import TemplateStore
from smslens.plans.daily import DayPaths, read_unique_templates, run_day, run_days
from smslens.plans.resume import classify_remaining
from smslens.sources import jsonl, outputs
from smslens.streaming import classify as sc
from smslens.streaming import messages as sm

NO_VOTES = "template_id string, judge int, label string, confidence double"
NO_ARBITER = "template_id string, label string, confidence double, reasoning string, error string"


def test_running_counts_equal_batch(spark, data, tmp_path):
    raw = raw_messages(spark, data).select("Message", "StatusId", "ArrivalDate", "ClientName")
    raw.repartition(4).write.parquet(str(tmp_path / "in"))
    rows = sm.stream_messages(spark, str(tmp_path / "in"), raw.schema, files_per_batch=1)
    out = str(tmp_path / "out")
    sm.write_running(sm.running_template_counts(rows), out, str(tmp_path / "log")).awaitTermination()
    got = {(r.template_id, r.frequency) for r in sm.latest_running(spark, out, "template_id", "template_text").collect()}
    want = {(r.template_id, r.frequency) for r in frequency.template_frequency(delivered(spark, data), include_pure=True).collect()}
    assert got == want
    assert len(list(Path(out).glob("gen=*/batch=*"))) == 4
    # more files later: the state goes on from the checkpoint
    raw.limit(10).where("StatusId = 3").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    extra = raw.limit(10).where("StatusId = 3").count()
    sm.write_running(sm.running_template_counts(rows), out, str(tmp_path / "log")).awaitTermination()
    assert sm.latest_running(spark, out, "template_id", "template_text").agg(F.sum("frequency")).first()[0] == sum(n for _, n in want) + extra


def test_first_sightings(spark, data, tmp_path):
    raw = raw_messages(spark, data).select("Message", "StatusId", "ArrivalDate", "ClientName")
    raw.repartition(3).write.parquet(str(tmp_path / "in"))
    for i, mark in enumerate((None, "400 days")):
        rows = sm.stream_templates(sm.stream_messages(spark, str(tmp_path / "in"), raw.schema, 1))
        sm.append_stream(sm.first_sightings(rows, mark), str(tmp_path / f"o{i}"), str(tmp_path / f"l{i}")).awaitTermination()
        got = [r.template_id for r in spark.read.parquet(str(tmp_path / f"o{i}")).collect()]
        assert len(got) == len(set(got)) == frequency.template_frequency(delivered(spark, data), include_pure=True).count()


def test_history_stays_bounded(spark, tmp_path):
    rows = [(f"t{k % 7}", f"x{k % 7}", [], datetime(2024, 1, 1 + k // 7, k % 7)) for k in range(70)] + [("hot", "h", ["otp"], datetime(2024, 1, 1))] * 300
    schema = "template_id string, template_text string, applied_rules array<string>, ArrivalDate timestamp_ntz"
    spark.createDataFrame(rows, schema).repartition(11).write.parquet(str(tmp_path / "in"))
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    counts = stream().groupBy("template_id", "template_text").agg(F.count("*").alias("frequency"))
    sm.write_running(counts, str(tmp_path / "run"), str(tmp_path / "c1"), kept=3).awaitTermination()
    got = {r.template_id: r.frequency for r in sm.latest_running(spark, str(tmp_path / "run"), "template_id", "template_text").collect()}
    assert got == {**{f"t{k}": 10 for k in range(7)}, "hot": 300}
    sm.write_first_sightings(stream(), str(tmp_path / "first"), str(tmp_path / "c2"), kept=3).awaitTermination()
    first = [r.template_id for r in sm.known_sightings(spark, str(tmp_path / "first")).collect()]
    assert sorted(first) == sorted(got)
    for name in ("run", "first"):
        assert len(list((tmp_path / name).glob("gen=*"))) == 2 and len(list((tmp_path / name).glob("gen=*/batch=*"))) <= 6
    # a restart goes on; a batch that ran before its commit was lost is written again over itself
    last = max(int(f.name) for f in (tmp_path / "c2" / "commits").iterdir() if f.name.isdigit())
    (tmp_path / "c2" / "commits" / str(last)).unlink()
    for crc in (tmp_path / "c2" / "commits").glob(f".{last}*"):
        crc.unlink()
    spark.createDataFrame([("new", "n", [], datetime(2024, 3, 1)), ("hot", "h", ["otp"], datetime(2024, 3, 1))], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    sm.write_first_sightings(stream(), str(tmp_path / "first"), str(tmp_path / "c2"), kept=3).awaitTermination()
    assert sorted(r.template_id for r in sm.known_sightings(spark, str(tmp_path / "first")).collect()) == sorted([*got, "new"])


def test_a_hot_template_leaves_each_task_once(spark, tmp_path):
    rows = spark.range(0, 4000, 1, 4).select(F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("t"), F.col("id") % 5)).alias("template_id"))
    one = rows.groupBy("template_id").agg(F.count("*").alias("n"))
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_count") > plan.index("Exchange")  # the map-side part stands below the shuffle
    schema = "template_id string, template_text string, applied_rules array<string>, ArrivalDate timestamp_ntz"
    wide = rows.select("template_id", F.lit("x").alias("template_text"), F.array().cast("array<string>").alias("applied_rules"), F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("ArrivalDate"))
    wide.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    sm.write_first_sightings(stream, str(tmp_path / "out"), str(tmp_path / "ck")).awaitTermination()
    assert sm.known_sightings(spark, str(tmp_path / "out")).count() == 6


def test_classify_stream(spark, data, tmp_path):
    freq = frequency.template_frequency(delivered(spark, data), include_pure=True).select("template_id", "template_text", "applied_rules", "client_name", "frequency")
    freq.repartition(2).write.parquet(str(tmp_path / "t"))
    stream = spark.readStream.schema(freq.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "t"))
    store = TemplateStore(spark, str(tmp_path / "s"))
    votes, arbiter = spark.createDataFrame([], NO_VOTES), spark.createDataFrame([], NO_ARBITER)
    sc.classify_stream(stream, votes, arbiter, store, str(tmp_path / "log"), str(tmp_path / "ck"), "2024-01-31 00:00:00").awaitTermination()
    want = {r.template_id: r.label if r.level_used == "rule" else "ERROR" for r in classify_rules(freq).collect()}
    assert {r.template_id: r.label for r in store.table().collect()} == want
    assert jsonl.processed_ids(jsonl.read_results(spark, str(tmp_path / "log"))).count() == len(want)


def with_day(spark, data):
    return raw_messages(spark, data).withColumn("day", F.dayofmonth("ArrivalDate"))


def test_run_day(spark, data, tmp_path):
    paths = DayPaths(str(tmp_path / "run"))
    meta = run_day(raw_messages(spark, data), paths, "2024-01-31", "events").first()
    total = delivered(spark, data).count()
    l0 = meta.l0_classification
    assert meta.total_messages == total and l0.matched_rules + l0.pending == l0.total_classified == meta.unique_templates
    stored = read_unique_templates(spark, paths, "2024-01-31")
    assert stored.agg(F.sum("frequency")).first()[0] == total
    groups = {r.has_placeholder: r["count"] for r in spark.read.parquet(paths.of("templates")).groupBy("has_placeholder").count().collect()}
    assert sum(groups.values()) == total
    assert jsonl.read_results(spark, paths.of("rule_classifications")).where("metadata.rule_name is not null").count() == l0.matched_rules
    unique = stored.count()
    again = run_day(raw_messages(spark, data), paths, "2024-01-31", "events").first()
    assert again == meta and read_unique_templates(spark, paths, "2024-01-31").count() == unique
    run_day(raw_messages(spark, data).limit(50), paths, "2024-02-01", split=False, include_pure=True)
    assert read_unique_templates(spark, paths, "2024-01-31").agg(F.sum("frequency")).first()[0] == total
    lines = [json.loads(x) for f in Path(paths.of("metadata")).rglob("*.json") for x in f.read_text().splitlines()]
    assert len(lines) == 2


def test_failed_day_does_not_stop_the_others(spark, data, tmp_path):
    df = with_day(spark, data)
    broken = df.withColumn("Message", F.when(F.col("day") == 2, F.raise_error(F.lit("bad file"))).otherwise(F.col("Message")))
    status = run_days(broken, DayPaths(str(tmp_path / "d")), [1, 2, 3], "r")
    assert status[1] == status[3] == "ok" and status[2].startswith("failed")


def test_resume(spark):
    t = spark.createDataFrame([("a", "[OTP]", [], None, 3), ("b", "x", [], None, 9), ("c", "[OTP]", [], None, 5)],
                              "template_id string, template_text string, applied_rules array<string>, client_name string, frequency bigint")
    log = spark.createDataFrame([("b",), (None,)], "template_id string")
    votes, arbiter = spark.createDataFrame([], NO_VOTES), spark.createDataFrame([], NO_ARBITER)
    assert [r.template_id for r in classify_remaining(t, log, votes, arbiter, limit=1).collect()] == ["c"]
    assert classify_remaining(t, log, votes, arbiter).count() == 2


def test_template_log(spark, data, tmp_path):
    t = frequency.templates_of(delivered(spark, data)).withColumnRenamed("Message", "original_message")
    outputs.append_template_log(t, str(tmp_path / "log"))
    outputs.append_template_log(t, str(tmp_path / "log"))
    back = spark.read.json(str(tmp_path / "log"))
    assert back.count() == 2 * t.count() and {r.category for r in back.select("category").distinct().collect()} == {"with_placeholders", "pure_messages"}
    assert isinstance(t.first().ArrivalDate, datetime)
