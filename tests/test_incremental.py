import random
import re
from datetime import date, datetime, timedelta
from pathlib import Path

from pyspark.sql import functions as F

from smslens.operators import profiles, similarity
from smslens.sources import lake
from tests import plain

ROWS = 40


def day_lake(spark, root, days=30):
    rows = [(f"573{p:04d}", f"m{d}-{p}", 3, datetime(2024, 1, 1) + timedelta(days=d, hours=p % 24), 2024, 1, 1 + d) for d in range(days) for p in range(ROWS)]
    schema = "PhoneNumber string, Message string, StatusId int, ArrivalDate timestamp_ntz, year int, month int, day int"
    spark.createDataFrame(rows, schema).repartition("day").sortWithinPartitions("PhoneNumber").write.partitionBy("year", "month", "day").parquet(root)
    return rows


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df):
    """Files that the scan of a plan without exchanges opened."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_lake_scan_prunes_without_reading_footers(spark, tmp_path):
    rows = day_lake(spark, str(tmp_path / "lake"))
    table = lake.open_lake(spark, str(tmp_path / "lake"))
    assert "ClientName" in table.columns and table.where("ClientName is not null").count() == 0  # a column that no file has
    phones = spark.createDataFrame([(f"573{p:04d}",) for p in (3, 9, 9)] + [(None,), ("999",)], "phone_number string")
    want = sorted((r[0], r[1]) for r in rows if r[0] in ("5730003", "5730009") and r[3] >= datetime(2024, 1, 21))
    scans = {
        "listed": lake.scan_messages(table, phones, date(2024, 1, 31), 10),
        "broadcast": lake.scan_messages(table, phones, date(2024, 1, 31), 10, listed_phones=0),
        "shuffled": lake.scan_messages(table, phones, date(2024, 1, 31), 10, listed_phones=0, max_rows=None),
    }
    for name, scan in scans.items():
        assert sorted((r.PhoneNumber, r.Message) for r in scan.collect()) == want
        filters = plan_of(scan).split("PartitionFilters: [")[1].split("]")[0]
        assert "year" in filters and "month" in filters and "day" in filters, name
    assert files_read(lake.scan_messages(table, phones, date(2024, 1, 31), 10)) == 10
    assert re.search(r"PhoneNumber#\d+ IN \(", plan_of(scans["listed"])) and re.search(r"PhoneNumber#\d+ >= 5730003", plan_of(scans["shuffled"]))


def test_bloom_filter_of_the_phones(spark, tmp_path):
    day_lake(spark, str(tmp_path / "lake"), 3)
    spark.createDataFrame([(f"573{p:04d}", p) for p in range(ROWS)], "phone_number string, kind int").write.parquet(str(tmp_path / "phones"))
    phones = spark.read.parquet(str(tmp_path / "phones")).where("kind in (3, 9)")
    keys = ["enabled", "applicationSideScanSizeThreshold", "creationSideThreshold"]
    before = {k: spark.conf.get(f"spark.sql.optimizer.runtime.bloomFilter.{k}") for k in keys}
    try:
        lake.runtime_filters(spark, "0b", "10g")
        scan = lake.scan_messages(lake.open_lake(spark, str(tmp_path / "lake")), phones, date(2024, 1, 31), 40, listed_phones=0, max_rows=None)
        assert scan.count() == 6 and "might_contain" in plan_of(scan)
    finally:
        for k, v in before.items():
            spark.conf.set(f"spark.sql.optimizer.runtime.bloomFilter.{k}", v)


def test_components_from_day_to_day(spark):
    rnd = random.Random(6)
    days = [[(rnd.randrange(400), rnd.randrange(400)) for _ in range(60)] for _ in range(3)]
    days[1] += [(500 + i, 500) for i in range(300)] + [(7, None), (None, 7), (9, 9)]
    days[2] += [(3, 800), (800, 801), (650, 3)]
    frame = lambda links: spark.createDataFrame(links, "src bigint, dst bigint")
    labels = similarity.connected_components(frame(days[0]))
    for day in (1, 2):
        labels = similarity.update_components(labels, frame(days[day]))
    got = [(r.id, r.component) for r in labels.collect()]
    links = [(a, b) for d in days for a, b in d if a is not None and b is not None and a != b]
    first = {i: c for i, c in plain.components(links).items()}
    assert len(got) == len(set(got)) and dict(got) == first
    assert {(r.id, r.component) for r in similarity.update_components(labels, frame([])).collect()} == set(got)


def profile(spark, rows):
    return spark.createDataFrame(rows, "phone_number string, template_id string, sender string, appearances bigint, first_day date, last_day date")


def test_profile_snapshot_rewrites_touched_ranges_only(spark, tmp_path):
    path = str(tmp_path / "snapshot")
    old = [(f"p{i}", f"t{i % 3}", None if i % 2 else "s", 2, date(2024, 1, 1), date(2024, 1, 5)) for i in range(200)]
    profiles.write_profiles(profile(spark, old), path, 16)
    files = lambda: {str(f): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    before = files()
    new = [("p1", "t1", None, 1, date(2024, 2, 1), date(2024, 2, 1)), ("p1", "t9", "s", 4, date(2024, 2, 1), date(2024, 2, 2)), ("zz", "t1", "s", 1, date(2024, 2, 1), date(2024, 2, 1))]
    touched = profiles.update_profiles(spark, path, profile(spark, new), str(tmp_path / "work"), 16)
    after = files()
    assert 1 <= len(touched) <= 2
    kept = {f for f in before if not any(f"phone_range={t}/" in f for t in touched)}
    assert kept and {f: after.get(f) for f in kept} == {f: before[f] for f in kept}
    want = profiles.merge_profiles(profile(spark, old), profile(spark, new))
    columns = ["phone_number", "template_id", "sender", "appearances", "first_day", "last_day"]
    rows = lambda df: sorted(map(str, df.select(*columns).collect()))
    assert rows(profiles.read_profiles(spark, path)) == rows(want)
    assert profiles.update_profiles(spark, path, profile(spark, []), str(tmp_path / "none"), 16) == []
    assert rows(profiles.read_profiles(spark, path)) == rows(want)
