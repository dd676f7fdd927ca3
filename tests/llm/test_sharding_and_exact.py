import hashlib
import re
import zlib
from collections import defaultdict

import pandas as pd
import pytest

from smslens.llm import exact_dedup, sharding
from smslens.llm.queries import LLM_QUERIES


def equal_groups(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(r"[ \t\n\v\f\r]", "", text or "")].append((-len(text or ""), doc_id is None, doc_id or 0))
    return groups


def check_groups(rows, got):
    groups = equal_groups(rows)
    assert len(got) == len(rows)
    by_sha = defaultdict(list)
    for r in got:
        by_sha[r.text_sha256].append(r)
    assert len(by_sha) == len(groups)
    for normal, members in groups.items():
        mine = by_sha[hashlib.sha256(normal.encode()).hexdigest()]
        best = min(members)
        assert {r.group_size for r in mine} == {len(members)} and len(mine) == len(members)
        assert {r.keep_id for r in mine} == {None if best[1] else best[2]}
        assert [r.doc_id for r in mine if r.kept] == [None if best[1] else best[2]]


@pytest.mark.parametrize("limit", [16 << 20, 200, 30])
def test_exact_groups_match_plain_grouping(make, limit):
    rows = [(i, "same text here") for i in range(60)] + [(100 + i, f"text {i % 7}") for i in range(30)] + [(200, None), (201, ""), (202, " \n\t")]
    rows += [(300, "a b"), (301, "ab  "), (None, "ab"), (None, "only me"), (400, "twice"), (400, "twice"), (401, "ä b c"), (402, "äb c"), (403, "x" * 5000)]
    got = exact_dedup.exact_groups(make(rows, ["h", "row", "content"]), limit=limit).collect()
    check_groups(rows, got)


def test_exact_groups_on_documents_and_empty(spark, data, make):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    check_groups(rows, LLM_QUERIES["op7_grace_dedup"](spark, data).collect())
    assert exact_dedup.exact_groups(make([])).count() == 0
    stays = exact_dedup.drop_exact_copies(make([(1, "a"), (2, "a"), (3, "b")])).orderBy("doc_id")
    assert [r.doc_id for r in stays.collect()] == [1, 3]


def test_hot_empty_texts_are_dealt_out(make, monkeypatch):
    whole = exact_dedup.table_pass

    def small(pdf):
        assert len(pdf) <= 200
        return whole(pdf)

    monkeypatch.setattr(exact_dedup, "table_pass", small)
    rows = [(i, ["", " \t", None][i % 3]) for i in range(1500)] + [(None, "")] * 1500 + [(2000, "other")]
    got = exact_dedup.exact_groups(make(rows), limit=16 << 10).collect()
    assert len(got) == len(rows) and [r.doc_id for r in got if r.kept and r.doc_id != 2000] == [1]
    assert {(r.keep_id, r.group_size) for r in got if r.doc_id != 2000} == {(1, 3000)}


def test_tables_stay_small_where_texts_are_longer_than_the_limit(make, monkeypatch):
    whole = exact_dedup.table_pass

    def small(pdf):
        assert len(pdf) <= 40  # eight on average
        return whole(pdf)

    monkeypatch.setattr(exact_dedup, "table_pass", small)
    rows = [(i, f"{'long' if i % 3 else 'other'} " * 400 + " " * (i == 77)) for i in range(300)]
    got = exact_dedup.exact_groups(make(rows), limit=500).collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(0, 100), (77, 200)} and sum(r.kept for r in got) == 2


def test_many_contents_of_one_hash_end(spark):
    rows = [(f"r{i:03}", i, 5, 4, 1, f"t{i % 40:03}".encode()) for i in range(120)]
    records = spark.createDataFrame(rows, "row string, doc_id long, h long, length long, weight long, content binary")
    sizes = spark.createDataFrame([(5, 120, 120 * 260)], "h long, n long, bytes long")
    got = exact_dedup.settle(records, sizes, 300, together=2).select("row", "doc_id", "keep_id", "weight").collect()
    assert len(got) == 120 and all(r.keep_id == r.doc_id % 40 and r.weight == 3 for r in got)


def test_equal_hashes_are_told_apart_by_content():
    table = exact_dedup.OpenTable(4)
    assert [table.number(7, c) for c in (b"a", b"b", b"a", b"b", b"c")] == [0, 1, 0, 1, 2]
    pdf = pd.DataFrame({"row": list("pqr"), "doc_id": [3, 1, 2], "h": [5, 5, 5], "length": [1, 1, 1], "weight": [1, 1, 1], "content": [b"x", b"y", b"x"], "parts": 1})
    assert exact_dedup.table_pass(pdf)["keep_id"].tolist() == [2, 1, 2]


def test_shards_match_sorting_by_fractional_rank(spark, make, monkeypatch):
    monkeypatch.setattr(sharding, "CELL_ROWS", 50)
    rows = [(i, f"text {i}", "en", "hot" if i % 3 == 0 else f"s{i % 11}") for i in range(900)] + [(1000, None, None, None), (1001, "", "en", None)]
    got = sharding.interleave_shards(make(rows, ["cell", "rank"]), 40).collect()
    assert len(got) == len(rows)
    by_rank = sorted(got, key=lambda r: r.rank)
    assert [r.rank for r in by_rank] == list(range(len(rows)))
    total = defaultdict(int)
    for r in got:
        total[r.source] += 1
    for source, n in total.items():  # every run of the order holds a source's share, give or take one step
        at = [r.rank for r in by_rank if r.source == source]
        assert all(abs((k + 0.5) / n - (x + 0.5) / len(rows)) < 1 / n + len(total) / len(rows) for k, x in enumerate(at))
    check_shards(got, rows, 40)
    for shard in range(40):  # the mixture: within one row of each source's share, give or take the cut
        hot = sum(r.source == "hot" for r in got if r.shard == shard)
        assert abs(hot - 300 / 40) <= 3


def check_shards(got, rows, shards):
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    slots = defaultdict(list)
    for r in got:
        assert r["size"] == len(texts[r.doc_id]) + 16 and r.text_crc32 == zlib.crc32(texts[r.doc_id])
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows) and set(slots) <= set(range(shards))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_sharding_query_and_edges(spark, data, make, tmp_path):
    docs = spark.read.parquet(f"{data}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    check_shards(LLM_QUERIES["op5_interleaved_shards"](spark, data).collect(), rows, 40)
    assert sharding.interleave_shards(make([]), 40).count() == 0
    few = make([(1, "a"), (2, "b"), (3, None)])
    got = sharding.interleave_shards(few, 40)
    check_shards(got.collect(), [(1, "a"), (2, "b"), (3, None)], 40)
    sharding.write_shards(few, got, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == 3
    same = make([(7, "a")] * 100 + [(None, "b")] * 20)
    again = sharding.interleave_shards(same, 8).collect()
    assert sorted(r.rank for r in again) == list(range(120)) and len({(r.shard, r.slot) for r in again}) == 120
