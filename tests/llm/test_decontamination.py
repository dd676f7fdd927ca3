import random
import re

import pytest

from smslens.llm import decontamination
from smslens.llm.queries import LLM_QUERIES


def tokens(text):
    return re.findall(r"[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())


def tiling(doc, item, least=5):
    """Greedy string tiling by looking at every pair of places, longest match first."""
    used_x, used_y, tiles = [False] * len(doc), [False] * len(item), []
    while True:
        best = (0, 0, 0)
        for i in range(len(doc)):
            for j in range(len(item)):
                k = 0
                while i + k < len(doc) and j + k < len(item) and doc[i + k] == item[j + k] and not used_x[i + k] and not used_y[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        n, i, j = best
        if n < least:
            return tiles
        tiles.append(best)
        used_x[i : i + n] = used_y[j : j + n] = [True] * n


def want(rows, items):
    out = set()
    for doc_id, text in rows:
        for item_id, item in items:
            covered = sum(t[0] for t in tiling(tokens(text), tokens(item)))
            if covered and covered >= 0.5 * len(tokens(item)):
                out.add((doc_id, item_id, covered))
    return out


@pytest.mark.parametrize("index_bytes", [8 << 20, 0])
def test_matches_plain_tiling(spark, make, index_bytes):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(25)]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([4, 6, 14, 20])))) for i in range(12)] + [(90, None), (91, ""), (92, "w1 " * 12)]
    rows = [(0, None), (1, ""), (2, "w1 " * 40), (3, items[3][1].upper().replace(" ", ", "))]
    for i in range(4, 40):
        words = rng.choices(vocabulary, k=20)
        item = rng.choice(items[:12])[1].split()
        half = len(item) // 2
        part = rng.choice([item, item[half:] + item[:half], item[:half], item[: half + 1], item[2:]])
        rows.append((i, " ".join(words[:10] + part + words[10:])))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = decontamination.contaminated(make(rows, ["seed", "row", "item_id"]), benchmark, index_bytes=index_bytes).collect()
    expected = want(rows, items)
    assert len(expected) > 20 and {(r.doc_id, r.item_id, r.covered) for r in got} == expected and len(got) == len(expected)
    assert all(r.coverage == r.covered / r.item_words for r in got)
    left = decontamination.drop_contaminated(make(rows, ["seed"]), benchmark, index_bytes=index_bytes)
    assert {r.doc_id for r in left.collect()} == {r[0] for r in rows} - {e[0] for e in expected} and "seed" in left.columns


@pytest.mark.parametrize("index_bytes", [8 << 20, 0])
def test_rows_are_judged_by_their_own_text(spark, make, index_bytes):
    item, other = "one two three four five six", "a text that no item has in it at all"
    benchmark = spark.createDataFrame([(1, item), (2, "seven eight nine ten eleven twelve")], "item_id long, text string")
    rows = [(4, item), (4, other), (None, item), (None, other), (5, item), (5, item), (6, other), (6, other), (7, None), (8, "")]
    left = decontamination.drop_contaminated(make(rows, ["k1", "k2", "seed", "row"]), benchmark, index_bytes=index_bytes).collect()
    assert sorted((r.doc_id or 0, r.text or "") for r in left) == [(0, other), (4, other), (6, other), (6, other), (7, ""), (8, "")]
    found = decontamination.contaminated(make(rows), benchmark, index_bytes=index_bytes).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in found) == [(0, 1), (4, 1), (5, 1), (5, 1)]


def test_query_finds_exactly_the_documents_with_passages(spark):
    d = "/root/testdata/sf0.01"
    got = {r.doc_id for r in LLM_QUERIES["op6_string_tiling"](spark, d).collect()}
    items = [" ".join(tokens(r.text)) for r in spark.read.parquet(f"{d}/benchmark.parquet").collect()]
    docs = spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "text").collect()
    whole = {r.doc_id for r in docs if any(i in " ".join(tokens(r.text)) for i in items)}
    assert whole and whole <= got and len(got) <= len(whole) + 2


def test_decontamination_edges(spark, make):
    benchmark = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    assert decontamination.contaminated(make([]), benchmark).count() == 0
    assert decontamination.contaminated(make([(1, "one two three four five six")]), benchmark.where("item_id > 5")).count() == 0
    rows = [(None, "one two three four five six"), (4, "one two three four five"), (4, "one two three four five"), (5, "a b " * 200_000 + "two three four five six"), (6, "one two three four x five six")]
    got = decontamination.contaminated(make(rows), benchmark).collect()
    assert sorted((r.doc_id or 0, r.covered) for r in got) == [(0, 6), (4, 5), (4, 5), (5, 5)]
    assert [r.doc_id for r in decontamination.drop_contaminated(make(rows), benchmark).collect()] == [6]
