import hashlib
import random

import pytest

from smslens.llm import common, repeats
from smslens.llm.queries import LLM_QUERIES


def plain(rows):
    """doc_id -> (n_bytes, n_removed, n_spans, sha256) by looking up every 100-byte string; ids are unique."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - 99):
            s = data[i : i + 100]
            if s in seen:
                gone[i : i + 100] = b"\1" * 100
            seen.add(s)
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        kept = bytes(b for b, g in zip(data, gone, strict=True) if not g)
        out[doc_id] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def check(rows, got):
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got} == plain(rows)


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_looking_up_every_string(make, seed):
    rng = random.Random(seed)
    noise = lambda k: "".join(rng.choices("abcdefgh é", k=k))
    passages = [noise(k) for k in (99, 100, 101, 130, 180, 400)]
    rows = [(0, None), (1, ""), (2, "ab" * 200), (3, "x" * 99), (4, "x" * 100), (5, "x" * 150), (6, "ab" * 200), (7, "z" + "ab" * 130)]
    for i in range(8, 70):
        parts = [noise(rng.randrange(0, 300)) for _ in range(3)]
        p = rng.choice(passages)
        a = rng.randrange(0, 40)
        parts.insert(rng.randrange(3), rng.choice([p, p[a:], p[: len(p) - a], p + p]))
        rows.append((i, "".join(parts)))
    rows += [(100, rows[20][1]), (101, rows[20][1] + "!"), (102, "?" + rows[20][1])]
    check(rows, repeats.strip_repeats(make(rows, ["row", "range", "phrase"])).collect())


def test_query_matches_looking_up_every_string(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, LLM_QUERIES["op8_prefix_free_parsing"](spark, data).collect())


def test_repeats_edges(make):
    assert repeats.strip_repeats(make([])).count() == 0
    text = "".join(random.Random(4).choices("abcdefgh", k=300))
    got = repeats.strip_repeats(make([(4, text), (4, text), (None, text), (3, "q"), (5, text[:200])]), with_text=True).collect()
    assert sorted((r.doc_id or 99, r.n_removed, len(r.kept)) for r in got) == [(3, 0, 1), (4, 0, 300), (4, 0, 300), (5, 200, 0), (99, 300, 0)]
    long = "".join(random.Random(5).choices("abcdefgh", k=300_000))
    got = repeats.strip_repeats(make([(1, long), (2, long[1000:])])).collect()
    assert sorted((r.n_removed, r.n_spans) for r in got) == [(0, 0), (299_000, 1)]


def test_many_texts_without_id_keep_their_own_ranges(make):
    rng = random.Random(6)
    noise = lambda k: "".join(rng.choices("abcdefgh", k=k))
    passage = noise(150)
    texts = [noise(i) + passage + noise(60) for i in range(100, 1100)]  # the passage's place orders the rows
    seen, gone = set(), [set() for _ in texts]
    for at in range(max(map(len, texts)) - 99):
        for text, lost in zip(texts, gone, strict=True):
            s = text[at : at + 100]
            if len(s) == 100:
                if s in seen:
                    lost.update(range(at, at + 100))
                seen.add(s)
    want = {text: "".join(c for i, c in enumerate(text) if i not in lost) for text, lost in zip(texts, gone, strict=True)}
    got = repeats.strip_repeats(make([(None, text) for text in texts]), with_text=True).collect()
    assert sorted((r.n_bytes, r.n_removed, bytes(r.kept)) for r in got) == sorted((len(t), len(t) - len(k), k.encode()) for t, k in want.items())


def test_repeated_rows_share_one_list_of_ranges(make, monkeypatch):
    text = "".join(random.Random(7).choices("abcdefgh", k=2000))
    rows = [(1, text[500:1500])] + [(None, text)] * 200
    base = make(rows).selectExpr("coalesce(cast(doc_id as long), 9) as doc_id", "xxhash64(text) as row", "text")
    lists = repeats.repeated_ranges(base).groupBy("doc_id", "row").agg({"range": "count"}).collect()
    assert len(lists) == 1  # the copies are one row
    got = repeats.strip_repeats(make(rows)).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans) for r in got) == [(1000, 0, 0)] + [(2000, 1000, 1)] * 200


def test_wide_rows_are_not_broadcast(make, monkeypatch):
    left, right = make([(i, "x") for i in range(40)]), common.stored(make([(i, "y" * 500) for i in range(40)]).withColumnRenamed("text", "wide"))
    plan = lambda: common.attach(left, right, ["doc_id"])._jdf.queryExecution().toString()
    assert "BroadcastHashJoin" in plan()
    monkeypatch.setattr(common, "BROADCAST_BYTES", 10_000)
    assert "BroadcastHashJoin" not in plan() and common.attach(left, right, ["doc_id"]).where("wide is not null").count() == 40
