import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from smslens.llm import packing
from smslens.llm.queries import LLM_QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")


def check(rows, got, shards=1):
    """Round trip against the tokenizer on whole texts; rows are (doc_id, text) with unique ids."""
    encode = Tokenizer.from_file(PATH)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == {r[0] for r in rows}
    for doc_id, text in rows:
        ids = np.array([*encode.encode(text or "", add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(pieces[doc_id], key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(ids)
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for members in sequences.values():
        at = 0
        for p in sorted(members, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 2048
    assert sum(sum(p.length for p in m) < 2048 for m in sequences.values()) <= shards


def test_pieces_round_trip(make):
    rows = [(0, None), (1, ""), (2, " \n"), (3, "It's 12 Äpfel x"), (4, "word " * 2047), (5, "word " * 2048), (6, "word other " * 9000), (7, "a\x1cb é <|endoftext|> ''s")]
    rows += [(10 + i, f"topic{i % 9} about things {i % 9} and {i}" * 20) for i in range(120)]
    check(rows, packing.pack_documents(make(rows, ["shard", "ids"]), PATH, shard_rows=40).collect(), 4)


def test_query_round_trip(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, LLM_QUERIES["op3_bm25_packing"](spark, data).collect())


def test_packing_edges(make):
    assert packing.pack_documents(make([]), PATH).count() == 0
    rows = [(None, "some text"), (4, "some text"), (4, "some text")]
    got = packing.pack_documents(make(rows), PATH, with_ids=True).collect()
    assert len(got) == 3 and {tuple(r.ids) for r in got} == {tuple(got[0].ids)} and sorted(r.offset for r in got) == [0, 3, 6]


def test_neighbours_match_plain_bm25():
    rng = np.random.default_rng(1)
    units = [rng.integers(0, 60, rng.integers(5, 40)) for _ in range(30)]
    idf = rng.random(60) + 0.1
    index = packing.InvertedIndex(units, idf, 20.0)
    weight = lambda t, u: idf[t] * (n := (units[u] == t).sum()) * 2.2 / (n + 1.2 * (0.25 + 0.75 * len(units[u]) / 20))
    for seed in range(30):
        query = set(units[seed].tolist())
        unused = np.arange(30) != seed
        score = np.array([sum(weight(t, u) for t in query) if u != seed else 0 for u in range(30)])
        got = index.neighbours(index.scores(seed), unused)
        assert np.allclose(score[got], np.sort(score)[::-1][: len(got)]) and len(got) == (score > 0).sum()


def test_related_documents_share_windows():
    units = [np.array([k] * 400 + [1], np.uint16) for k in (10, 20, 30) for _ in range(5)]
    pieces = packing.pack_shard(list(range(15)), units, np.ones(1 << 16), 401.0)
    first = {p[0] // 5 for p in pieces if p[3] == 0}
    assert len(first) <= 2 and sum(p[2] for p in pieces) == 15 * 401


def test_an_id_counts_once_a_document(spark):
    rows = [np.array(x, "<u2").tobytes() for x in ([5, 5, 7, 1], [5, 1], [9] * 50 + [1])]
    df, n, mean = packing.token_frequencies(spark.createDataFrame([(bytearray(x),) for x in rows], "ids binary"))
    assert [int(df[k]) for k in (1, 5, 7, 9)] == [3, 2, 1, 1] and df.sum() == 7 and n == 3 and mean == 57 / 3
