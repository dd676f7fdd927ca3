import random
import re
from collections import defaultdict

import numpy as np
import regex
import xxhash
from pyspark.sql import functions as F

from smslens.llm import common, line_dedup
from smslens.llm.queries import LLM_QUERIES


def normal(line):
    return regex.sub(r"[^\p{L}\p{N}]+", " ", line.lower()).strip(" ")


def sim_hash(norm):
    words = set(norm.split(" "))
    hashes = np.array([xxhash.xxh64(w.encode(), seed=42).intdigest() for w in words], np.uint64)
    return sum(1 << k for k in range(64) if 2 * int(((hashes >> np.uint64(k)) & np.uint64(1)).sum()) > len(words))


def distance(a, b):
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain(rows):
    """doc_id -> (n_lines, n_removed, text), by comparing every pair of distinct lines; ids are unique."""
    first = {}
    for doc_id, text in sorted(rows):
        for pos, line in enumerate((text or "").split("\n")):
            norm = normal(line)
            if norm.count(" ") >= 4:
                first.setdefault(norm, (doc_id, pos))
    norms = list(first)
    hashes = np.array([sim_hash(n) for n in norms], np.uint64)
    parent = list(range(len(norms)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    linked = 0
    for i in range(len(norms)):
        apart = np.bitwise_count(hashes[:i] ^ hashes[i])
        for j in np.flatnonzero(apart <= 3):
            longest = max(len(norms[i]), len(norms[j]))
            if distance(norms[i], norms[j]) <= int(longest * 0.2 + 1e-9):
                linked += 1
                parent[root(i)] = root(int(j))
    keep = defaultdict(lambda: (1 << 70, 0))
    for i, n in enumerate(norms):
        keep[root(i)] = min(keep[root(i)], first[n])
    stays = {n: keep[root(i)] for i, n in enumerate(norms)}
    out = {}
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        left = [x for pos, x in enumerate(lines) if stays.get(normal(x), (doc_id, pos)) == (doc_id, pos)]
        out[doc_id] = (len(lines), len(lines) - len(left), "\n".join(left))
    return out, linked


def check(rows, got):
    want, linked = plain(rows)
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in got} == want
    return linked


def test_lines_match_comparing_all_pairs(make):
    rng = random.Random(5)
    vocabulary = [f"word{i}" for i in range(300)]
    rows = [(0, None), (1, ""), (2, "one two three four\none two three four"), (3, "Déjà vu, said the cat!\n\ndéjà VU said... the cat")]
    bases = [rng.choices(vocabulary, k=k) for k in (6, 12, 30, 150)]
    for i in range(4, 60):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            words = list(rng.choice(bases))
            if rng.random() < 0.8:
                words[rng.randrange(len(words))] = rng.choice(["cat", "dog", *vocabulary])
            lines.append(" ".join(words))
        rows.append((i, "\n".join(lines)))
    got = line_dedup.dedup_lines(make(rows, ["norm", "node", "pos"])).collect()
    assert check(rows, got) > 20


def test_query_matches_comparing_all_pairs(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").where("doc_id < 60").collect()]
    docs = spark.read.parquet(f"{data}/documents.parquet").where("doc_id < 60")
    check(rows, line_dedup.dedup_lines(docs).collect())
    assert LLM_QUERIES["op1_simhash_lines"](spark, data).count() == 200


def test_line_edges(make):
    assert line_dedup.dedup_lines(make([])).count() == 0
    line = "the same five words here"
    rows = [(None, line), (4, line), (4, line), (5, line + "\n \n" + line), (6, "a b\n" + line)]
    got = sorted(((r.doc_id or 99, r.n_removed, r.text, r.emptied) for r in line_dedup.dedup_lines(make(rows)).collect()))
    assert got == [(4, 0, line, False), (4, 0, line, False), (5, 2, " ", True), (6, 1, "a b", False), (99, 1, "", True)]
    long = " ".join(f"w{i}" for i in range(8_000))
    got = line_dedup.dedup_lines(make([(1, long), (2, long + " x"), (3, long.replace("w4000 ", "z "))])).collect()
    assert sorted((r.doc_id, r.n_removed) for r in got) == [(1, 0), (2, 1), (3, 1)]
    hot = [(i, "hot line of five words\nonly number %d of the lines" % i) for i in range(200)]
    got = line_dedup.dedup_lines(make(hot)).collect()
    assert sum(r.n_removed for r in got) >= 199 and sum("hot line" in r.text for r in got) == 1


def test_marks_tabs_and_scripts_without_spaces(make):
    same = ["Five words\tstand in here", "five words stand, in here.", "five  words stand in here\r", "FIVE-words (stand) in here"]
    table = "a1\tb2\tc3\td4\te5"
    han, code = "我们今天去公园，天气很好。", "aGVsbG8gd29ybGQgYWdhaW4gYW5k"
    rows = [(i, line) for i, line in enumerate([*same, table, table, han, han, code, code, "短い", "短い", "just four words here", "just four words here"])]
    got = {r.doc_id: r.n_removed for r in line_dedup.dedup_lines(make(rows)).collect()}
    assert [got[i] for i in range(len(rows))] == [0, 1, 1, 1, 0, 1, 0, 1, 0, 1, 0, 0, 0, 0]


def test_hashes_shuffle_no_text_and_long_lines_count_bit_by_bit(make, monkeypatch):
    rng = random.Random(8)
    rows = [(i, "\n".join(" ".join(rng.choices([f"w{k}" for k in range(90)], k=k)) for k in (5, 40, 300))) for i in range(4)]
    read = lambda: line_dedup.hashed_lines(line_dedup.keyed(make(rows), "doc_id", "text"))
    plan = read()._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 1 and "norm#" not in dealt[0] and "text#" not in dealt[0]
    want = sorted(sim_hash(normal(line)) for _, text in rows for line in text.split("\n"))
    hashes = lambda: sorted(r.simhash % (1 << 64) for r in read().collect())
    assert hashes() == want
    monkeypatch.setattr(line_dedup, "LANE_WORDS", 30)
    assert hashes() == want


def test_chance_meetings_are_not_checked(spark):
    rows = [(t, 2 * t + i, (t + 1 << 16) + x) for t in range(500) for i, x in enumerate((0, 0xFF))] + [(999, 5_000 + i, i) for i in range(3)]
    seen = []

    def every(pairs):
        seen.append(pairs.count())
        return pairs

    posted = spark.createDataFrame(rows, "token long, node long, x long")
    _, found = common.group_links(posted, lambda x, y: line_dedup.bits_apart(x, y) <= 3, every)
    assert seen == [2, 0] and {(r.node, r.component) for r in found.collect()} == {(5_000 + i, 5_000) for i in range(3)}


def test_lines_within_three_bits_share_blocks_and_chance_meets_less(spark):
    rng = random.Random(4)
    near = [x := rng.getrandbits(63)] + [x ^ sum(1 << k for k in rng.sample(range(63), 3)) for _ in range(200)]
    keys = [set(r[0]) for r in spark.createDataFrame([(x,) for x in near], "simhash long").select(line_dedup.block_keys()).collect()]
    assert all(keys[0] & k for k in keys)
    chance = spark.createDataFrame([(rng.getrandbits(63),) for _ in range(30_000)], "simhash long")
    met = chance.select(F.explode(line_dedup.block_keys()).alias("token")).groupBy("token").count().where("count > 1").count()
    assert met < 20  # two of five blocks: over a hundred


def test_edit_similarity_decided_early_equals_the_distance(spark):
    rng = random.Random(6)
    vocabulary = [f"w{i}" * rng.randrange(1, 4) for i in range(60)]
    rows = []
    for n in range(160):
        a = rng.choices(vocabulary, k=rng.choice([5, 12, 60, 90]))
        b = list(a)
        for _ in range(rng.choice([1, 2, len(a) // 3, 2 * len(a)])):
            at = rng.randrange(len(b))
            b[at : at + 1] = rng.choice([[rng.choice(vocabulary)], [], [b[at], "new"], [b[at][:-1] + "y"]])
        rows.append((n, 1000 + n, " ".join(a), " ".join(b)))
    got = {r.a for r in line_dedup.edit_similar(spark.createDataFrame(rows, "a long, b long, a_norm string, b_norm string")).collect()}
    assert got == {n for n, _, a, b in rows if distance(a, b) <= int(max(len(a), len(b)) * 0.2 + 1e-9)} and 20 < len(got) < 150


def test_a_text_is_cut_into_lines_once(make):
    """Split inside the function over places, a text would be cut once for each of its lines."""
    lines = [f"line {i} of a text that has very many of them" for i in range(60)]
    same = "the same line stands in both texts here"
    left = line_dedup.drop_repeated_lines(make([(1, same), (2, "\n".join([*lines, same]))]))
    assert not re.search(r"lambdafunction\((get|element_at)?\(?split\(", left._jdf.queryExecution().optimizedPlan().toString())
    got = {r.doc_id: r.text for r in left.select("doc_id", "text").collect()}
    assert got[1] == same and same not in got[2]
