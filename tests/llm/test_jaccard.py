import random
import re
from collections import defaultdict

import numpy as np
import pytest

from smslens.llm import jaccard
from smslens.llm.queries import LLM_QUERIES


def token_set(text, length=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    if 0 < len(words) < length:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + length]) for i in range(len(words) - length + 1))


def brute(rows, length=3, percent=90):
    sets = [token_set(t, length) for _, t in rows]
    holders = defaultdict(set)
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, s in enumerate(sets):
        near = set().union(*[holders[t] for t in s]) if s else ()
        for j in near:
            common = len(s & sets[j])
            if 100 * common >= percent * (len(s) + len(sets[j]) - common):
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
        for t in s:
            holders[t].add(i)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        least[root(i)] = min(least.get(root(i), doc_id), doc_id)
    return {doc_id: (len(sets[i]), least[root(i)]) for i, (doc_id, _) in enumerate(rows)}


def check(rows, got, length=3, percent=90):
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows, length, percent)


@pytest.mark.parametrize("frequent_from", [2, 16])
def test_components_match_brute_force(make, monkeypatch, frequent_from):
    monkeypatch.setattr(jaccard, "FREQUENT_FROM", frequent_from)
    rng = random.Random(frequent_from)
    vocabulary = [f"w{i}" for i in range(400)]
    line = " ".join(rng.choices(vocabulary, k=12))
    rows = []
    for g in range(14):  # groups of near copies, many edits chained, a line shared by all
        text = rng.choices(vocabulary, k=rng.choice([30, 60, 120]))
        for _ in range(rng.choice([1, 3, 12])):
            if rng.random() < 0.5:
                text = list(text)
                text[rng.randrange(len(text))] = rng.choice(vocabulary)
            rows.append((len(rows) + 1, " ".join(text) + ("\n" + line if g % 2 else "")))
    rows += [(1000, line), (1001, line.upper()), (1002, ""), (1003, None), (1004, "one two"), (1005, "One\ttwo"), (1006, "one"), (1007, "two one")]
    check(rows, jaccard.jaccard_components(make(rows, ["class", "token", "n"])).collect())


def test_exact_threshold_and_chain(make):
    words = [f"t{i}" for i in range(59)]  # 57 shingles; one changed word in the middle: 54 of 60, exactly 0.9
    changed = [*words[:30], "x", *words[31:]]
    further = [*words[:28], "y", *words[29:]]
    rows = [(5, " ".join(words)), (3, " ".join(changed)), (9, " ".join(further)), (2, " ".join(words[:58])), (7, " ".join([*changed[:50], "z", *changed[51:]]))]
    check(rows, jaccard.jaccard_components(make(rows)).collect())


def test_query_matches_brute_force(spark, data):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    check(rows, LLM_QUERIES["op9_multi_order_jaccard"](spark, data).collect())


def test_edges(make):
    assert jaccard.jaccard_components(make([])).count() == 0
    rows = [(4, "a b c d"), (4, "a b c d"), (None, "a b c d"), (None, "q r s"), (6, "a b c e"), (8, None)]
    got = sorted(((r.doc_id, r.component_id, r.n_shingles) for r in jaccard.jaccard_components(make(rows)).collect()), key=str)
    assert got == [(4, 4, 2), (4, 4, 2), (6, 6, 2), (8, 8, 0), (None, 4, 2), (None, None, 1)]
    long = " ".join(f"w{i}" for i in range(30_000))
    kept = jaccard.keep_one_of_each(make([(1, long), (2, long + " w5"), (3, "a b c d e"), (9, "A b c d e"), (10, None)], ["node"]))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 10] and "node" in kept.columns


def test_rows_are_kept_by_id_and_text(make):
    a, b = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    extra = ["__row", "none", "th", "component", "least"]
    keep = lambda rows: sorted(((r.doc_id, r.text) for r in jaccard.keep_one_of_each(make(rows, extra)).collect()), key=str)
    assert keep([(3, a), (5, a), (5, b), (None, a)]) == [(3, a), (5, b)]
    assert keep([(3, a), (3, a), (3, b), (2, b), (2, None), (2, None), (2, "")]) == sorted([(2, ""), (2, None), (2, None), (2, b), (3, a)], key=str)
    assert keep([(None, a), (None, a), (None, b), (-1, b)]) == sorted([(-1, b), (None, a)], key=str)
    assert [t.lower() for _, t in keep([(4, a), (4, a.upper()), (4, a + " ")])] in ([a], [a + " "])
    assert keep([(9, a + " x"), (9, a + " y")])[0][0] == 9


def test_differences_are_not_carried_with_their_tokens(spark):
    """A row of a difference goes to the join once for each of its tokens, so it must not hold the whole difference."""
    schema = "head long, node long, component long, x long, apart long, diff array<long>"
    rows = [(1, 10, 1, 100, 4, [1, 2, 3, 4]), (1, 11, 11, 100, 5, [1, 2, 3, 4, 5]), (1, 12, 12, 100, 40, list(range(4, 44))), (2, 10, 1, 100, 2, [8, 9]), (2, 11, 11, 100, 2, [6, 7])]
    near = spark.createDataFrame(rows, schema)
    got = jaccard.met_by_difference(near, near.drop("diff"), 90)
    assert [(r.a, r.b) for r in got.collect()] == [(10, 11)]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert all("diff" not in line for line in plan.splitlines() if "Join" in line or "Aggregate" in line)
    assert "array_intersect" not in plan


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_linked_sets_share_an_anchor_and_a_run(percent):
    rng = random.Random(percent)
    numbers = lambda tokens: np.array(sorted(tokens), np.uint64)
    length, linked = jaccard.run_length(percent), 0
    for _ in range(400):
        base = {rng.getrandbits(64) for _ in range(rng.choice([length, length + 1, 2 * length, 40, 300]))}
        x, y = set(base), set(base)
        for _ in range(rng.randrange(1, 1 + max(1, len(base) // length))):
            kind = rng.randrange(3)
            (x if kind else y).add(rng.getrandbits(64))
            if kind == 2 and len(y) > 1:
                y.discard(rng.choice(sorted(y)))
        if 100 * len(x & y) < percent * len(x | y):
            continue
        linked += 1
        counts = np.array([len(x), len(y)])
        token = np.r_[numbers(x), numbers(y)]
        anchor, run, valid = jaccard.runs(token, counts, percent)
        cut = lambda v: (set(v[: len(x)][valid[: len(x)]].tolist()), set(v[len(x) :][valid[len(x) :]].tolist()))
        assert set.intersection(*cut(anchor)) and set.intersection(*cut(run))
        found, most = jaccard.anchors(token, counts, percent)
        assert (set(found[: most[0]].tolist()), set(found[most[0] :].tolist())) == cut(anchor)
    assert linked > 50


def test_sets_that_only_share_a_passage_are_not_paired_up(make, monkeypatch):
    """Texts with half of their words in common are no candidates: pairs looked at grow with the rows, not with their square."""
    looked_at = []
    held = jaccard.held

    def counted(pairs, *args):
        looked_at.append(pairs.count())
        return held(pairs, *args)

    monkeypatch.setattr(jaccard, "held", counted)
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(30)]
    rows = [(i, " ".join([*passage, *[f"w{rng.randrange(10**9)}" for _ in range(30)]])) for i in range(150)]
    rows += [(200, rows[4][1] + " x"), (201, rows[9][1] + " y z")]
    check(rows, jaccard.jaccard_components(make(rows)).collect())
    assert sum(looked_at) < 10 * len(rows)


def test_sketches_bound_the_difference_from_below(spark):
    rng = random.Random(2)
    rows, want = [], []
    for n in (1, 3, 40, 200, 900):
        for share in (0.5, 0.9, 1.0):
            x = {rng.getrandbits(64) for _ in range(n)}
            y = {t for t in x if rng.random() < share} | {rng.getrandbits(64) for _ in range(int(n * (1 - share) * rng.choice([0, 1, 2])) + 1)}
            token = np.r_[np.array(sorted(x), np.uint64), np.array(sorted(y), np.uint64)]
            bits, many = jaccard.sketches(token, np.array([len(x), len(y)]))
            assert many.sum() == len(bits) and all(64 * m >= 2 * k and m & (m - 1) == 0 for m, k in zip(many.tolist(), (len(x), len(y))))
            rows.append((len(rows), *[[int(w) for w in jaccard.signed(p)] for p in np.split(bits, [many[0]])]))
            want.append(len(x ^ y))
    got = dict(spark.createDataFrame(rows, "i long, x array<long>, y array<long>").select("i", jaccard.surely_apart("x", "y")).collect())
    assert all(w / 3 - 3 <= got[i] <= w for i, w in enumerate(want)) and len({len(r[1]) - len(r[2]) for r in rows}) > 2
    bits, many = jaccard.sketches(np.array([5, 9], np.uint64), np.array([0, 2, 0]))
    assert many.tolist() == [0, 1, 0] and bits.tolist() == [(1 << 5) | (1 << 9)]


def difference_case(copies, words, edits, seed):
    """Copies of one text, each with edits of its own, and a few that repeat the edits of another."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    edited = lambda text, n: [f"e{rng.randrange(10**9)}" if i in at else w for at in [set(rng.sample(range(words), n))] for i, w in enumerate(text)]
    rows = [(0, " ".join(base))]
    for i in range(copies):
        text = edited(base, edits)
        rows += [(10 * i + 1, " ".join(text)), *([(10 * i + 2, " ".join(edited(text, 1)))] if i % 10 == 0 else [])]
    return rows


def test_copies_with_edits_of_their_own_do_not_meet(make, monkeypatch):
    """Differences from the head that only have what the head lost in common are too unlike: rows that meet do not grow with the square of the group."""
    met, stored = [], jaccard.stored

    def kept(df):
        out = stored(df)
        if "node2" in out.columns:
            met.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "stored", kept)
    rows = difference_case(60, 150, 6, 5)
    check(rows, jaccard.jaccard_components(make(rows)).collect())
    assert met and sum(met) <= 40


def test_pairs_that_sketches_settle_are_not_looked_up(make, monkeypatch):
    """Texts with the same start and different ends share runs; their sketches tell them apart without the texts."""
    looked = []
    attach = jaccard.attach

    def counted(left, right, keys, *args):
        if keys == ["doc_id", "th"]:
            looked.append(right.count())
        return attach(left, right, keys, *args)

    monkeypatch.setattr(jaccard, "attach", counted)
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(60)]
    rows = [(i, " ".join([*passage, *[f"w{rng.randrange(10**9)}" for _ in range(60)]])) for i in range(80)]
    rows += [(200, rows[4][1] + " x"), (201, rows[9][1] + " y z")]
    check(rows, jaccard.jaccard_components(make(rows)).collect())
    assert looked[0] < 12
