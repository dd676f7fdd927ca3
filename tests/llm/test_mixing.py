import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from smslens.llm.mixing import fill_budget, mix_sources

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def reachable(sizes):
    """All sums of a subset, by plain sets."""
    sums = {0}
    for s in sizes:
        sums |= {x + s for x in sums}
    return sums


def plain_targets(sizes, weights=(5, 2, 1), share=1.5, most=2):
    """Targets by going round and round with the excess."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        left = budget - sum(fixed.values())
        rate = left / sum(weight[s] for s in free) if free else 0
        over = [s for s in free if weight[s] * rate > most * sizes[s]]
        if not over:
            return fixed | {s: weight[s] * rate for s in free}
        fixed |= {s: float(most * sizes[s]) for s in over}


def holds(rows, result):
    """The contract, from the plain rows."""
    size = lambda t: len(WORD.findall(t or ""))
    assert Counter((r[0], size(r[1])) for r in rows) == Counter((r.doc_id, r["size"]) for r in result)
    sizes = defaultdict(int)
    each = defaultdict(list)
    for r in rows:
        sizes[r[3]] += size(r[1])
        each[r[3]].append(size(r[1]))
    goal = plain_targets(sizes)
    taken = defaultdict(int)
    for r in result:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(goal[r.source])
        assert r["size"] * 2 >= r.taken >= 0 and r.taken == r["size"] * r.copies
        taken[r.source] += r.taken
    for s, target in goal.items():
        whole = min(2, int(target // sizes[s])) * sizes[s] if sizes[s] else 0
        wanted = round(target) - whole
        best = min(abs(x - wanted) for x in reachable(each[s])) if wanted > 0 else 0
        assert abs(taken[s] - round(target)) == best


def texts(counts, source, first=0):
    return [(first + i, "w " * n, "en", source) for i, n in enumerate(counts)]


def test_targets_are_met_as_near_as_documents_allow(make):
    rng = np.random.default_rng(1)
    rows = texts(rng.integers(0, 40, 60), "b") + texts([7, 7, 7, 700], "a", 100) + texts(rng.integers(1, 9, 90), None, 200) + texts([3], "", 400)
    result = mix_sources(make(rows)).collect()
    holds(rows, result)
    assert sorted(map(str, result)) == sorted(map(str, mix_sources(make(rows[::-1])).repartition(3).collect()))


def test_null_texts_ids_and_repeated_rows(make):
    rows = [(None, "a b", "en", "x")] * 7 + [(1, None, "en", "x"), (1, "", "en", "x"), (2, " \t\x0b", "en", None), (3, "a b \x85", "en", None)] + [(4, "a b c", "en", "y")] * 2500
    holds(rows, mix_sources(make(rows, extra=("taken", "target", "length", "m", "n", "cell"))).collect())


def test_empty_tables_and_tables_without_words(make):
    assert mix_sources(make([])).count() == 0
    result = mix_sources(make([(1, "", "en", "a"), (2, None, "en", "b")])).collect()
    assert [(r.taken, r.target, r.source_size) for r in result] == [(0, 0.0, 0)] * 2


def test_a_hot_length_is_dealt_over_cells(make):
    rows = texts([5] * 3000, "hot") + texts([5] * 40, "cold", 5000)
    holds(rows, mix_sources(make(rows)).collect())


def test_the_seed_decides_which_documents(make):
    rows = texts([5] * 300, "a") + texts([5] * 900, "b", 1000)
    taken = [{r.doc_id for r in mix_sources(make(rows), seed=s).collect() if r.source == "b" and r.copies > 1} for s in (1, 2, 1)]
    assert taken[0] == taken[2] != taken[1]


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(0, 60), st.integers(1, 4), min_size=1, max_size=6), st.integers(0, 400))
def test_fill_budget_is_as_near_as_any_subset(counts, budget):
    length, n = np.array(sorted(counts)), np.array([counts[k] for k in sorted(counts)])
    take = fill_budget(length, n, budget)
    assert (take >= 0).all() and (take <= n).all()
    sizes = [k for k, c in counts.items() for _ in range(c)]
    wanted = min(budget, sum(sizes))
    # the proportional share comes first, so only what is left has to be met as near as its documents allow
    total = int(length @ n)
    base = np.array([c * wanted // total if k else 0 for k, c in zip(length.tolist(), n.tolist())]) if total else n * 0
    rest = reachable([k for k, c, b in zip(length.tolist(), n.tolist(), base.tolist()) for _ in range(c - b)])
    assert abs(int(length @ take) - wanted) == min(abs(wanted - int(length @ base) - x) for x in rest)


def test_large_budgets_and_long_documents():
    rng = np.random.default_rng(2)
    length = np.unique(rng.integers(1, 20_000, 4_000))
    n = rng.integers(1, 50, len(length))
    assert int(length @ fill_budget(length, n, int(length @ n) // 3)) == int(length @ n) // 3
    length, n = np.array([5_000_000, 7_000_000, 9_000_001]), np.array([3, 3, 3])
    assert abs(int(length @ fill_budget(length, n, 21_000_000)) - 21_000_000) <= 100
