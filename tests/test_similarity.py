import hashlib
import random

import numpy as np
import pandas as pd
import pytest

from smslens.operators import similarity
from tests import plain


def ident(t):
    return hashlib.md5(t.encode()).hexdigest()[:16]


def test_id_numbers_keep_order(spark):
    ids = sorted([ident(str(i)) for i in range(200)] + ["0" * 16, "f" * 16, "8" + "0" * 15, "7" + "f" * 15])
    df = spark.createDataFrame([(i,) for i in ids], "t string").select("t", similarity.id_number("t").alias("n"))
    rows = df.orderBy("n").select("t", similarity.id_text("n").alias("back")).collect()
    assert [r.t for r in rows] == ids and all(r.t == r.back for r in rows)


def word_case(n=160, seed=3):
    rnd = random.Random(seed)
    texts = {" ".join(rnd.choice("abc") for _ in range(rnd.randint(1, 6))) for _ in range(n)}
    texts |= {f"hola {x} gracias por su compra" for x in "abcdefghij"}  # one group of many
    texts |= {"hola gracias por su compra", "hola a b gracias por su compra", "gracias por su compra", "hola gracias por su compra hoy mismo", "a", "z", "y z"}
    return [(t, rnd.choice(["s1", "s2"])) if not t.startswith("hola") else (t, "s1") for t in sorted(texts)]


def word_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def neighbours(case, most):
    out = {}
    for a, sa in case:
        for b, sb in case:
            wa, wb = a.split(" "), b.split(" ")
            if a != b and sa == sb and word_distance(wa, wb) <= most and set(wa) & set(wb):
                out.setdefault(ident(a), []).append((word_distance(wa, wb), ident(b)))
    return out


def test_near_by_words(spark):
    case = word_case()
    df = spark.createDataFrame([(ident(t), t, s) for t, s in case], "template_id string, template_text string, sender string")
    for most in (1, 2):
        assert any(len(ta.split(" ")) != len(tb.split(" ")) for ta, _ in case for tb, _ in case if (1, ident(tb)) in neighbours(case, 1).get(ident(ta), []))
        got = {r.template_id: (r.words_changed, r.similar_id) for r in similarity.near_by_words(df, most).collect()}
        assert got == {k: min(v) for k, v in neighbours(case, most).items()}


def test_word_clusters(spark):
    case = word_case(60, 8)
    df = spark.createDataFrame([(ident(t), t, s) for t, s in case], "template_id string, template_text string, sender string")
    for most in (1, 2):
        c = similarity.cluster_templates(similarity.word_links(df, most))
        got = {r.a: r.b for r in c.select(similarity.id_text("id").alias("a"), similarity.id_text("component").alias("b")).collect()}
        assert got == plain.components([(a, b) for a, v in neighbours(case, most).items() for _, b in v])


def test_components_with_hub_and_chain(spark):
    links = [(i, 0) for i in range(1, 3000)] + [(i, i + 1) for i in range(5000, 5040)] + [(9001, 9000), (9002, 9001)]
    df = spark.createDataFrame(links, "src bigint, dst bigint")
    got = {r.id: r.component for r in similarity.connected_components(df).collect()}
    assert got == plain.components(links)


def gram_sets(rows):
    out = {}
    for i, t in rows:
        w = " ".join((t or "").lower().split()).split(" ")
        out[i] = frozenset(int(hashlib.md5(" ".join(w[k : k + 3]).encode()).hexdigest()[:15], 16) for k in range(max(1, len(w) - 2)))
    return out


def minima(grams):
    return [min((a * (g % 2**32) + b) % 4294967291 for g in grams) for a, b in similarity.minhash_factors(32)]


def jaccard(x, y):
    return len(x & y) / len(x | y)


def minhash_case():
    rnd = random.Random(1)
    base = [" ".join(rnd.choice("abcdefghijklmnop") * 3 for _ in range(40)) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[3]) for i in range(400)]  # most rows are copies of one text
    for i, at in enumerate([39, 0, 20, 5]):  # a chain of small changes
        words = rows[5][1].split(" ") if not i else rows[-1][1].split(" ")
        words[at] = "changed"
        rows.append((900 + i, " ".join(words)))
    return rows + [(950, "short"), (951, "SHORT "), (952, ""), (953, None)]


def test_minhash_links_are_verified(spark):
    rows = minhash_case()
    df = spark.createDataFrame([*rows, (None, "short")], "id bigint, t string")
    sets = gram_sets(rows)
    sig = {i: minima(s) for i, s in sets.items()}
    bucket = {i: [(b, *sig[i][b * 4 : b * 4 + 4]) for b in range(8)] for i in sig}
    least = {}
    for i in sorted(bucket, reverse=True):
        least.update({k: i for k in bucket[i]})
    want = {}
    for i, keys in bucket.items():
        for head in {least[k] for k in keys} - {i}:
            if jaccard(sets[i], sets[head]) >= 0.8:
                want[i, head] = (sum(least[k] == head for k in keys), jaccard(sets[i], sets[head]))
    got = {(r.src, r.dst): (r.bands, r.similarity) for r in similarity.minhash_links(df, "id", "t").collect()}
    assert got == want and (951, 950) in got and (103, 3) in got


def test_minhash_clusters_equal_all_verified_pairs(spark):
    rows = [r for r in minhash_case() if not 120 <= r[0] < 900]
    sets = gram_sets(rows)
    sig = {i: minima(s) for i, s in sets.items()}
    share = lambda i, j: any(sig[i][b * 4 : b * 4 + 4] == sig[j][b * 4 : b * 4 + 4] for b in range(8))
    for floor in (0.8, 0.6):
        pairs = [(i, j) for i in sets for j in sets if j < i and share(i, j) and jaccard(sets[i], sets[j]) >= floor]
        got = similarity.minhash_clusters(spark.createDataFrame(rows, "id bigint, t string"), "id", "t", min_similarity=floor)
        assert {r.id: r.component for r in got.collect()} == plain.components(pairs)
    assert similarity.minhash_clusters(spark.createDataFrame([], "id bigint, t string"), "id", "t").count() == 0


def vector_case(n, dims, seed):
    """Planted groups around random directions, copies of one vector, and rows that have to be left out."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(n // 20, dims))
    rows = [(i, (centre[i % len(centre)] + rng.normal(size=dims) * rng.choice([0.1, 0.4, 2.0])).tolist()) for i in range(n)]
    rows += [(10 * n + i, [x * 2 for x in rows[4][1]]) for i in range(60)]
    return rows, [(20 * n, None), (20 * n + 1, [0.0] * dims), (20 * n + 2, [float("nan")] * dims), (None, [1.0] * dims)]


@pytest.mark.parametrize(("n", "cell_rows", "cosine"), [(300, 1_000, 0.8), (1_500, 60, 0.8), (300, 50, 0.3)])
def test_embedding_links_equal_brute_force(spark, monkeypatch, n, cell_rows, cosine):
    monkeypatch.setattr(similarity, "CELL_ROWS", cell_rows)
    rows, odd = vector_case(n, 16, n)
    links = similarity.embedding_links(spark.createDataFrame(rows + odd, "id bigint, v array<double>"), "id", "v", cosine)
    rows_got = links.collect()
    got = {(r.src, r.dst): r.cosine for r in rows_got}
    assert len(got) == len(rows_got)
    copies = {(i, 4) for i, _ in rows if i >= 10 * n}
    x = np.array([v for _, v in rows[:n]])
    x /= np.linalg.norm(x, axis=1)[:, None]
    a, b = np.nonzero(np.tril(x @ x.T, -1) >= cosine)
    want = {(int(i), int(j)) for i, j in zip(a, b)}
    assert len(want) > 100 and set(got) == want | copies
    assert all(abs(got[k] - x[k[0]] @ x[k[1]]) < 1e-9 for k in want)


def test_embedding_links_of_few_rows(spark):
    for rows in ([], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [2.0, 4.0])]):
        links = similarity.embedding_links(spark.createDataFrame(rows, "id bigint, v array<double>"), "id", "v")
        assert [(r.src, r.dst) for r in links.collect()] == ([(2, 1)] if len(rows) == 2 else [])


def test_components_of_a_long_chain_take_few_small_steps(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(similarity, "_checkpointed", lambda df: plans.append(df) or df.checkpoint())
    similarity.shared_folder(spark)
    chain = [(i, i + 1) for i in range(1, 400)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7_000, 7_000), (None, 3), (9_000, None)]
    got = {r.id: r.component for r in similarity.connected_components(spark.createDataFrame(chain, "src bigint, dst bigint")).collect()}
    assert got == {**{i: 1 for i in range(1, 401)}, **{1000 + i: 1000 for i in range(200)}, 7_000: 7_000}
    text = [df._jdf.queryExecution().executedPlan().toString() for df in plans]
    assert len(plans) < 24 and not any("BroadcastHashJoin" in t for t in text)  # nothing is kept in the driver's memory


def test_visits_are_handed_over_in_bounded_frames():
    """Vectors without clusters visit all cells below their own: 1,000 rows by 400 cells must not be one frame."""
    rng = np.random.default_rng(1)
    unit = lambda n: (lambda x: x / np.linalg.norm(x, axis=1)[:, None])(rng.normal(size=(n, 8)))
    centres, v = unit(400), unit(1_000)
    homes = pd.concat(similarity._homes(iter([pd.DataFrame({"id": range(1_000), "v": list(v)})]), centres))
    assert homes["cell"].tolist() == np.argmax(v @ centres.T, 1).tolist()
    frames = list(similarity._visits(iter([homes]), centres, np.full(400, np.pi)))
    assert max(map(len, frames)) <= similarity.VISIT_ROWS
    got = pd.concat(frames)
    assert sorted(zip(got["id"], got["cell"])) == [(i, c) for i, home in enumerate(homes["cell"]) for c in range(home)]


@pytest.mark.parametrize("sent_bytes", [60 * 128, 1_000 * 128])
def test_embedding_links_write_no_visits(spark, monkeypatch, sent_bytes):
    """Vectors without clusters visit nearly all cells: what is stored has to follow the vectors and the links, in blocks as in one."""
    stored = []
    keep = similarity._checkpointed
    monkeypatch.setattr(similarity, "_checkpointed", lambda df: stored.append(keep(df)) or stored[-1])
    monkeypatch.setattr(similarity, "SENT_BYTES", sent_bytes)
    monkeypatch.setattr(similarity, "CELL_ROWS", 7)
    x = np.random.default_rng(3).normal(size=(700, 16))
    x[:200] = x[0] + 0.01 * x[:200]  # a cell larger than a block
    links = similarity.embedding_links(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id bigint, v array<double>"), "id", "v", 0.5).collect()
    x /= np.linalg.norm(x, axis=1)[:, None]
    a, b = np.nonzero(np.tril(x @ x.T, -1) >= 0.5)
    assert len(links) == len(a) and {(r.src, r.dst) for r in links} == set(zip(a.tolist(), b.tolist()))
    assert sum(df.count() for df in stored if "v" in df.columns) <= 2 * len(x)
