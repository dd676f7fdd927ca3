import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from smslens.llm import alignment
from smslens.llm.alignment import CSR, Tokenizers, Units, align_documents, pair_counts, product, row_blocks, text_totals, transpose

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "n_shared"]


@pytest.fixture(scope="module")
def tokenizers():
    return Tokenizers(A, B)


def whole(tokenizers, text):
    """Spans of both tokenizers' tokens of a whole text, (id, start, end), or none."""
    from tokenizers.decoders import ByteLevel

    if not text:
        return [], []
    data = (" " + text).encode()
    out = []
    for ids, of in (
        (tokenizers.a.encode(" " + text, add_special_tokens=False).ids, lambda i: tokenizers.bytes_a[i]),
        (tokenizers.b.encode(text), lambda i: tokenizers.bytes_b[i]),
    ):
        at, spans = 0, []
        for i in ids:
            spans.append((i, at, at + len(of(i))))
            at = spans[-1][2]
        if b"".join(of(i) for i in ids) != data:
            return [], []
        out.append(spans)
    assert ByteLevel().decode([tokenizers.a.id_to_token(i) for i, _, _ in out[0]]) == " " + text
    return out


def plain(tokenizers, texts):
    """The definition, token against token."""
    spans = [whole(tokenizers, t) for t in texts]
    links = [[(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]] for a, b in spans]
    count = Counter(k for of in links for k in of)
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    out = []
    for (a, b), of in zip(spans, links, strict=True):
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        groups = [([x[0] for x in a if lo < x[2] <= hi], [y[0] for y in b if lo < y[2] <= hi]) for lo, hi in zip([0, *cuts], cuts)]
        said = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        digest = hashlib.sha256(said.encode()).hexdigest() if a else ""
        out.append((len(a), len(b), len(cuts), len(of), sum(count[k] == most[k[1]] for k in of), sum(count[k] for k in of), digest, sum(len(g) * len(h) for g, h in groups)))
    return out, count


ODD = [
    None, "", " ", "a", "a ", " a", "  a  b ", "x\xa0 y \xa0z", "a▁b", "a ▁b", "<s> </s> <unk> <0x41> <|endoftext|>x<|endoftext|>", "a\nb\r\n\tc", "\x00 \x01",
    "　x 　 y", "é été naïve", "你好 世界", "\U0001f600 \U0001f468‍\U0001f469", "it's we'll 'tis 's", "word " * 50, "\x85 a\x85 b", "don’t   stop",
    "0x00 12,345.67", "tab\tin part", "a" * 300, "ال हिन्दी 한국어", "﻿x ﻿ y", "\x1c a\x1c b \x1f", "\x7f a\x7f b",
]


def check(spark, tokenizers, texts, make, **options):
    rows = [(i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in align_documents(make(rows, extra=("row", "key", "links", "n_a")), A, B, **options).collect()}
    want, _ = plain(tokenizers, texts)
    assert got == dict(enumerate(want))


def given_texts():
    return pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()


def test_odd_texts_equal_the_definition(spark, make, tokenizers):
    check(spark, tokenizers, ODD * 2, make)


def test_given_texts_equal_the_definition(spark, make, tokenizers):
    texts = [t if t is None or len(t) < 3_000 else t[:3_000] for t in given_texts()[:120]]
    check(spark, tokenizers, texts, make)


@pytest.mark.parametrize("pairs", [0, 150])
def test_pairs_that_are_not_sent_are_joined(spark, make, tokenizers, pairs):
    texts = ODD + [t[:400] for t in given_texts()[:40] if t]
    check(spark, tokenizers, texts, make, pairs=pairs)


def test_forgotten_units(spark, make, tokenizers, monkeypatch):
    units = Units(tokenizers)
    texts = [t for t in given_texts()[:60] if t]
    want = [text_totals(units, *units.numbered([t]))[0].tolist() for t in texts]
    monkeypatch.setattr(alignment, "KEPT_BYTES", 2_000)
    small = Units(tokenizers)
    assert [text_totals(small, *small.numbered([t]))[0].tolist() for t in texts] == want


def test_null_and_repeated_ids(spark, make, tokenizers):
    rows = [(None, "one two"), (None, "one two"), (7, "three"), (7, "four five"), (8, None)]
    got = sorted((str(r.doc_id), *(r[c] for c in COLUMNS)) for r in align_documents(make(rows), A, B).collect())
    want, _ = plain(tokenizers, [t for _, t in rows])
    assert got == sorted((str(i), *w) for (i, _), w in zip(rows, want, strict=True))


def test_empty_table(spark, make):
    assert align_documents(make([]), A, B).count() == 0


def test_counts_of_pairs(spark, make, tokenizers):
    texts = ODD + given_texts()[:5]
    _, count = plain(tokenizers, texts)
    got = {(r.a_id, r.b_id): (r.links, r.best) for r in pair_counts(make(list(enumerate(texts))).repartition(3), A, B).collect()}
    most = Counter()
    for (_, y), n in count.items():
        most[y] = max(most[y], n)
    assert got == {k: (n, n == most[k[1]]) for k, n in count.items()}


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t\xa0▁ ab1,.'é́你​\U0001f600\x00\x85"), max_size=14), min_size=1, max_size=4))
def test_units_equal_whole_texts(tokenizers, texts):
    units = Units(tokenizers)
    unit, counts = units.numbered(texts)
    totals, _ = text_totals(units, unit, counts)
    want, _ = plain(tokenizers, texts)
    assert [tuple(t[1:5]) + (t[5],) for t in totals.tolist()] == [w[:4] + (w[7],) for w in want]
    ends = np.cumsum(counts).tolist()
    for w, e, n in zip(want, ends, counts.tolist()):
        assert not w[0] or w[6] == hashlib.sha256(b";".join(units.groups[k] for k in unit[e - n : e])).hexdigest()


def test_alignment_places_and_group_links(tokenizers):
    al = tokenizers.align(["unbelievable tokenizers", "naïve 你好", "a▁b"])
    assert al.exact.tolist() == [True, True, False] and al.shared.sum() == sum(len((" " + t).encode()) for t in ("unbelievable tokenizers", "naïve 你好"))
    want = {(i, j) for i, g in enumerate(al.group_a) for j, h in enumerate(al.group_b) if g == h}
    got = [(int(i), int(j)) for rows in al.group_links(most=3) for i, j in zip(*rows)]
    assert len(got) == len(set(got)) and set(got) == want


def test_products_equal_dense_ones():
    rng = np.random.default_rng(0)
    for _ in range(20):
        x, y = rng.integers(0, 2, (5, 7)), rng.integers(0, 2, (7, 4))
        a, b = (CSR(np.r_[0, np.cumsum(m.sum(1))], np.nonzero(m)[1], m.shape[1]) for m in (x, y))
        dense = np.zeros((5, 4), int)
        for r in row_blocks(a, 4):
            i, j, v = product(a, b, *r)
            dense[i, j] += v
        assert (dense == x @ y).all()
        t = transpose(a)
        assert all(t.indices[t.indptr[k] : t.indptr[k + 1]].tolist() == np.flatnonzero(x[:, k]).tolist() for k in range(7))
