import base64
import hashlib
import random
import re
import string

import numpy as np
from pyspark.sql import functions as F

from smslens.llm import secrets
from smslens.llm.queries import LLM_QUERIES

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_spans(text):
    out = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, f"access:{m.start()}:{m.end()}") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, f"hex:{m.start()}:{m.end()}") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return [s for _, _, s in sorted(out)]


def plain_p(token):
    body = token.translate(str.maketrans("-_", "+/")).rstrip("=")
    if re.fullmatch("[0-9a-f]+|[0-9A-F]+", body):
        alphabet, body, k = "0123456789abcdef", body.lower(), 16
    elif re.fullmatch("[A-Z2-7]+", body):
        alphabet, k = string.ascii_uppercase + "234567", 32
    else:
        alphabet, k = string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/", 62 if body.isalnum() else 64
    v = np.array([alphabet.index(c) for c in body], float)
    n, counts, high = len(v), np.unique(v, return_counts=True)[1], v >= k / 2

    def tail(z):
        from math import erfc, sqrt

        return max(erfc(z / sqrt(2)) / 2, 1e-300)

    chi = (k / n * (counts**2).sum() - n - (k - 1)) / np.sqrt(2 * (k - 1) * (n - 1) / n)
    mean = 2 * high.sum() * (n - high.sum()) / n + 1
    runs = 37 if high.sum() in (0, n) else abs(1 + (high[1:] != high[:-1]).sum() - mean) / np.sqrt(max((mean - 1) * (mean - 2) / (n - 1), 1e-12))
    d = v - v.mean()
    serial = 37 if not d.any() else abs((d[1:] * d[:-1]).sum() / (d**2).sum()) * np.sqrt(n)
    return min(1, 3 * min(tail(chi), 2 * tail(runs), 2 * tail(serial)))


def check_base(rows, got):
    assert len(got) == len(rows)
    texts = {r[0]: r[1] or "" for r in rows}
    for r in got:
        want = base_spans(texts[r.doc_id])
        assert [s for s in r.spans.split(",") if s and not s.startswith("random")] == want
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s.startswith(k) for s in want) for k in ("assign", "access", "hex"))


def test_base_spans_and_random_tokens(make):
    rng = random.Random(1)
    token = lambda n: base64.b64encode(rng.randbytes(n)).decode()
    secret = [token(33) for _ in range(60)]
    rows = [(0, None), (1, ""), (2, "token=secret=abcdefgh PASSWORD : 'x' passwd=short token=token:longenough"), (3, "ÄÖ💥 api_key: \"abc.def/1\" AKIA" + "A1" * 9 + " AKIASHORT"), (4, "0f" * 12 + " " + "a" * 23 + " g" + "b" * 30)]
    rows += [(10 + i, f"text {s} and some more") for i, s in enumerate(secret)]
    rows += [(200 + i, " ".join("".join(rng.choices("etaoinshr", k=rng.randrange(20, 40))) for _ in range(5))) for i in range(100)]
    got = secrets.scan_secrets(make(rows, ["assign", "tokens", "start"])).collect()
    check_base(rows, got)
    found = {r.doc_id: r for r in got}
    hit = [f"random:5:{5 + len(s)}" in found[10 + i].spans for i, s in enumerate(secret)]
    assert np.mean(hit) >= 0.9 and sum(found[200 + i].n_random for i in range(100)) <= 5


def test_p_values_match_plain_formulas(spark):
    rng = random.Random(3)
    alphabets = ["0123456789abcdef", "0123456789ABCDEF", string.ascii_uppercase + "234567", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "-_", "etaoin", "a"]
    tokens = ["".join(rng.choices(a, k=k)) for a in alphabets for k in (20, 33, 90)] + ["ab" * 20, "AbCd" * 9 + "=="]
    got = spark.createDataFrame([(t,) for t in tokens], "t string").select("t", secrets.token_p(F.col("t")).alias("p")).collect()
    for r in got:
        assert np.isclose(np.log10(r.p), np.log10(plain_p(r.t)), atol=0.02, rtol=0.02), r


def test_query_and_edges(spark, data, make):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()]
    check_base(rows, LLM_QUERIES["op2_randomness_battery"](spark, data).collect())
    assert secrets.scan_secrets(make([])).count() == 0
    got = secrets.scan_secrets(make([(None, "token=abcdef"), (4, "token=abcdef"), (4, "token=abcdef"), (5, ("x" * 30 + " ") * 3000)])).collect()
    assert sorted((r.doc_id or 0, r.n_assign) for r in got) == [(0, 1), (4, 1), (4, 1), (5, 0)]
