import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from bandwatch.llm import runs as rn


def brute_runs(w):
    """Every stretch by every period, from the definition."""
    out, n = {}, len(w)
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            e = i
            while e + q < n and w[e] == w[e + q]:
                e += 1
            if e + q - i >= max(6, 4 * q):
                out.setdefault((i, e + q), q)
            i = e + 1
    return sorted((s, e, q) for (s, e), q in out.items())


def brute(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(w)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    found = brute_runs(w)
    best = min(((-Fraction(e - s, q), s, q, e) for s, e, q in found), default=None)
    head = (None,) * 4 if best is None else (best[1], best[3] - best[1], best[2], int(1000 * (best[3] - best[1]) // best[2]))
    kept = [x for i, x in enumerate(w) if not any(s + q <= i < e for s, e, q in found)]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *head, sha("".join(f"{s},{e - s},{q}\n" for s, e, q in found)), sha(" ".join(kept)))


def of(docs):
    lot = rn.Lot()
    for d in docs:
        lot.add([str(x).encode() for x in d])
    return [list(zip(s.tolist(), e.tolist(), q.tolist())) for _, s, e, q in lot.runs()]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=70), min_size=1, max_size=6))
def test_runs_of_few_words(docs):
    assert of(docs) == [brute_runs(d) for d in docs]


def test_runs_of_powers_and_nested_periods():
    r = random.Random(4)
    docs = []
    for _ in range(60):
        unit = [r.randrange(3) for _ in range(r.randrange(1, 9))]
        inner = unit * r.randrange(1, 9)
        whole = (inner + [r.randrange(4)] * r.randrange(0, 7)) * r.randrange(1, 7)
        docs.append([r.randrange(3) for _ in range(r.randrange(5))] + whole + [r.randrange(3) for _ in range(r.randrange(5))])
    docs += [[7] * 500, [1, 2] * 400 + [1], list(range(300)) * 5, [], [1] * 5, [1] * 6, [1, 2, 1, 2, 1, 2, 1], [1, 2] * 4]
    assert of(docs) == [brute_runs(d) for d in docs]


def test_agreement_of_places():
    r = random.Random(2)
    for kinds in (1, 2, 5):
        x = np.array([99, *[r.randrange(kinds) for _ in range(300)], 98])
        levels = rn.grammar(x, 300)
        i = np.array([r.randrange(1, 301) for _ in range(200)])
        j = np.array([r.randrange(1, 301) for _ in range(200)])
        i, j = np.minimum(i, j), np.maximum(i, j)
        i, j = i[i < j], j[i < j]
        for step in (1, -1):
            for a, b, got in zip(i, j, rn.agree(levels, i, j, step)):
                while x[a] == x[b]:
                    a, b = a + step, b + step
                assert got == a
        assert len(levels) > 1 and len(levels[-1].symbol) < len(x)


def test_a_very_long_document():
    unit = list(range(40_000))
    docs = [unit * 5 + [1, 1, 1, 1, 1, 1] + unit[:10], [5] * 200_000]
    a, b = of(docs)
    assert (0, 200_000, 40_000) in a and (200_000, 200_006, 1) in a and len(a) == 2 and b == [(0, 200_000, 1)]


SCHEMA = "start long, doc_id long, text string, period string"


def check(spark, rows):
    df = spark.createDataFrame([(1, d, t, "p") for d, t in rows], SCHEMA)
    out = rn.periodic_runs(df, test_tails=True, digest=True)
    assert sorted((tuple(r) for r in out.collect()), key=repr) == sorted((brute(d, t) for d, t in rows), key=repr)


def test_query_rows(spark):
    r = random.Random(9)
    rows = [(i, " ".join(r.choice("abc") for _ in range(r.randrange(0, 60)))) for i in range(150)]
    rows += [(None, "a a a a a a a"), (None, None), (5, None), (6, ""), (7, " \n\t "), (7, "x"), (7, "x x x x x x"), (8, "é\x1cb é\x1cb " * 9), (9, "A a " * 5)]
    check(spark, rows)
    check(spark, [])


def test_real_documents(spark):
    from bandwatch.llm.queries import QUERIES

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.text is None or len(r.text) < 6000]
    got = {r.doc_id: tuple(r) for r in QUERIES["op11_runs"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == docs.count() and all(got[d] == brute(d, t) for d, t in rows)


@pytest.mark.parametrize("text", ["a a a a a a b", "x y x y x y x y"])
def test_plain_output(spark, text):
    df = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = rn.periodic_runs(df).collect()[0]
    assert (row.runs, row.collapsed) == (("0,6,1\n", "a b") if "b" in text else ("0,8,2\n", "x y"))
