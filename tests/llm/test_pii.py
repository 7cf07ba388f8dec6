import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from bandwatch.llm import pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def brute(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m[0])
            double = [int(c) * (1 + i % 2) for i, c in enumerate(d[::-1])]
            good = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else True,
                    "card": 12 <= len(d) <= 19 and sum(x // 10 + x % 10 for x in double) % 10 == 0, "phone": 9 <= len(d) <= 15}
            if good[kind]:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda x: (x[0], list(PATTERNS).index(x[2])))


PIECES = ["a", "b.", "@", "@x.y", "x-1", "é", " ", "  ", "-", "+", "+1", "(", ")", ".", "1", "23", "255", "256", "4111 1111 1111 1111",
          "4012888888881881", "1.2.3.4", "0001", "\n", "555-7713", "_", "%"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_base_spans_equal_the_patterns(text):
    assert pii.base_spans(text) == brute(text)
    both = pii.candidates(text)
    assert [(s, e, k) for s, e, k, base in both if base] == brute(text)
    for s, e, k, base in both:
        v = pii.votes(text, s, e, k, base)
        assert len(v) == len(pii.LABELERS) and set(v) <= {-1, 0, 1} and np.isfinite(pii.features(text, s, e, k, v)).all()


def test_query_equals_brute_force_and_adds_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in pii.personal_data(docs).collect()}
    n_added = 0
    for r in docs.collect():
        want = brute(r.text)
        g = got[r.doc_id]
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone] == [sum(k == x for _, _, k in want) for x in PATTERNS]
        told = [f"{k}:{s}:{e}" for s, e, k in want]
        assert g.base_sha256 == hashlib.sha256(",".join(told).encode()).hexdigest()
        spans = g.spans.split(",") if g.spans else []
        assert set(told) <= set(spans)
        n_added += len(spans) - len(told)
    assert n_added <= 5


def test_method_adds_written_out_addresses_and_leaves_numbers(spark):
    clean = "Nothing here but build 2024 and 17 words of text in section 4.2."
    rows = [(i, f"contact me by email anna{i}x@mail{i}.org or phone +4930{i}55512{i}7 today") for i in range(10, 60)]
    rows += [(100, "please email anna.lee [at] mail [dot] org for more"), (101, "call phone (212) 555-7712 now"), (102, clean),
             (103, "serial id hash 0000 0000 0000 0001 token")]
    got = {r.doc_id: r.spans for r in pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[100].startswith("email:") and got[101].startswith("phone:") and got[102] == "" and got[103] == ""


def test_em_finds_the_unreliable_labeler():
    rng = np.random.default_rng(2)
    true = rng.random(5000) < 0.4
    right = [0.95, 0.9, 0.85, 0.5, 0.9, 0.8]
    patterns = {}
    for t in true:
        v = tuple(int((1 if t else -1) * (1 if rng.random() < a else -1)) for a in right)
        patterns[v] = patterns.get(v, 0) + 1
    prior, table = pii.reliabilities(patterns)
    assert abs(prior - 0.4) < 0.05
    for i, a in enumerate(right):
        assert abs(table[i, 1, 2] - a) < 0.06 and abs(table[i, 0, 0] - a) < 0.06


def test_long_runs_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1 " * 100_000, "a@" * 150_000, "x.y@" * 100_000, "1" * 5000 + "." + "2" * 5000):
        pii.candidates(text)


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "a@b.co", "x"), (3, "a@b.co", "x"), (3, "a@b.co", "x")]
    got = pii.personal_data(spark.createDataFrame(rows, "doc_id long, text string, spans string")).collect()
    assert sorted((r.doc_id or 0, r.n_email, r.spans) for r in got) == [(0, 1, "email:0:6"), (1, 0, ""), (2, 0, ""), (3, 1, "email:0:6"), (3, 1, "email:0:6")]
    assert pii.personal_data(spark.createDataFrame([], "doc_id long, text string")).count() == 0
