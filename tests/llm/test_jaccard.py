import random
import re

import numpy as np
import pytest

from bandwatch.llm import jaccard
from bandwatch.llm.components import components
from bandwatch.llm.stage import staged


def brute(rows, words=4, percent=85):
    """{(doc_id, text): (n, component)} straight from the definition."""
    sets = []
    for doc_id, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set())
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = {}
    for i, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(i)
    seen = set()
    for i in range(len(rows)):
        near = {j for x in sets[i] for j in holders[x] if j > i}
        for j in near:
            k = len(sets[i] & sets[j])
            if 100 * k >= percent * (len(sets[i]) + len(sets[j]) - k):
                seen.add((i, j))
    for i, (d, _) in enumerate(rows):
        seen |= {(i, j) for j in range(i) if d is not None and rows[j][0] == d and sets[i] and sets[j]}
    for i, j in seen:
        if rows[i][0] is not None and rows[j][0] is not None:
            parent[find(i)] = find(j)
    groups = {}
    for i, (d, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(d)
    return sorted(((d, t, len(s), min(groups[find(i)]) if d is not None else None) for i, ((d, t), s) in enumerate(zip(rows, sets))), key=repr)


def joined(spark, rows):
    docs = spark.createDataFrame([(d, t, "a", "b") for d, t in rows], "doc_id long, text string, block string, component string")
    got = jaccard.jaccard_components(docs).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=repr)


def test_against_brute_force_on_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    want = [(d, n, c) for d, _, n, c in brute([(r.doc_id, r.text) for r in docs.collect()])]
    assert joined(spark, [(r.doc_id, r.text) for r in docs.collect()]) == sorted(want, key=repr)


def test_chains_edges_of_the_threshold_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "LEAVES", 4)  # many blocks
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for group in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([5, 40, 300]))]
        for _ in range(30):
            words = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.2:
                words += passage
            rows.append((len(rows) * 3, " ".join(words)))
            base = words if group % 2 else base  # chains drift
    for extra in range(40):
        rows.append((1000 + extra, " ".join(passage + [rng.choice(vocabulary) for _ in range(extra % 12)])))
    rows += [(7, None), (7, ""), (None, rows[3][1]), (None, None), (8, " \t\n"), (10, "one two"), (11, "ONE  two\n"), (13, "one two three"),
             (-3, rows[50][1]), (50, "x y z q"), (50, rows[90][1]), (50, rows[150][1]), (3, rows[1][1]), (3, rows[1][1])]
    want = sorted(((d, n, c) for d, _, n, c in brute(rows)), key=repr)
    assert joined(spark, rows) == want


def test_nothing(spark):
    assert joined(spark, []) == [] and joined(spark, [(1, None), (2, "")]) == [(1, 0, 1), (2, 0, 2)]


def test_one_of_each_group(spark):
    rows = [(3, "a b c d e"), (1, "a b c d e"), (1, "a b c d e"), (5, None), (6, "other words here now"), (None, "a b c d e")]
    docs = spark.createDataFrame([(t, d, "k") for d, t in rows], "text string, doc_id long, gone string")
    left = jaccard.one_of_each_group(docs)
    assert left.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=repr) == sorted(
        [(1, "a b c d e"), (5, None), (6, "other words here now"), (None, "a b c d e")], key=repr)


def test_components(spark):
    rng = random.Random(1)
    pairs = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(80)] + [
        (600, x) for x in range(601, 700)] + [(9, 9), (3, 2), (2, 3)]
    got = {r.id: r.component for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    label = {x: x for p in pairs for x in p if p[0] != p[1]}
    for _ in range(200):
        for a, b in pairs:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert got == label
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bound_never_hides_a_link(spark):
    """Blocks that the bound leaves out hold no link."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 500, 400)
    rows = []
    for i in range(60):
        words = base.copy()
        words[rng.integers(0, 400, rng.integers(0, 25))] = rng.integers(0, 500)
        rows.append((i, " ".join(map(str, words))))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    leaves = jaccard._leaves(docs, np.zeros(1 << jaccard.SKETCH_BITS, np.uint8), 4, 85)
    # every leaf a block of its own
    blocks = staged(leaves.selectExpr("*", "doc_id as block", "doc_id as component"), "t")
    signed = jaccard._signatures(blocks)
    every = spark.createDataFrame([(a, b, None) for a in range(60) for b in range(a)], "x long, y long, shared long")
    left = {(r.x, r.y) for r in jaccard._pairs(every, signed, 85).collect()}
    assert len(left) < 60 * 59 / 2
    sets = [set(jaccard.shingle_set(t, 4).tolist()) for _, t in rows]
    for a in range(60):
        for b in range(a):
            k = len(sets[a] & sets[b])
            if 100 * k >= 85 * (len(sets[a]) + len(sets[b]) - k):
                assert (a, b) in left
