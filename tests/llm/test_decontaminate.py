import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from bandwatch.llm import decontaminate as d


def plain(text):
    return re.sub(r"[!-/:-@\[-`{-~]", " ", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")).encode().split()


def bag(words, k):
    return Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1))


def brute(docs, items):
    """Every window of every document against every item, without fingerprints."""
    out = []
    for doc_id, text in docs:
        words = plain(text)
        for item_id, item in items:
            own = plain(item)
            k = min(5, len(own))
            if not own or len(words) < k:
                continue
            want, best = bag(own, k), (0, 0)
            n = min(len(own), len(words))
            for s in range(len(words) - n + 1):
                best = max(best, (d.weighted_similarity(bag(words[s:s + n], k), want), -s))
            if best[0] >= 0.8:
                out.append((doc_id, item_id, round(best[0], 9), -best[1], n))
    return sorted(out, key=repr)


def found(spark, docs, items):
    rows = d.benchmark_passages(spark.createDataFrame([(a, b, "x", 1) for a, b in docs], "doc_id long, text string, item_id string, start_word int"),
                                spark.createDataFrame([(a, b, 2) for a, b in items], "item_id long, text string, doc_id int")).collect()
    return sorted(((r.doc_id, r.item_id, round(r.similarity, 9), r.start_word, r.n_words) for r in rows), key=repr)


def cases(seed=3):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 6)))
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 3, 5, 8, 14, 30, 59])))) for i in range(40)]
    docs = []
    for i in range(150):
        words = [word() for _ in range(rng.randrange(0, 120))]
        for _ in range(rng.randrange(3)):
            own = rng.choice(items)[1].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                own[rng.randrange(len(own))] = word()
            at = rng.randrange(len(words) + 1)
            words[at:at] = own
        docs.append((i, rng.choice([" ", "\n", ", "]).join(words)))
    return docs, items


def test_against_brute_force(spark):
    docs, items = cases()
    docs += [(500, None), (501, ""), (None, items[5][1]), (502, items[6][1].upper()), (502, items[6][1]), (503, "pad " * 200_000 + items[6][1])]
    items += [(90, None), (91, " .,"), (None, items[6][1]), (6, items[6][1])]
    short = [x for x in docs if x[0] != 503]
    got = found(spark, docs, items)
    assert [r for r in got if r[0] != 503] == brute(short, items)
    assert {r[1] for r in got if r[0] == 503} == {6, None}


def test_parts_of_the_benchmark_give_the_same(spark, monkeypatch):
    docs, items = cases(4)
    monkeypatch.setattr(d, "PART_CHARS", 900)
    table = spark.createDataFrame(items, "item_id long, text string")
    texts = list(d.parts(d.text_keys(table, "text")))
    assert len(texts) > 3 and max(sum(len(t) for _, t in p.rows) for p in texts) < 2700
    assert found(spark, docs, items) == brute(docs, items)


def test_block_index_finds_all_within_the_radius():
    rng = np.random.default_rng(0)
    items = rng.integers(0, 1 << 63, 300, np.uint64)
    asked = []
    for _ in range(400):
        flips = rng.choice(64, rng.integers(0, 30), replace=False)
        asked.append(int(items[rng.integers(300)]) ^ sum(1 << int(f) for f in flips))
    asked = np.array(asked, np.uint64)
    got = set(d.BlockIndex(items.tolist()).within(asked))
    assert got == {(i, j) for i in range(400) for j in range(300) if int(asked[i] ^ items[j]).bit_count() <= d.RADIUS}


@pytest.mark.parametrize("n", [14, 30, 59])
def test_recall_at_the_threshold(n):
    rng = np.random.default_rng(n)
    near = 0
    for _ in range(2000):
        own = rng.integers(0, 1 << 63, n, np.uint64)
        k = int(np.ceil(0.8 / 1.8 * 2 * n))
        other = np.concatenate([own[:k], rng.integers(0, 1 << 63, n - k, np.uint64)])
        a, b = (d.fingerprints(x, n, np.array([0]))[0] for x in (own, other))
        near += int(a ^ b).bit_count() <= d.RADIUS
    assert near >= 1998


def test_stage_keeps_clean_documents(spark):
    docs, items = cases(5)
    frame = spark.createDataFrame([(t, i, "k") for i, t in docs], "text string, doc_id long, item_id string")
    left = d.without_benchmark(frame, spark.createDataFrame(items, "item_id long, text string"))
    bad = {r[0] for r in brute(docs, items)}
    assert left.columns == frame.columns and sorted(r.doc_id for r in left.collect()) == [i for i, _ in docs if i not in bad]
    nothing = d.without_benchmark(frame, spark.createDataFrame([], "item_id long, text string"))
    assert nothing.count() == len(docs) and d.benchmark_passages(frame, spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_repeated_benchmark_rows_go_out_once(spark, monkeypatch):
    docs, items = cases(6)
    docs, items = docs[:30], items[:12]
    monkeypatch.setattr(d, "PART_CHARS", 700)
    table = spark.createDataFrame(items, "item_id long, text string").unionByName(
        spark.range(10_000).select((F.col("id") + 1000).alias("item_id"), F.lit(items[-1][1]).alias("text")))
    assert sum(len(p.rows) for p in d.parts(d.text_keys(table, "text"))) == len({t for _, t in items})
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    got = d.benchmark_passages(frame, table).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()
    want = Counter()
    for r in brute(docs, items):
        want[r[0]] += 1 + 10_000 * (r[1] == items[-1][0])
    assert {r.doc_id: r.n for r in got} == dict(want)
