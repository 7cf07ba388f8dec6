import math

import numpy as np
from pyspark.sql import functions as F

from bandwatch.llm import top_k as t


def brute(rows, k=5, every=50):
    kept = []
    for vec_id, v in rows:
        if vec_id is not None and v is not None and all(x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v):
            kept.append((vec_id, [math.floor(256 * x) for x in v]))
    out = set()
    for q, a in kept:
        if q % every == 0:
            held = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
            scored = sorted((-held(sum(x * y for x, y in zip(a, b))), c) for c, b in kept if c != q and len(a) == len(b))[:k]
            out |= {(q, i + 1, c, -s) for i, (s, c) in enumerate(scored)}
    return out


def found(frame, **sizes):
    return {tuple(r) for r in t.top_k(frame, **sizes).collect()}


def test_tiles_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(size=6)]) for i in range(400)]
    rows += [(i, rows[i % 7][1]) for i in range(400, 520)]  # ties
    rows += [(1000, None), (1050, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (1100, [math.nan] + [0.0] * 5), (1150, [math.inf] + [0.0] * 5), (None, [0.5] * 6),
             (1200, [0.25] * 3), (1201, [0.5] * 3), (1250, []), (1251, []), (1300, [-0.001] * 6)]
    frame = spark.createDataFrame([(a, b, 1, 2) for a, b in rows], "vec_id long, embedding array<double>, shard int, score int")
    want = brute(rows)
    assert found(frame) == want
    assert found(frame.repartition(9), shard_rows=13, block_rows=3, fan_in=2) == want


def test_scores_beyond_doubles_are_exact(spark):
    rows = [(0, [2.0**40, 3.0]), (1, [2.0**40, 1.0]), (2, [2.0**40 + 0.0625, 1.0]), (50, [1e300, 1.0]), (3, [1e300, 0.0]), (4, [-1e300, 5.0])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(frame) == brute(rows)


def test_repeated_and_missing_rows(spark):
    rows = [(0, [1.0]), (0, [1.0]), (7, [2.0]), (7, [2.0]), (8, [1.5])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in t.top_k(frame).collect()) == [(0, 1, 7, 131072), (0, 2, 7, 131072), (0, 3, 8, 98304)]
    assert t.top_k(frame.limit(0)).count() == 0
    assert t.top_k(frame, queries=frame.where(F.col("vec_id") == 8)).count() == 4


def test_a_shard_with_more_own_rows_than_k(spark):
    rows = [(0, [1.0])] * 3 + [(i, [float(x)]) for i, x in ((1, 10), (2, 40), (3, 20), (4, 30))]
    assert found(spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)) == brute(rows)
    rows = [(0, [1.0])] * 9 + [(i, [float(i)]) for i in range(1, 5)]
    assert found(spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)) == brute(rows)
    q, c = np.array([0]), np.array([0] * 9 + [3, 2])
    assert list(t.best_of_tile(q, np.ones((1, 1)), c, np.arange(11.0)[:, None], 5)) == [(0, 2, 10), (0, 3, 9)]
