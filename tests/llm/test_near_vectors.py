import numpy as np
from pyspark.sql import functions as F

from bandwatch.llm import near_vectors as nv

SCHEMA = "vec_id long, embedding array<float>, label string, n_links int, v string"


def brute(rows):
    good = [i for i, (k, v) in enumerate(rows) if k is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    near = {i: [] for i in good}
    for i in good:
        for j in good:
            a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
            if i != j and len(a) == len(b) and a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.9:
                near[i].append(j)
    out = []
    for i, (k, _) in enumerate(rows):
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        least = min(rows[j][0] for j in seen) if k is not None else None
        out.append((k, len(near.get(i, [])), least, k is not None and k == least))
    return sorted(out, key=repr)


def clusters(seed, groups, each, dim=16, noise=0.05):
    rng = np.random.default_rng(seed)
    out = []
    for g in range(groups):
        c = rng.standard_normal(dim)
        c /= np.linalg.norm(c)
        out += [(c * rng.uniform(0.1, 9) + 0 if i == 0 else c + noise * rng.standard_normal(dim)).astype("f4").tolist() for i in range(each)]
    return out


def run(spark, rows, **settings):
    df = spark.createDataFrame([(k, v, "x", 1, "y") for k, v in rows], SCHEMA)
    out = nv.near_vectors(df, **settings)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in out.collect()), key=repr)


def test_equal_to_brute_force_with_copies_and_blocks(spark):
    vectors = clusters(1, 12, 6)
    rows = list(enumerate(vectors)) + [(100 + i, vectors[0]) for i in range(40)] + [(200, vectors[9]), (200, vectors[10]), (3, vectors[50])]
    want = brute(rows)
    assert run(spark, rows) == want and max(r[1] for r in want) > 40
    assert run(spark, rows, block=3) == want  # crowded buckets in several pieces


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]), (6, [None, 1.0]), (None, [1.0, 0.0]), (None, None),
            (7, [1.0, 0.0]), (8, [2.0, -0.0]), (9, [1.0, 0.0, 0.0]), (10, [1e-38, 1e-45]), (11, [3e38, 1e38]), (-5, [-1.0, 0.0])]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_recall_near_the_threshold(spark):
    """Pairs with a cosine of just 0.9 to 0.92 among many unrelated vectors."""
    rng = np.random.default_rng(5)
    base = rng.standard_normal((400, 64))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    side = rng.standard_normal((400, 64))
    side -= (side * base).sum(1, keepdims=True) * base
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    c = rng.uniform(0.901, 0.92, (400, 1))
    other = base * c + side * np.sqrt(1 - c * c)
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate([base, other]).astype("f4"))]
    df = spark.createDataFrame([(k, v, "", 0, "") for k, v in rows], SCHEMA)
    links = {r.vec_id: r.n_links for r in nv.near_vectors(df).collect()}
    assert sum(links[i] > 0 for i in range(400)) >= 0.98 * 400


def test_no_link_below_the_threshold_and_one_large_group(spark):
    rng = np.random.default_rng(3)
    c = rng.standard_normal(8)
    rows = [(i, (c + 0.02 * rng.standard_normal(8)).astype("f4").tolist()) for i in range(600)]
    rows += [(1000 + i, v.tolist()) for i, v in enumerate(rng.standard_normal((50, 8)).astype("f4"))]
    assert run(spark, rows, block=100) == brute(rows)


def test_query_on_the_table(spark):
    from bandwatch.llm.queries import QUERIES

    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    out = QUERIES["op12_near_vectors"](spark, "/root/testdata/sf0.01")
    assert out.count() == table.count() and out.where(F.col("kept")).count() > 0
