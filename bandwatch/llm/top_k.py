"""Exact top-k inner products by tiles.

Candidates are cut into shards and queries into blocks, both as matrices of bounded
size. A tile multiplies a block with a shard and keeps each query's best few; lists
of neighbouring shards are then merged level by level until one is left per query.
Components are integers, and the products of a tile are added in doubles only where
no sum can reach 2**53, otherwise in integers of any size, so scores are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bandwatch.llm.stage import staged

K = 5
SCALE = 256
SHARD_ROWS = 4096
BLOCK_ROWS = 512
FAN_IN = 16
EXACT = float(1 << 53)
LONG = (1 << 63) - 1


def quantized(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, dim, q): floor(256 * component) as doubles, which hold them exactly. Other vectors are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 4096):
                part = batch.slice(start, 4096)
                lists = part.column(1)
                flat, ids, out = lists.values, [], []
                values = flat.to_numpy(zero_copy_only=False).astype(float)  # nulls become NaN
                offsets = lists.offsets.to_numpy()
                with np.errstate(over="ignore"):
                    whole = np.floor(SCALE * values)
                good = np.isfinite(values) & np.isfinite(whole)
                bad_before = np.concatenate([[0], np.cumsum(~good)])
                for i in np.flatnonzero(lists.is_valid().to_numpy(zero_copy_only=False) & part.column(0).is_valid().to_numpy(zero_copy_only=False)):
                    a, b = offsets[i], offsets[i + 1]
                    if bad_before[a] == bad_before[b]:
                        ids.append(i)
                        out.append(whole[a:b].astype("<f8").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(ids, pa.int64())), pa.array([len(x) // 8 for x in out], pa.int32()), pa.array(out, pa.binary())],
                    ["vec_id", "dim", "q"])

    slim = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding"))
    return slim.mapInArrow(run, "vec_id long, dim int, q binary")


def _narrow(matrix: bytes) -> bytes:
    """Single precision where it holds all components."""
    wide = np.frombuffer(matrix, "<f8")
    with np.errstate(over="ignore"):
        small = wide.astype("<f4")
    return small.tobytes() if (small == wide).all() else matrix


def _matrix(data: bytes, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(data, f"<f{len(data) // max(1, rows * dim) or 8}").reshape(rows, dim).astype(float)


def matrices(rows: DataFrame, most: int) -> DataFrame:
    """(dim, part, ids, m): rows of a task and dimension packed together, at most ``most`` in each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[int], list[bytes]]] = {}
        part = TaskContext.get().partitionId() << 32

        def full(dim: int) -> pa.RecordBatch:
            nonlocal part
            ids, out = held.pop(dim)
            part += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int32()), pa.array([part], pa.int64()), pa.array([np.array(ids, "<i8").tobytes()], pa.binary()),
                 pa.array([_narrow(b"".join(out))], pa.binary())], ["dim", "part", "ids", "m"])

        for batch in batches:
            for vec_id, dim, q in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ids, out = held.setdefault(dim, ([], []))
                ids.append(vec_id)
                out.append(q)
                if len(ids) >= most:
                    yield full(dim)
        for dim in list(held):
            yield full(dim)

    return rows.mapInArrow(run, "dim int, part long, ids binary, m binary")


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact a @ b.T of whole numbers; integers of any size where doubles or longs could not hold a sum."""
    reach = a.shape[1] * float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0))
    if reach < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], object).reshape(m.shape) for m in (a, b)]
    return np.clip(whole[0] @ whole[1].T, -LONG - 1, LONG)


def best_of_tile(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """(query, candidate, score): each query's ``k`` best in the tile, ties to smaller ids; never itself.

    The k-th best score is found by partial selection, then all that reach it compete by id.
    """
    order = np.argsort(c_ids, kind="stable")
    c_ids, c = c_ids[order], c[order]
    scores = products(q, c)
    if scores.dtype == object:  # beyond doubles: rare, by plain sorting
        for row, own in zip(scores, q_ids):
            left = [i for i in sorted(range(len(c_ids)), key=lambda i: (-row[i], c_ids[i])) if c_ids[i] != own][:k]
            yield from ((int(own), int(c_ids[i]), int(row[i])) for i in left)
        return
    scores[q_ids[:, None] == c_ids[None, :]] = np.iinfo(np.int64).min  # out of reach for a sum below 2**53
    n = min(k, scores.shape[1])
    edge = np.partition(scores, scores.shape[1] - n, axis=1)[:, scores.shape[1] - n]
    for row, own, least in zip(scores, q_ids, edge):
        reach = np.flatnonzero(row >= least)
        reach = reach[c_ids[reach] != own]  # before sorting: the least long has no negative
        top = reach[np.argsort(-row[reach], kind="stable")][:n]
        yield from ((int(own), int(c_ids[i]), int(row[i])) for i in top)


def top_k(vectors: DataFrame, queries: DataFrame | None = None, k: int = K, vec_id: str = "vec_id", embedding: str = "embedding",
          shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS, fan_in: int = FAN_IN) -> DataFrame:
    """query_id, rank, vec_id, score: for each query its ``k`` candidates of the largest inner product.

    ``queries`` are by default the rows whose id is divisible by 50. A row is no candidate for a query of the same
    id. Vectors that are null or hold null or non-finite components, or have a null id, take no part. Vectors of
    different length do not meet. Several rows with one id are candidates one by one, ties among them included;
    queries with one id share one list. Scores beyond the range of a long stop at its ends and are ties there. Empty tables give an
    empty result. Other columns are not read.
    """
    rows = staged(quantized(vectors, vec_id, embedding), "quantized")
    asked = rows.where("vec_id % 50 = 0") if queries is None else quantized(queries, vec_id, embedding)
    shards = staged(matrices(rows, shard_rows), "shards")
    blocks = matrices(asked.dropDuplicates(["vec_id", "dim", "q"]), block_rows).select(
        "dim", F.col("ids").alias("q_ids"), F.col("m").alias("q"))
    numbered = shards.select("part", "dim").withColumn("shard", F.row_number().over(Window.orderBy("dim", "part")) - 1)  # a row per shard
    numbered = staged(numbered, "shard-numbers")
    # every block goes to every shard of its length: the grid of tiles is spread by shard
    wanted = numbered.groupBy("dim").agg(F.min("shard").alias("lo"), F.max("shard").alias("hi"))
    sent = blocks.join(wanted, "dim").select(F.explode(F.sequence("lo", "hi")).alias("shard"), "q_ids", "q")
    tiles = shards.join(numbered, ["part", "dim"]).join(sent, "shard").select("shard", "dim", "ids", "m", "q_ids", "q")

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                shard, dim, ids, m, q_ids, q = (batch.column(j)[i].as_py() for j in range(6))
                a, b = np.frombuffer(q_ids, "<i8"), np.frombuffer(ids, "<i8")
                found = list(best_of_tile(a, _matrix(q, len(a), dim), b, _matrix(m, len(b), dim), k))
                columns = list(zip(*found)) or [()] * 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard] * len(found), pa.int64()), *(pa.array(c, pa.int64()) for c in columns)],
                    ["node", "query_id", "vec_id", "score"])

    lists = tiles.mapInArrow(multiply, "node long, query_id long, vec_id long, score long")
    order = [F.desc("score"), F.asc("vec_id")]
    width = numbered.count()
    while True:
        width = -(-width // fan_in)
        lists = lists.withColumn("node", F.floor(F.col("node") / fan_in))
        merged = Window.partitionBy("query_id", "node").orderBy(*order)
        lists = lists.withColumn("rank", F.row_number().over(merged)).where(F.col("rank") <= k)
        if width <= 1:
            return lists.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
        lists = lists.drop("rank")
