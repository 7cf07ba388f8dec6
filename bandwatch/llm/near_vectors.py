"""Near-duplicate vectors by Euclidean p-stable hashing.

Vectors are brought to length one, so a cosine of s is a distance of sqrt(2 - 2 s).
In each of several tables a vector's bucket is made of quantised random projections,
floor((a x + b) / width) with normal a, and near vectors share a bucket of some table
with a probability that depends on their distance alone. Vectors of one bucket are
then compared by their cosine in double precision.

Equal vectors are one vector with a number of copies. A bucket of many vectors is cut
into blocks, and every pair of blocks is a piece of work of its own, so neither copies
nor one crowded bucket make a large task, and no pair of a bucket is left out. A pair
that meets in several tables counts in the first one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwatch.llm.components import components
from bandwatch.llm.stage import staged

COSINE = 0.9
TABLES = 32
HASHES = 12  # projections that make a bucket
WIDTH = 2.5  # of a projection's cells; at cosine 0.9 a pair is found with probability 0.996, at 0.95 with 0.9999
BLOCK = 1024  # vectors of a block
SEED = 12


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, v): the usable vectors as bytes, null for the others.

    ``v`` begins with the bytes of a component: 4 where single precision holds all of them, else 8. Negative zeros
    become zeros.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x in batch.column(1):
                if not x.is_valid or x.values.null_count or not len(x.values):
                    out.append(None)
                    continue
                v = x.values.to_numpy(zero_copy_only=False) + 0.0
                if not np.isfinite(v).all() or not v.any():
                    out.append(None)
                    continue
                with np.errstate(over="ignore"):
                    small = v.astype("<f4")
                out.append(b"\4" + small.tobytes() if (small == v).all() else b"\10" + v.astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], ["vec_id", "v"])

    return rows.mapInArrow(run, "vec_id long, v binary")


def unit(vectors: list[bytes]) -> np.ndarray:
    """Vectors of one dimension as rows of length one, in double precision."""
    x = np.array([np.frombuffer(v, f"<f{v[0]}", offset=1) for v in vectors], float)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def dimension(v: bytes) -> int:
    return (len(v) - 1) // v[0]


def bucket_keys(x: np.ndarray, tables: int, hashes: int, width: float) -> np.ndarray:
    """A 64-bit bucket key for every vector and table."""
    rng = np.random.default_rng([SEED, x.shape[1]])
    plan, shift = rng.standard_normal((x.shape[1], tables * hashes)), rng.uniform(0, width, tables * hashes)
    cells = np.floor((x @ plan + shift) / width).astype(np.int64).astype(np.uint64).reshape(len(x), tables, hashes)
    factors = rng.integers(0, 1 << 64, hashes, np.uint64) | np.uint64(1)
    h = (cells * factors).sum(axis=2, dtype=np.uint64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (h ^ (h >> np.uint64(29))).view(np.int64)


def first_met(keys: np.ndarray, i: np.ndarray, j: np.ndarray, table: int) -> np.ndarray:
    """Which of the pairs share no bucket of a table before ``table``."""
    left = np.arange(len(i))
    for t in range(table):
        left = left[keys[i[left], t] != keys[j[left], t]]
    return left


def least_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least place joined with each of ``n`` places by pairs (i, j)."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], least)
        np.minimum.at(new, label[j], least)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(nodes: np.ndarray, copies: np.ndarray, vectors: list[bytes], block: np.ndarray, lo: int, hi: int, table: int,
             cosine: float, settings: tuple) -> tuple[np.ndarray, ...]:
    """(node, least node joined with it, copies linked with it) of one pair of blocks, from pairs not met in an earlier table."""
    order = np.argsort(nodes, kind="stable")
    nodes, copies, block = nodes[order], copies[order], block[order]
    x = unit([vectors[k] for k in order])
    if lo == hi:
        i, j = np.nonzero(np.triu(x @ x.T >= cosine, 1))
    else:
        a, b = np.flatnonzero(block == lo), np.flatnonzero(block == hi)
        i, j = np.nonzero(x[a] @ x[b].T >= cosine)
        i, j = a[i], b[j]
    if len(i) and table:
        some = np.unique(np.concatenate([i, j]))  # only vectors with a partner need their other buckets
        keys = np.empty((len(x), settings[0]), np.int64)
        keys[some] = bucket_keys(x[some], *settings)
        new = first_met(keys, i, j, table)
        i, j = i[new], j[new]
    if not len(i):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    n = np.zeros(len(x), np.int64)
    np.add.at(n, i, copies[j])
    np.add.at(n, j, copies[i])
    held = np.flatnonzero(n)
    return nodes[held], nodes[least_labels(len(x), i, j)[held]], n[held]


def linked(nodes: DataFrame, cosine: float, tables: int, hashes: int, width: float, block: int) -> DataFrame:
    """(node, joined, n): for every piece of work and vector with partners there, the least vector joined with it and the partners' copies."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 512):
                part = batch.slice(start, 512)
                held = part.column(1).to_pylist()
                dims = np.array([dimension(v) for v in held])
                keys = np.empty((len(held), tables), np.int64)
                for d in np.unique(dims):
                    at = np.flatnonzero(dims == d)
                    keys[at] = bucket_keys(unit([held[k] for k in at]), tables, hashes, width)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(held) * tables + 1, tables), pa.int32()), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(dims, pa.int32()), lists], ["node", "dim", "keys"])

    keyed = staged(nodes.select("node", "v").mapInArrow(hashed, "node long, dim int, keys array<long>"), "vector-buckets")
    met = keyed.select("node", "dim", F.posexplode("keys").alias("t", "key"))
    # few: only buckets of more than a block; how many is left to Spark's measure
    large = met.groupBy("t", "dim", "key").agg(F.count(F.lit(1)).alias("in")).where(F.col("in") > block).select(
        "t", "dim", "key", F.ceil(F.col("in") / block).cast("int").alias("blocks"))
    dealt = (
        met.join(staged(large, "large-buckets"), ["t", "dim", "key"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("block", F.pmod(F.xxhash64("node", "t"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("t", "dim", "key", F.least("block", "other").alias("lo"), F.greatest("block", "other").alias("hi"), "block", "node")
    )
    work = ["t", "dim", "key", "lo", "hi"]
    pieces = dealt.join(nodes, "node").repartition(*work).sortWithinPartitions(*work).select(*work, "block", "node", "copies", "v")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            marks = np.array([rows[c].to_numpy() for c in work])
            starts = np.concatenate([[0], 1 + np.flatnonzero((np.diff(marks, axis=1) != 0).any(axis=0))])
            yield found(rows, marks, starts, np.append(starts[1:], rows.num_rows)[:-1])
            rest = rows.slice(int(starts[-1]))  # the last piece may go on
        if rest is not None:
            yield found(rest, np.array([rest[c].to_numpy() for c in work]), np.array([0]), np.array([rest.num_rows]))

    def found(rows: pa.Table, marks: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.RecordBatch:
        side, node, copies, v = rows["block"].to_numpy(), rows["node"].to_numpy(), rows["copies"].to_numpy(), rows["v"].combine_chunks()
        out = [(np.empty(0, np.int64),) * 3]
        for a, b in zip(starts.tolist(), ends.tolist()):
            if b - a > 1:
                t, _, _, lo, hi = marks[:, a].tolist()
                out.append(_compare(node[a:b], copies[a:b], v.slice(a, b - a).to_pylist(), side[a:b], lo, hi, t, cosine, (tables, hashes, width)))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out)], ["node", "joined", "n"])

    return pieces.mapInArrow(compare, "node long, joined long, n long")


def near_vectors(vectors: DataFrame, cosine: float = COSINE, vec_id: str = "vec_id", embedding: str = "embedding", tables: int = TABLES,
                 hashes: int = HASHES, width: float = WIDTH, block: int = BLOCK) -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Two rows link when their vectors have the same number of components and a cosine of ``cosine`` or more. A link is
    found where both fall into one bucket of a table; equal vectors always are. ``component_id`` is the least vec_id
    reachable by links; ``kept`` marks rows that have it as their own. More ``hashes`` make smaller buckets, more
    ``tables`` find more pairs; a table of billions of vectors wants more of both.

    Vectors that are null, empty or zero, or hold null or non-finite components, link with nothing, and neither do rows
    without id, whose component is null and which are not kept. Rows of one vec_id are vectors of their own that count
    as links of each other where they are near. An empty table gives no rows. Other columns are not read.
    """
    slim = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.col(f"`{embedding}`").cast("array<double>").alias("e"))
    rows = staged(distinct_vectors(slim), "vectors")
    usable = F.col("v").isNotNull() & F.col("vec_id").isNotNull()
    nodes = staged(rows.where(usable).groupBy("v").agg(F.count(F.lit(1)).alias("copies"), F.min("vec_id").alias("least"))
                   .withColumn("node", F.monotonically_increasing_id()), "distinct-vectors")
    links = staged(linked(nodes.select("node", "copies", "v"), cosine, tables, hashes, width, block), "vector-links")
    joined = components(links.select(F.col("node").alias("a"), F.col("joined").alias("b")))
    named = nodes.select("node", "v", "copies", "least").join(joined.withColumnRenamed("id", "node"), "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    counts = links.groupBy("node").agg(F.sum("n").alias("n"))
    told = named.join(least, "component").join(counts, "node", "left").select(
        "v", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("_n"), "component_id")
    return rows.withColumn("_key", F.when(F.col("vec_id").isNotNull(), F.col("v"))).join(
        told.withColumnRenamed("v", "_key"), "_key", "left").select(
        "vec_id", F.coalesce("_n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
