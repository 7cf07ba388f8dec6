"""Exact Jaccard join over word shingles with signature trees.

Leaves of the tree are distinct shingle sets (equal sets are one). Leaves with the
same least hash, as most near copies have, and nearly one size form a node, split into
blocks of bounded size. A block has
the OR of its leaves' token bitmaps, the range of their sizes and the least number
of bits of one: from these follows the largest overlap that a leaf of one block can
have with a leaf of another, and pairs of blocks that cannot reach the threshold are
left out. What is left is compared leaf by leaf on the sets.

Blocks meet through prefix tokens: with all tokens in one order, two sets as similar
as asked share one of their first ``n - ceil(t n) + 1``. Rare tokens come first in
that order, so passages that many documents share bring few blocks together. How
rare a token is comes from a sketch of fixed size over all documents; a wrong guess
costs time, never a link.

The trees are walked twice. First a block meets itself and the one that most of its prefix
tokens name as theirs.
Then the blocks are dealt anew, leaves of large components apart, and all that share a
prefix token and are not of one component meet. Within a component nothing is left to
find, so a large group of near copies costs about in proportion to its size.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwatch.llm.components import components
from bandwatch.llm.shingles import shingle_set
from bandwatch.llm.stage import id_and_text, per_batch, staged

WORDS = 4
PERCENT = 85
SKETCH_BITS = 21
CHUNK_BITS = 16
LEVEL = 1.3  # counts that differ by less than this factor rank alike
LEAVES = 64  # of a block, on average, and at most so many shingles unless one leaf has more
BLOCK_SHINGLES = 1 << 16
BITMAP = [f"b{i}" for i in range(16)]  # 1,024 bits
SIZE_STEP = 1.08
FILTER_BITS = 23


def _profile(docs: DataFrame, words: int) -> DataFrame:
    """Rows of two kinds: per document (doc_id, n, h1, h2, first), and per task the chunks of its token counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, none = np.zeros(1 << SKETCH_BITS, np.uint32), None

        def some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            nonlocal counts
            sets = [shingle_set(x, words) for x in batch.column(1).to_pylist()]
            if sets:
                low = (np.concatenate(sets) & np.uint64(len(counts) - 1)).astype(np.int64)
                counts += np.bincount(low, minlength=len(counts)).astype(np.uint32)
            halves = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in sets), "<i8").reshape(-1, 2)
            k = len(sets)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]),
                 pa.array([s[:1].view("<i8")[0] if len(s) else None for s in sets], pa.int64()),
                 pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], PROFILE)

        yield from per_batch(some, 1000)(batches)
        chunks = [c for c in range(len(counts) >> CHUNK_BITS) if counts[c << CHUNK_BITS:(c + 1) << CHUNK_BITS].any()]
        packed = [zlib.compress(counts[c << CHUNK_BITS:(c + 1) << CHUNK_BITS].tobytes(), 1) for c in chunks]
        none = pa.nulls(len(chunks), pa.int64())
        yield pa.RecordBatch.from_arrays([none] * 5 + [pa.array(chunks, pa.int32()), pa.array(packed, pa.binary())], PROFILE)

    return docs.mapInArrow(run, "doc_id long, n long, h1 long, h2 long, first long, chunk int, counts binary")


PROFILE = ["doc_id", "n", "h1", "h2", "first", "chunk", "counts"]


def _rarity(chunks: DataFrame) -> np.ndarray:
    """Rank of each sketch cell by its count; chunk sums are added up in two levels, and the sketch has a fixed size."""

    def add(key: tuple[Any, ...], rows: pa.Table) -> pa.Table:
        total = np.zeros(1 << CHUNK_BITS, np.uint32)
        for x in rows["counts"]:
            total += np.frombuffer(zlib.decompress(x.as_py()), np.uint32)
        return pa.table({"chunk": pa.array([key[0].as_py()], pa.int32()), "counts": [zlib.compress(total.tobytes(), 1)]})

    dealt = chunks.select("chunk", "counts", F.pmod(F.xxhash64("counts"), F.lit(64)).alias("part"))
    first = dealt.groupBy("chunk", "part").applyInArrow(add, "chunk int, counts binary")
    total = np.zeros(1 << SKETCH_BITS, np.uint32)
    for row in first.groupBy("chunk").applyInArrow(add, "chunk int, counts binary").collect():
        total[row.chunk << CHUNK_BITS:(row.chunk + 1) << CHUNK_BITS] = np.frombuffer(zlib.decompress(row.counts), np.uint32)
    return np.minimum(np.log(np.maximum(total, 1)) / np.log(LEVEL), 63).astype(np.uint8)


def _slice_of(n: int) -> int:
    """Bitmaps hold every 2**slice-th token, so that they do not fill up; by size step, so alike within a node."""
    return max(0, int(np.log2(max(1, SIZE_STEP ** _step(n)) / 512)))


def _step(n: int) -> int:
    return int(np.log(n) / np.log(SIZE_STEP))


def _leaves(docs: DataFrame, rarity: np.ndarray, words: int, percent: int) -> DataFrame:
    """Per document with shingles: sizes, class hashes, prefix tokens and bitmap."""
    shared = docs.sparkSession.sparkContext.broadcast(rarity)  # 2 MB whatever the input
    mask = np.uint64(len(rarity) - 1)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        level = shared.value
        out = {c: [] for c in ("doc_id", "n", "h1", "h2", "first", "step", "slice", "bits", "tokens", "bitmap")}
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            s = shingle_set(text, words)
            n = len(s)
            if not n:
                continue
            order = (level[(s & mask).astype(np.int64)].astype(np.uint64) << np.uint64(57)) | (s >> np.uint64(7))
            p = n + (-percent * n // 100) + 1  # n - ceil(percent n / 100) + 1
            if p < n:
                order = order[order <= np.partition(order, p - 1)[p - 1]]  # ties come along
            skip = _slice_of(n)
            told = s[((s >> np.uint64(40)) & np.uint64((1 << skip) - 1)) == 0]
            bitmap = np.zeros(1024, bool)
            bitmap[((told >> np.uint64(20)) & np.uint64(1023)).astype(np.int64)] = True
            h1, h2 = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), "<i8").tolist()
            for c, v in zip(out, (doc_id, n, h1, h2, int(s[:1].view("<i8")[0]), _step(n), skip, int(bitmap.sum()), order.view("<i8"),
                                  np.packbits(bitmap).view("<i8"))):
                out[c].append(v)
        names = list(out)
        kinds = [pa.int64()] * 8 + [pa.list_(pa.int64())] * 2
        yield pa.RecordBatch.from_arrays([pa.array(out[c], k) for c, k in zip(names, kinds)], names)

    return docs.mapInArrow(
        per_batch(run), "doc_id long, n long, h1 long, h2 long, first long, step long, slice long, bits long, tokens array<long>,"
        " bitmap array<long>")


def _blocks(leaves: DataFrame) -> DataFrame:
    """Leaves (doc_id, n, first, step, slice, bits, bitmap, component) with their block.

    A node has the leaves of one least hash and size step. Those of a component that has many leaves there stand
    apart from the rest, so that blocks of one component, between which nothing is left to find, do not mix with
    others; small components share blocks.
    """
    many = leaves.groupBy("first", "step", "component").agg(F.count(F.lit(1)).alias("_m")).where(F.col("_m") >= LEAVES // 4).select(
        "first", "step", "component", F.col("component").alias("_apart"))
    apart = leaves.join(many, ["first", "step", "component"], "left")
    nodes = apart.groupBy("first", "step", "_apart").agg(F.count(F.lit(1)).alias("_k"), F.sum("n").alias("_s")).select(
        F.col("first").alias("_first"), F.col("step").alias("_step"), F.col("_apart").alias("_of"),
        F.ceil(F.greatest(F.col("_k") / LEAVES, F.col("_s") / BLOCK_SHINGLES)).alias("_parts"))
    at = (F.col("first") == F.col("_first")) & (F.col("step") == F.col("_step")) & F.col("_apart").eqNullSafe(F.col("_of"))
    part = F.pmod(F.xxhash64("doc_id", "n"), F.col("_parts"))
    return apart.join(nodes, at).withColumn("block", F.xxhash64("first", "step", F.coalesce("_apart", F.lit(-1)), F.col("_apart").isNull(), part)).drop(
        "_parts", "_first", "_step", "_of", "_apart")


def _signatures(blocks: DataFrame) -> DataFrame:
    ors = [F.bit_or(F.get("bitmap", F.lit(i))).alias(b) for i, b in enumerate(BITMAP)]
    return blocks.groupBy("block").agg(
        F.count(F.lit(1)).alias("leaves"), F.min("n").alias("n_min"), F.max("n").alias("n_max"), F.min("bits").alias("bits_min"),
        F.min("slice").alias("slice_min"), F.max("slice").alias("slice_max"),
        F.min("component").alias("c_min"), F.max("component").alias("c_max"), *ors)


def _can_link(percent: int) -> F.Column:
    """Whether leaves of blocks x and y can be similar enough, by sizes and by the largest possible overlap."""
    sizes = (F.col("x.n_max") * 100 >= F.col("y.n_min") * percent) & (F.col("y.n_max") * 100 >= F.col("x.n_min") * percent)
    common = sum((F.bit_count(F.col(f"x.{b}").bitwiseAND(F.col(f"y.{b}"))) for b in BITMAP[1:]),
                 F.bit_count(F.col(f"x.{BITMAP[0]}").bitwiseAND(F.col(f"y.{BITMAP[0]}"))))
    # at least that many tokens of any leaf are missing on the other side
    alone = {s: F.greatest(F.lit(0), F.col(f"{s}.bits_min") - common) for s in "xy"}
    overlap = F.least(F.col("x.n_max") - alone["x"], F.col("y.n_max") - alone["y"])
    enough = overlap * (100 + percent) >= (F.col("x.n_min") + F.col("y.n_min")) * percent
    one_slice = (F.col("x.slice_min") == F.col("x.slice_max")) & (F.col("y.slice_min") == F.col("y.slice_max")) & (
        F.col("x.slice_min") == F.col("y.slice_min"))
    return sizes & (~one_slice | enough)


def _pairs(met: DataFrame, signatures: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (x, y) of blocks that met, those that can hold a link.

    ``shared``, where given, bounds the prefix tokens that two leaves share. Common tokens of two sets lie in both
    prefixes or behind the one that ends first, so similar sets share many of them unless their sizes differ.
    """
    held = met.alias("p").join(signatures.alias("x"), F.col("p.x") == F.col("x.block")).join(
        signatures.alias("y"), F.col("p.y") == F.col("y.block"))
    open_ = (F.col("x.c_min") != F.col("x.c_max")) | (F.col("y.c_min") != F.col("y.c_max")) | (F.col("x.c_min") != F.col("y.c_min"))
    least, most = F.least("x.n_min", "y.n_min"), F.greatest("x.n_max", "y.n_max")
    share = F.col("p.shared") * (100 * (100 + percent)) >= least * (100 * percent) - most * (percent * percent)
    return held.where(open_ & _can_link(percent) & F.coalesce(share, F.lit(True))).select(
        F.col("p.x").alias("x"), F.col("p.y").alias("y"))


def _asked(blocks: DataFrame, signatures: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The leaves to compare for each pair of blocks: one step further down, those that can link with the other block.

    Rows (x, y, side, doc_id, n, h1, h2, component); pairs that keep leaves on one side only are left out.
    """
    one = blocks.select(
        "block", "doc_id", "n", "h1", "h2", "component", F.col("n").alias("n_min"), F.col("n").alias("n_max"),
        F.col("bits").alias("bits_min"), F.col("slice").alias("slice_min"), F.col("slice").alias("slice_max"),
        *[F.get("bitmap", F.lit(i)).alias(b) for i, b in enumerate(BITMAP)]).alias("x")
    out = ["doc_id", "n", "h1", "h2", "component"]

    def side(here: str, there: str, number: int) -> DataFrame:
        across = pairs.where("x <> y").alias("p").join(signatures.alias("y"), F.col(f"p.{there}") == F.col("y.block"))
        held = across.join(one, (F.col(f"p.{here}") == F.col("x.block")) & _can_link(percent))
        return held.select(F.col("p.x").alias("x"), F.col("p.y").alias("y"), F.lit(number).alias("side"), *[F.col(f"x.{c}") for c in out])

    both = staged(side("x", "y", 0).unionByName(side("y", "x", 1)), "leaf-pairs")
    alive = both.groupBy("x", "y").agg(F.min("side").alias("lo"), F.max("side").alias("hi")).where("lo <> hi").select("x", "y")
    own = pairs.where("x = y").join(blocks.select("block", *out), F.col("x") == F.col("block")).select(
        "x", "y", F.lit(0).alias("side"), *out)
    return both.join(alive, ["x", "y"], "left_semi").unionByName(own)


def linked_leaves(start: list[int], side: list[int], sets: list[np.ndarray], percent: int, within: bool) -> list[tuple[int, int]]:
    """(component, least component joined with it) of the leaves of one pair of blocks, whose components are ``start``.

    Links between leaves that are joined already are not looked for.
    """
    root = list(range(len(start)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    named: dict[int, int] = {}
    for i, c in enumerate(start):
        root[i] = named.setdefault(c, i)
    left, right = [i for i in range(len(start)) if side[i] == 0], [i for i in range(len(start)) if side[i] == (0 if within else 1)]
    sizes = np.array([len(sets[i]) for i in right])
    owner = np.repeat(np.arange(len(right)), sizes)
    token = np.concatenate([sets[i] for i in right]) if right else np.empty(0, np.uint64)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    for i in left:
        n = len(sets[i])
        fit = np.flatnonzero((sizes * 100 >= n * percent) & (n * 100 >= sizes * percent))
        mine = find(i)
        if not any(find(right[j]) != mine for j in fit):
            continue
        lo, hi = np.searchsorted(token, sets[i], "left"), np.searchsorted(token, sets[i], "right")
        runs = hi - lo
        place = np.repeat(hi - np.cumsum(runs), runs) + np.arange(runs.sum())
        overlap = np.bincount(owner[place], minlength=len(right))
        for j in fit[100 * overlap[fit] >= percent * (n + sizes[fit] - overlap[fit])]:
            a, b = find(i), find(right[j])
            if a != b:
                root[b] = a
    least: dict[int, int] = {}
    for c, i in named.items():
        least[find(i)] = min(c, least.get(find(i), c))
    return [(c, least[find(i)]) for c, i in named.items() if c != least[find(i)]]


def _compare(docs: DataFrame, blocks: DataFrame, signatures: DataFrame, pairs: DataFrame, words: int, percent: int, once) -> DataFrame:
    """Links (a, b) found in pairs of blocks. Only documents that a fixed-size filter lets through are cut up again."""
    pairs = staged(pairs, "pairs")
    asked = staged(_asked(blocks, signatures, pairs, percent), "asked")
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << FILTER_BITS))
    bits = asked.select("doc_id").distinct().groupBy(F.shiftright(place, 6).alias("w")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast(pmod(xxhash64(doc_id), {1 << FILTER_BITS}L) % 64 as int))")).alias("v"))
    passed = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    for row in bits.collect():  # at most 2**17 rows
        passed[row.w] = row.v
    shared = docs.sparkSession.sparkContext.broadcast(passed)

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        held, place = shared.value, batch.column(2).to_numpy()
        keep = np.flatnonzero((held[place >> 6] >> (place & 63)) & 1)
        ids, out = [], []
        for i in keep.tolist():
            s = shingle_set(batch.column(1)[i].as_py(), words)
            if len(s):
                ids.append(batch.column(0)[i].as_py())
                out.append(s)
        halves = np.frombuffer(b"".join(xxhash.xxh3_128_digest(s.tobytes()) for s in out), "<i8").reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array([s.tobytes() for s in out], pa.binary())],
            ["doc_id", "h1", "h2", "tokens"])

    sets = docs.select("doc_id", "text", place.alias("place")).mapInArrow(
        per_batch(cut), "doc_id long, h1 long, h2 long, tokens binary")

    def compare(key: tuple[Any, ...], rows: pa.Table) -> pa.Table:
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["tokens"]]
        found = linked_leaves(rows["component"].to_pylist(), rows["side"].to_pylist(), sets, percent, key[0] == key[1])
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})

    return asked.join(once(sets), ["doc_id", "h1", "h2"]).select("x", "y", "component", "side", "tokens").groupBy(
        "x", "y").applyInArrow(compare, "a long, b long")


def jaccard_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id of every document row.

    Documents link when 100 * intersection >= ``percent`` * union of their sets of ``words``-word shingles; a
    component has the name of its smallest doc_id. Sets are compared by 64-bit shingle hashes.

    Null or empty text, or no words: n_shingles 0, linked with nothing. Fewer words than ``words``: one shingle of
    them all. Rows with one doc_id are one document, which links where any of its texts does. A null doc_id links
    with nothing and has a null component_id. An empty table gives an empty result. Columns besides id and text are
    not read.
    """
    slim = id_and_text(docs)
    profile = staged(_profile(slim, words), "profiles")
    rows = profile.where("chunk is null").select("doc_id", "n", "h1", "h2", "first")
    classes = staged(
        rows.where("n > 0 and doc_id is not null").groupBy("h1", "h2").agg(F.min("doc_id").alias("rep")), "classes")
    rarity = _rarity(profile.where("chunk is not null"))
    repeated = not rows.where("n > 0").groupBy("doc_id", "h1", "h2").count().where("count > 1").isEmpty()
    once = (lambda df: df.dropDuplicates(["doc_id", "h1", "h2"])) if repeated else (lambda df: df)
    leaves = staged(once(
        _leaves(slim.where("doc_id is not null"), rarity, words, percent)
        .join(classes.withColumnRenamed("rep", "doc_id"), ["doc_id", "h1", "h2"], "left_semi")), "leaves")

    placed = leaves.select("doc_id", "n", F.explode("tokens").alias("token"))
    met = placed.groupBy("token").agg(F.min(F.struct("doc_id", "n")).alias("lo"), F.max(F.struct("doc_id", "n")).alias("hi")).where(
        "lo <> hi").select("token")
    tokens = staged(placed.join(met, "token", "left_semi"), "shared-tokens")
    leaves = leaves.drop("tokens")

    # first walk: nodes by least hash
    blocks = staged(_blocks(leaves.withColumn("component", F.col("doc_id"))), "blocks")
    signed = staged(_signatures(blocks), "signatures")
    homes = tokens.join(blocks.select("doc_id", "n", "block"), ["doc_id", "n"]).select("token", "block").distinct()
    hubs = homes.groupBy("token").agg(F.min("block").alias("x"))
    stars = homes.join(hubs, "token").where("x <> block").groupBy(F.col("block").alias("y"), "x").count().groupBy("y").agg(
        F.max_by("x", F.struct("count", "x")).alias("x"))
    alone = signed.where("leaves > 1").select(F.col("block").alias("y"), F.col("block").alias("x"))
    links = _compare(slim, blocks, signed, _pairs(stars.unionByName(alone).withColumn("shared", F.lit(None).cast("long")), signed, percent), words, percent, once)

    # rows of one doc_id with different texts are one document
    named = rows.where("n > 0 and doc_id is not null").join(classes, ["h1", "h2"])
    several = named.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a <> b")
    same = named.join(several.select("doc_id", "a"), "doc_id").select("a", F.col("rep").alias("b"))
    found = staged(components(links.unionByName(same)), "first-components")

    # second walk: the nodes again, large components apart
    known = leaves.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").withColumn(
        "component", F.coalesce("component", "doc_id"))
    blocks = staged(_blocks(known), "blocks")
    signed = staged(_signatures(blocks), "signatures")
    homes = tokens.join(blocks.select("doc_id", "n", "block", "component"), ["doc_id", "n"]).groupBy("token", "block").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"))
    mixed = homes.groupBy("token").agg(F.min("lo").alias("least"), F.max("hi").alias("most")).where("least <> most").select("token")
    homes = staged(homes.join(mixed, "token", "left_semi"), "homes")
    other = homes.select("token", F.col("block").alias("y"), F.col("lo").alias("y_lo"), F.col("hi").alias("y_hi"))
    # all four equal: both blocks of one component as far as this token goes
    crossed = homes.join(other, "token").where("block < y and (lo <> y_hi or hi <> y_lo)").groupBy(F.col("block").alias("x"), "y").agg(
        F.count(F.lit(1)).alias("shared"))
    within = signed.where("c_min <> c_max").select(F.col("block").alias("x"), F.col("block").alias("y"), F.lit(None).cast("long").alias("shared"))
    crossed = crossed.unionByName(within)
    more = _compare(slim, blocks, signed, _pairs(crossed, signed, percent), words, percent, once)
    final = components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionByName(more))

    label = classes.join(final.withColumnRenamed("id", "rep"), "rep", "left").select(
        "h1", "h2", F.coalesce("component", "rep").alias("component_id"))
    return rows.join(label, ["h1", "h2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def one_of_each_group(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """Documents that are the smallest of their component, with all their columns; rows equal in id and text stay once.

    Rows without words or without doc_id stay.
    """
    groups = staged(jaccard_components(docs, words, percent).select("doc_id", "component_id"), "groups")
    gone = groups.where("doc_id <> component_id").select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])
    repeated = groups.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1")
    return left if repeated.isEmpty() else left.dropDuplicates(["doc_id", "text"])
