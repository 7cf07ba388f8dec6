"""Packing along a space-filling curve.

A document's tokens are hashed to a vector, the vector is projected to a few
dimensions, and its cell's place on a Hilbert curve is the sort key: neighbours on
the curve use similar tokens. Laid end to end in that order, the documents are cut
every ``size`` tokens, so only the last sequence has padding.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bandwatch.llm.stage import id_and_text, per_batch, small_batches, staged
from bandwatch.llm.tokenizing import ROWS, WORD_BPE, encoder, vocabulary

SIZE = 4096
END_ID = 2
DIMENSIONS = 4
BITS = 12
BUCKETS = 256
SEED = 11
SPREAD = 12.0  # projections of unit vectors have a deviation of about 1/16


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of points with unsigned coordinates below 2**bits, one point per row.

    Gray-code rotation from the highest bit down, then the coordinates' bits interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] ^= np.where(high, p, swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn = np.where(x[n - 1] & q, turn ^ (q - 1), turn)
        q >>= 1
    x ^= turn
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def curve_key(vectors: np.ndarray) -> np.ndarray:
    """Hilbert keys of hashed count vectors, one per row."""
    plan = np.random.default_rng(SEED).standard_normal((BUCKETS, DIMENSIONS)) / np.sqrt(BUCKETS)
    length = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    flat = (vectors / np.maximum(length, 1)) @ plan
    cells = np.floor((1 << BITS) / (1 + np.exp(-SPREAD * flat)))
    return hilbert_keys(np.minimum(cells, (1 << BITS) - 1), BITS)


def _hashed(ids: np.ndarray) -> np.ndarray:
    return np.bincount((ids * np.uint32(2654435761)) >> np.uint32(24), minlength=BUCKETS)


def encoded(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """(row, doc_id, key, n, ids): one row per document row; ``row`` tells rows of one doc_id apart."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, last = encoder(tokenizer), struct.pack("<I", end_id)
        width = 2 if max(code.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16 else 4
        row = TaskContext.get().partitionId() << 33

        def some(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            nonlocal row
            ids = [np.frombuffer(x + last, "<u4") for x in code.encode_all(batch.column(1))]
            keys = curve_key(np.array([_hashed(x) for x in ids], float))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(row, row + len(ids))), batch.column(0), pa.array(keys),
                 pa.array([len(x) for x in ids], pa.int64()), pa.array([x.astype(f"<u{width}").tobytes() for x in ids], pa.binary())],
                ["row", "doc_id", "key", "n", "ids"])
            row += len(ids)

        yield from per_batch(some, ROWS)(batches)
        code.settle()

    return id_and_text(docs).mapInArrow(encode, "row long, doc_id long, key long, n long, ids binary")


def places(rows: DataFrame) -> DataFrame:
    """(row, at): ids of all documents before each along the curve.

    Rows are dealt by ranges of (key, doc_id, row), so many equal keys make no large task; each range is summed by
    itself and moved by the totals of the ranges before it, of which there is one per task.
    """
    order = ["key", "doc_id", "row"]
    dealt = staged(
        rows.select(*order, "n").repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "curve-order")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("_range").agg(F.sum("n").alias("_n")).select(
        "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        dealt.withColumn("_at", F.coalesce(F.sum("n").over(within), F.lit(0)))
        .join(totals, "_range").select("row", (F.col("_at") + F.col("_before")).alias("at"))
    )


def pack(docs: DataFrame, size: int = SIZE, tokenizer: str | None = None, end_id: int = END_ID, digest: bool = False) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, doc_tokens, sequence_id, offset, ids (``digest``: ids_crc32).

    A document is its tokens and ``end_id``; every id lies in one piece, and the pieces of a sequence lie end to
    end from offset 0. All sequences but the last are full.

    Null or empty text: the end id only. Rows with one doc_id, or null ones, are packed one by one. An empty table
    gives no pieces. Columns besides id and text are not read.
    """
    small_batches(docs.sparkSession)
    rows = staged(encoded(docs, tokenizer or vocabulary(WORD_BPE), end_id), "encoded")
    kind = pa.int64() if digest else pa.list_(pa.int64())

    def cut(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for doc_id, n, raw, at in zip(*(batch.column(i).to_pylist() for i in range(4))):
            ids = np.frombuffer(raw, f"<u{len(raw) // n}").astype("<u4")
            start = 0
            while start < n:
                offset = (at + start) % size
                length = min(n - start, size - offset)
                piece = ids[start:start + length]
                out.append((doc_id, start, length, n, (at + start) // size, offset, zlib.crc32(piece.tobytes()) if digest else piece))
                start += length
        names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
        columns = list(zip(*out)) or [()] * 7
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns[:6]] + [pa.array(list(columns[6]), kind)], [*names, "ids"])

    last = "long" if digest else "array<long>"
    pieces = rows.join(places(rows), "row").select("doc_id", "n", "ids", "at").mapInArrow(
        per_batch(cut, 200),
        f"doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long, ids {last}")
    return pieces.withColumnRenamed("ids", "ids_crc32") if digest else pieces
