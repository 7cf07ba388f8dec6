"""Exact token counts for every context limit from one histogram of encoded lengths."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandwatch.llm.stage import id_and_text, per_batch, staged
from bandwatch.llm.tokenizing import BYTE_BPE, ROWS, encoder, vocabulary

BLOCK = 1024


def encoded_lengths(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, n_tokens) of whole texts; null text is empty and has none."""
    tokenizer = tokenizer or vocabulary(BYTE_BPE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(tokenizer)

        def count(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            texts = batch.column(1)
            lengths = [len(ids) // 4 if n else 0 for ids, n in zip(code.encode_all(texts), pc.binary_length(texts).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lengths, pa.int64())], ["doc_id", "n_tokens"])

        yield from per_batch(count, ROWS)(batches)
        code.settle()

    return id_and_text(docs).mapInArrow(run, "doc_id long, n_tokens long")


def length_table(lengths: DataFrame) -> DataFrame:
    """A row per length that occurs, taken as a context limit, with what suffix sums say about it.

    n_docs have that length; n_docs_from and n_tokens_from count documents at least that long and their tokens;
    n_docs_upto, share_upto and n_tokens_upto those at most that long; truncated_tokens is what is left when all
    documents are cut at it. A quantile q is the first length whose share_upto reaches q. Limits between two rows
    follow from the next longer row (``truncated_at``).

    Sums run in two levels: within blocks of 1,024 lengths, and over the blocks' totals, of which there are
    (longest document / 1,024). An empty table gives no rows; null lengths do not count. The histogram is written out
    first, so that lengths are worked out once.
    """
    histogram = staged(lengths.where(F.col("n_tokens").isNotNull()).groupBy(F.col("n_tokens").alias("length")).agg(
        F.count(F.lit(1)).alias("n_docs")), "lengths").withColumn("_block", F.floor(F.col("length") / BLOCK))
    tokens = F.col("length") * F.col("n_docs")
    blocks = histogram.groupBy("_block").agg(F.sum("n_docs").alias("_d"), F.sum(tokens).alias("_t"))
    longer = Window.orderBy(F.desc("_block"))
    later = longer.rowsBetween(Window.unboundedPreceding, -1)
    every = longer.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "_block", F.coalesce(F.sum("_d").over(later), F.lit(0)).alias("_d"), F.coalesce(F.sum("_t").over(later), F.lit(0)).alias("_t"),
        F.sum("_d").over(every).alias("_all_d"), F.sum("_t").over(every).alias("_all_t"))
    inside = Window.partitionBy("_block").orderBy(F.desc("length"))
    summed = histogram.join(blocks, "_block").select(
        "length", "n_docs", "_all_d", "_all_t",
        (F.sum("n_docs").over(inside) + F.col("_d")).alias("n_docs_from"),
        (F.sum(tokens).over(inside) + F.col("_t")).alias("n_tokens_from"))
    docs_upto = F.col("_all_d") - F.col("n_docs_from") + F.col("n_docs")
    return summed.select(
        "length", "n_docs", "n_docs_from", "n_tokens_from",
        docs_upto.alias("n_docs_upto"),
        (F.col("_all_t") - F.col("n_tokens_from") + tokens).alias("n_tokens_upto"),
        (docs_upto / F.col("_all_d")).alias("share_upto"),
        (F.col("_all_t") - F.col("n_tokens_from") + F.col("length") * F.col("n_docs_from")).alias("truncated_tokens"),
    )


def truncated_at(table: DataFrame, limit: int | Column) -> DataFrame:
    """Tokens left when every document is cut at ``limit``, which need not occur as a length."""
    limit = F.lit(limit) if isinstance(limit, int) else limit
    short = F.when(F.col("length") <= limit, F.col("length") * F.col("n_docs"))
    return table.agg(
        (F.coalesce(F.sum(short), F.lit(0)) + limit * F.coalesce(F.sum(F.when(F.col("length") > limit, F.col("n_docs"))), F.lit(0)))
        .alias("truncated_tokens"))


def token_counts(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    """``length_table`` of the encoded lengths of all documents."""
    return length_table(encoded_lengths(docs, tokenizer))
