"""Tables written between steps, and Arrow batches in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwatch.session import work_dir

BATCH_BYTES = 4 << 20


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back, which cuts its lineage."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(df: DataFrame) -> int:
    """Shuffle partitions of the session, for places that must name a count."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def id_and_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Only what an operator reads, so that other columns cannot clash with its own."""
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def lower_ascii_sql(c: str) -> str:
    """DuckDB text for A-Z in lower case and nothing else."""
    return f"translate({c}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def below_share(order: Column, most: int, total: int) -> Column:
    """Whether a 64-bit hash lies among the least, so that about twice ``most`` of ``total`` rows do.

    For a sample of the ``most`` least hashes: with it no task has ``most`` rows to send for the sort.
    """
    share = min(1.0, (2 * most + 100) / max(1, total))
    return F.lit(True) if share == 1 else order < F.lit(int(-(2**63) + share * 2**64)).cast("long")


def quotas(totals: dict, most: int) -> dict:
    """How many rows of each class a sample of ``most`` takes: as many of each, what small classes leave goes to larger ones."""
    out, left = {}, most
    for i, (k, n) in enumerate(sorted(totals.items(), key=lambda kn: (kn[1], kn[0]))):
        out[k] = min(n, left // (len(totals) - i))
        left -= out[k]
    return out


def per_batch(fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]], rows: int = 1000):
    """Function for ``mapInArrow`` that hands on slices of at most ``rows`` rows, which bounds what a task holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, rows):
                yield from fn(batch.slice(start, rows))

    return run


def small_batches(spark: SparkSession) -> None:
    """From now on Spark hands tasks Arrow batches of some ``BATCH_BYTES``, or of one row that is larger.

    Its own bound of 64 MB holds for each batch in the JVM, where buffers double, and again in the Python worker.
    Plans read the setting when they run, so it stays set in the session.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def null_safe(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)
