"""Corpus preparation: languages, repeated lines, near copies, benchmark passages, packing.

Every stage takes what its predecessor kept, and all but the last return documents
with the columns they came with. ``run`` hands each result on as a written table in
the shared folder, so a lost executor costs one stage at most. Executors hold texts in
small batches in all stages.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from bandwatch.llm.decontaminate import without_benchmark
from bandwatch.llm.jaccard import one_of_each_group
from bandwatch.llm.language import in_known_languages
from bandwatch.llm.lines import without_repeated_lines
from bandwatch.llm.packing import pack
from bandwatch.llm.stage import small_batches, staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def in_small_batches(stage: Stage) -> Stage:
    @wraps(stage)
    def call(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return stage(spark, docs, sf_dir)

    return call


@in_small_batches
def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: texts without a letter, or of no language the model tells with a score of 0.5, go."""
    return in_known_languages(docs)


@in_small_batches
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: texts lose lines that at least five documents hold, but for the largest id."""
    return without_repeated_lines(docs)


@in_small_batches
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """N-gram Jaccard join over five-word shingles at 0.8: of each group, the document with the smallest id stays."""
    return one_of_each_group(docs, words=5, percent=80)


@in_small_batches
def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents with a passage of the benchmark go."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@in_small_batches
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packing: pieces of sequences of 4,096 tokens along the curve, with their ids' checksums."""
    return pack(docs, digest=True)


STAGES = [
    ("language_id", known_languages),
    ("line_dedup", drop_repeated_lines),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_benchmark),
    ("packing", pack_sequences),
]

# models and tokenizers are beyond SQL; tests/llm/test_pipeline.py compares with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed pieces of the ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{name}")
    return docs
