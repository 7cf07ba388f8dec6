"""Exact group medians and top-k without a whole group in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


BINS = 200  # bins per factor e of a value: each is 0.5 % wide


def value_bin(v: Column, accuracy: int = BINS) -> Column:
    """Bin of a value on a logarithmic scale for both signs, 0 for zero; never falls as the value grows."""
    size = F.floor(F.least(F.ln(F.abs(v)), F.lit(720.0)) * accuracy) + 1000 * accuracy
    return F.when(v > 0, size).when(v < 0, -size).when(v == 0, F.lit(0))


def value_bins(df: DataFrame, keys: Sequence[str], value: Column, counted: Column | None = None,
               accuracy: int = BINS) -> DataFrame:
    """Sketch of the values of every group: a row per bin with ``n`` values, the least and the greatest of them.

    Where ``counted`` is given, ``n`` counts only its rows. Counts are exact, so the bin
    that holds a rank is known for certain. Sketches of batches add up: ``merge_bins``.
    """
    v = F.col("_v")
    hit = v.isNotNull() if counted is None else F.col("_counted")
    extra = [] if counted is None else [counted.alias("_counted")]
    return (
        df.select(*keys, value.alias("_v"), *extra)
        .groupBy(*keys, value_bin(v, accuracy).alias("bin"))
        .agg(F.count_if(hit).alias("n"), F.min(v).alias("low"), F.max(v).alias("high"))
    )


def merge_bins(first: DataFrame, *others: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sketch of all rows from the sketches of batches that share no row."""
    for o in others:
        first = first.unionByName(o)
    return first.groupBy(*keys, "bin").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def middle_bins(bins: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per group: the bins of its two middle ranks (null without values), both ranks counted
    from the first one's start, and the least value of the first and greatest of the second bin."""
    group = Window.partitionBy(*keys)
    before, n, total = F.col("_before"), F.col("n"), F.sum("n").over(group)
    one, two = (F.col("_holds1"), F.col("_holds2"))

    def holds(rank):
        return (n > 0) & (before < rank) & (before + n >= rank)

    return (
        bins.withColumns({
            "_before": F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)) - n,
            "_r1": F.floor((total + 1) / 2), "_r2": F.floor(total / 2) + 1,
        })
        .withColumns({"_holds1": holds(F.col("_r1")), "_holds2": holds(F.col("_r2"))})
        .groupBy(*keys)
        .agg(F.min(F.when(one, F.col("bin"))).alias("bin1"), F.min(F.when(two, F.col("bin"))).alias("bin2"),
             F.min(F.when(one, F.col("_r1") - before)).alias("rank1"), F.min(F.when(one, F.col("_r2") - before)).alias("rank2"),
             F.min(F.when(one, F.col("low"))).alias("low1"), F.max(F.when(two, F.col("high"))).alias("high2"))
    )


def in_middle(bin_: Column) -> Column:
    return F.coalesce((bin_ == F.col("bin1")) | (bin_ == F.col("bin2")), F.lit(False))


def ranked_values(values: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct values ``v`` with their counts ``n`` in the middle bins; ``first`` and ``second`` where they hold a middle rank.

    No value of a group lies between its two bins, so one running count serves both.
    """
    order = Window.partitionBy(*keys).orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    n, upto = F.col("n"), F.col("_upto")
    held = {name: F.when((n > 0) & (upto >= F.col(r)) & (upto - n < F.col(r)), F.col("v"))
            for name, r in (("first", "rank1"), ("second", "rank2"))}
    return values.withColumn("_upto", F.sum("n").over(order)).withColumns(held)


def group_median(df: DataFrame, keys: Sequence[str], value: Column, name: str, accuracy: int = BINS,
                 bins: DataFrame | None = None) -> DataFrame:
    """Exact median of ``value`` per group, null for groups without values.

    The built-in median keeps every distinct value of a group in one task's memory. So a
    sketch of exact counts per narrow bin (``bins``, or made here) says which bins hold the
    two middle ranks, and a second pass sorts the distinct values of these bins only. Rows
    are counted before each shuffle, the sorting spills, and there is no bracket that could
    miss. The bins are one row per group and are joined by key: broadcast while small, else
    shuffled with hot groups split by the skew-join settings. Two zeros of different sign are one value.
    """
    keys = list(keys)
    facts = df.select(*keys, value.alias("_v"))
    bins = value_bins(facts, keys, F.col("_v"), accuracy=accuracy) if bins is None else bins
    v = F.when(in_middle(value_bin(F.col("_v"), accuracy)), F.col("_v"))
    values = (
        facts.join(middle_bins(bins, keys), keys)
        .groupBy(*keys, "rank1", "rank2", v.alias("v")).agg(F.count(v).alias("n"))
    )
    median = F.lit(0.5) * F.max("first") + F.lit(0.5) * F.max("second")
    return ranked_values(values, keys).groupBy(*keys).agg(median.alias(name))


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    spread: Sequence[str], pieces: int = 64) -> DataFrame:
    """First ``k`` rows of every group; each piece keeps its own best before they meet."""
    group = list(group)
    dealt = df.withColumn("_piece", F.pmod(F.xxhash64(*spread), F.lit(pieces)))
    local = Window.partitionBy(*group, "_piece").orderBy(*order)
    final = Window.partitionBy(*group).orderBy(*order)
    return (
        dealt.withColumn("_rank", F.row_number().over(local))
        .where(F.col("_rank") <= k)
        .withColumn("_rank", F.row_number().over(final))
        .where(F.col("_rank") <= k)
        .drop("_piece")
        .withColumnRenamed("_rank", "rank")
    )
