"""Medians and top-k over lopsided groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from bandwatch.operators.skew import group_median, merge_bins, top_k_per_group, value_bin, value_bins


@pytest.fixture(scope="module")
def lopsided(spark):
    rng = np.random.default_rng(11)
    data = [("hot", float(v)) for v in rng.normal(0, 1, 5001)]
    data += [("ties", float(v)) for v in rng.integers(0, 3, 4000)]
    data += [(f"g{i % 40}", float(v)) for i, v in enumerate(rng.normal(5, 2, 900))]
    data += [("empty", None), ("one", 4.0), ("two", 1.0), ("two", 2.0), ("heavy", None)]
    data += [("heavy", float(10**i)) for i in range(12)]
    return spark.createDataFrame(data, "g string, v double").repartition(7)


@pytest.mark.parametrize("accuracy", [10_000, 200, 50])
def test_median_is_exact(lopsided, accuracy):
    got = {
        r.g: r.m
        for r in group_median(lopsided, ["g"], F.col("v"), "m", accuracy=accuracy).collect()
    }
    pdf = lopsided.toPandas().dropna()
    want = pdf.groupby("g").v.median().to_dict() | {"empty": None}
    assert got == want


def test_no_group_is_kept_whole(lopsided):
    plan = group_median(lopsided, ["g"], F.col("v"), "m")._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in plan and "median" not in plan and "raise_error" not in plan and "SinglePartition" not in plan


def test_bins_keep_the_order(spark):
    rng = np.random.default_rng(5)
    values = np.unique(np.concatenate([rng.normal(0, 1, 500), rng.normal(0, 1e-200, 50), rng.normal(0, 1e200, 50),
                                       [0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, np.inf, -np.inf]]))
    rows = spark.createDataFrame([(float(v),) for v in values], "v double").select("v", value_bin(F.col("v")).alias("b")).collect()
    bins = [r.b for r in sorted(rows, key=lambda r: r.v)]
    assert bins == sorted(bins) and None not in bins


def test_sketches_of_batches_add_up(lopsided):
    batch = F.pmod(F.xxhash64("v"), F.lit(3))
    parts = [value_bins(lopsided.where(F.coalesce(batch, F.lit(0)) == k), ["g"], F.col("v")) for k in range(3)]
    whole = value_bins(lopsided, ["g"], F.col("v"))
    merged = merge_bins(*parts, keys=["g"])
    assert sorted(map(str, merged.collect())) == sorted(map(str, whole.collect()))
    one, two = (sorted(map(str, group_median(lopsided, ["g"], F.col("v"), "m", bins=b).collect())) for b in (None, merged))
    assert one == two


def test_top_k(spark):
    df = spark.range(1000).select(F.lit("a").alias("g"), "id", (F.col("id") % 10).alias("n"))
    got = top_k_per_group(df, ["g"], [F.desc("n"), F.asc("id")], 5, ["id"], pieces=8).orderBy("rank").collect()
    assert [(r.rank, r.n, r.id) for r in got] == [(i + 1, 9, 9 + 10 * i) for i in range(5)]
