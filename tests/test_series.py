"""Series operators against pandas on small fixtures."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from bandwatch.operators import series as ts
from bandwatch.plans.forecasting import prepare_series
from tests.helpers import T0, at, cells, rows


@pytest.fixture(scope="module")
def sparse(spark):
    """Two elements with gaps, an off-grid reading and an empty KPI."""
    rng = np.random.default_rng(5)
    out = []
    for e, length in (("a", 60), ("b", 35)):
        for k in ("x", "y"):
            for s in sorted(rng.choice(length, length // 2, replace=False)):
                out.append((e, k, int(s), float(rng.normal(50, 10))))
    out.append(("a", "x", at(3) + dt.timedelta(seconds=100), 1.0))
    out.append(("b", "z", 7, None))
    return cells(spark, out)


def brute_grid(pdf):
    frames = []
    for e, g in pdf.groupby("resId"):
        index = pd.date_range(g.recordTime.min(), g.recordTime.max(), freq="300s")
        wide = g.pivot(index="recordTime", columns="kpiId", values="kpiValue").reindex(index)
        wide = wide.dropna(axis=1, how="all")
        wide = wide.fillna(wide.median())
        wide.index.name, wide.columns.name = "recordTime", "kpiId"
        long = wide.stack().rename("v").reset_index()
        long["resId"] = e
        frames.append(long)
    return pd.concat(frames)


def test_grid_and_imputation(sparse):
    want = brute_grid(sparse.toPandas())
    expected = sorted((r.resId, r.kpiId, r.recordTime.to_pydatetime(), round(r.v, 9)) for r in want.itertuples())
    got = ts.impute_median(ts.drop_empty_series(ts.regular_grid(sparse, 300))).collect()
    assert sorted((r.resId, r.kpiId, r.recordTime, round(r.kpiValue, 9)) for r in got) == expected


def test_one_exchange_by_element(sparse):
    plan = prepare_series(sparse, 300)
    text = plan._jdf.queryExecution().executedPlan().toString()
    # the cell aggregate, the extents of its elements, and the placement by element
    assert text.count("Exchange hashpartitioning(resId") <= 4
    assert "SinglePartition" not in text and "Limit" not in text


def test_copies_collapse_before_windows(spark):
    """A third of all rows in one cell."""
    many = cells(spark, [("a", "x", 0, float(i % 7)) for i in range(500)] + [("a", "x", i, 1.0) for i in range(1, 1000)])
    out = ts.slot_cells(many)
    assert out.count() == 1000
    assert rows(out.where(F.col("recordTime") == F.lit(T0).cast("timestamp_ntz")), "kpiValue") == [(6.0,)]


def test_trailing_reading_between_slots(spark):
    """A last reading off the grid still sets where the grid ends."""
    df = cells(spark, [("a", "x", 0, 1.0), ("a", "x", 2, 3.0), ("a", "x", at(4) + dt.timedelta(seconds=9), 5.0)])
    values = [r.kpiValue for r in ts.regular_grid(df, 300).orderBy("recordTime").collect()]
    assert values == [1.0, None, 3.0, None, None]


def test_a_late_first_message_moves_no_grid(spark):
    late = cells(spark, [("a", "x", at(0) + dt.timedelta(seconds=7), 0.0)] + [("a", "x", i, float(i)) for i in range(1, 200)])
    got = prepare_series(late, 300).orderBy("recordTime").collect()
    assert [(r.recordTime, r.kpiValue, r.imputed) for r in got] == [(at(i), float(i), False) for i in range(200)]
    assert rows(ts.moved_readings(late, 300), "resId", "moved") == [("a", 1)]


def test_partitions_grow_with_the_elements(spark):
    few, many = (spark.range(n).selectExpr("cast(id as string) as resId", "'-1' as itemPara") for n in (50, 5000))
    assert ts.element_partitions(few) == ts.element_partitions(few.limit(1)) < 20 < ts.element_partitions(many) < 30


def test_strict_pivot_stops_at_a_second_reading(spark):
    twice = cells(spark, [("a", "x", 0, 1.0), ("a", "x", 0, 2.0), ("a", "y", 0, 1.0)])
    assert rows(ts.pivot_kpis(twice, ["x", "y"]), "x") == [(2.0,)]
    with pytest.raises(Exception, match="more than one reading"):
        ts.pivot_kpis(twice, ["x", "y"], strict=True).collect()


def test_pivot_round_trip(sparse):
    back = ts.unpivot_kpis(ts.pivot_kpis(sparse, ["x", "y"]), ["x", "y"]).where("kpiValue is not null")
    key = ("resId", "kpiId", "recordTime", "kpiValue")
    assert rows(back, *key) == rows(sparse.where("kpiId <> 'z'"), *key)


def full(spark, n, value=lambda i: float(i)):
    return cells(spark, [("e", "k", i, value(i)) for i in range(n)])


def test_supervised_and_sequences(spark):
    frame = ts.to_supervised(full(spark, 6), 2, 2)
    assert rows(frame, "lag_2", "lag_1", "lead_0", "lead_1") == [(i, i + 1, i + 2, i + 3) for i in (0.0, 1.0, 2.0)]
    pairs = ts.sliding_sequences(full(spark, 5), 2, 1).orderBy("recordTime").collect()
    assert [(r.seqIn, r.seqOut) for r in pairs] == [([i, i + 1], [i + 2]) for i in (0.0, 1.0, 2.0)]


@pytest.mark.parametrize("n,kept", [(239, 0), (240, 216)])
def test_block_edges(spark, n, kept):
    out = ts.train_test_blocks(full(spark, n))
    assert out.count() == kept
    if kept:
        parts = {(r.split, r.blockId): r["count"] for r in out.groupBy("split", "blockId").count().collect()}
        assert parts == {("train", 0): 72, ("train", 1): 72, ("test", 2): 72}


def test_constant_feature(spark):
    split = ts.chrono_split(full(spark, 10, lambda i: 5.0))
    out = ts.minmax_scale(split, ["kpiValue"])
    back = ts.unscale01(F.col("kpiValue_scaled"), F.col("kpiValue_min"), F.col("kpiValue_max"))
    assert set(rows(out.withColumn("b", back), "kpiValue_scaled", "b")) == {(0.0, 5.0)}


def test_scaling_limits(spark):
    split = ts.chrono_split(full(spark, 10))
    on_train = ts.minmax_scale(split, ["kpiValue"]).agg(F.max("kpiValue_max")).first()[0]
    on_parts = ts.minmax_scale(split, ["kpiValue"], fit_on_train=False).agg(F.max("kpiValue_max")).first()[0]
    assert (on_train, on_parts) == (6.0, 9.0)


def test_rolling_history_keeps_length(spark):
    old = full(spark, 10)
    fresh = cells(spark, [("e", "k", 12, 100.0), ("e", "k", 13, 101.0), ("new", "k", 3, 1.0), ("new", "k", 5, 3.0)])
    out = ts.roll_history(old, fresh, 300)
    kept = out.where("resId = 'e'").orderBy("recordTime").collect()
    assert [r.recordTime for r in kept] == [at(i) for i in range(4, 14)]
    assert [r.imputed for r in kept] == [False] * 6 + [True, True] + [False, False]
    # the gap between old and new rows is filled with the median of all cells
    assert kept[6].kpiValue == float(np.median(list(range(10)) + [100.0, 101.0]))
    assert out.where("resId = 'new'").count() == 3


def test_tail_horizon_extent(spark):
    df = full(spark, 5)
    assert rows(ts.series_tail(df, 2), "kpiValue") == [(3.0,), (4.0,)]
    ahead = ts.future_slots(ts.series_extent(df), 300, 3)
    assert rows(ahead, "stepAhead", "recordTime") == [(1, at(5)), (2, at(6)), (3, at(7))]


def test_duplicate_cells(spark):
    df = cells(spark, [("a", "x", 0, 1.0), ("a", "x", 0, 2.0), ("a", "x", 1, 1.0)])
    assert rows(ts.duplicate_cells(df), "recordTime", "n") == [(T0, 2)]
