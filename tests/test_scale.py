"""Plans: what is broadcast, what moves, and that results do not depend on it."""

import datetime as dt

import pytest

from bandwatch import rules
from bandwatch.operators import scoring
from bandwatch.plans.scoring import kpi_score_table, score
from bandwatch.session import work_dir
from tests.helpers import actual, forecasts, rows

KPIS = ["5gcUpfPduSessSuccRate", "5gcUpf7560Num", "5gcUpfSysAvgLoadCpu"]
RUN = dt.datetime(2024, 3, 2)


@pytest.fixture(scope="module")
def tables(spark):
    grid = [(f"e{i}", k, s, float(10 + (i * 7 + s * 3) % 90)) for i in range(40) for k in KPIS for s in range(6)]
    # one slot and KPI with a third of all rows
    grid += [(f"x{i}", KPIS[0], 0, float(i % 101)) for i in range(360)]
    a, f = work_dir(spark, "a"), work_dir(spark, "f")
    actual(spark, [(r, k, s, v * 0.8) for r, k, s, v in grid]).write.parquet(a)
    forecasts(spark, grid).write.parquet(f)
    return spark.read.parquet(a), spark.read.parquet(f)


def test_rules_are_broadcast_by_size_only(spark, tables):
    scored = kpi_score_table(*tables, rules.kpi_rules(spark), RUN)
    text = scored._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "LocalTableScan" in text and "BroadcastHashJoin" in text


def test_same_result_without_broadcasts(spark, tables):
    args = (rules.kpi_rules(spark), rules.kpi_weights(spark), RUN)
    want = [rows(t, *[c for c in t.columns]) for t in score(*tables, *args)]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    skew = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        adaptive: "-1",
        # split partitions of a few rows, so that the skew-join path runs
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1b",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "0.1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2kb",
    }
    kept = {k: spark.conf.get(k, None) for k in skew}
    try:
        for k, v in skew.items():
            spark.conf.set(k, v)
        got = [rows(t, *[c for c in t.columns]) for t in score(*tables, *args)]
    finally:
        for k, v in kept.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == want and len(want[0]) > 700


def test_staged_scoring_is_the_same(spark, tables):
    args = (*tables, rules.kpi_rules(spark), rules.kpi_weights(spark), RUN)
    plain, staged = score(*args, staged=False), score(*args)
    for a, b in zip(plain, staged):
        assert rows(a, *a.columns) == rows(b, *b.columns)


def test_rollup_needs_one_exchange_after_the_join(spark, tables):
    """Duplicates, weights and element sums run on the placement by slot and element."""
    scored = kpi_score_table(*tables, rules.kpi_rules(spark), RUN)
    rolled = scoring.element_scores(scoring.weighted_scores(scored, rules.kpi_weights(spark)), RUN)

    def exchanges(df):
        return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")

    assert exchanges(rolled) == exchanges(scored)


def test_filters_reach_the_scan(spark, tables):
    from bandwatch.operators.cleaning import valid_readings

    text = valid_readings(tables[0])._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(kpiValue,0.0)" in text
