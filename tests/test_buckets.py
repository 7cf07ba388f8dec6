"""Scoring of tables stored by slot and element."""

from bandwatch import fixtures as fx
from bandwatch.catalog import scoring as catalog
from bandwatch.plans import scoring as plan

SF = "/root/testdata/sf0.001"


def test_no_exchange_between_scans_and_element_scores(spark):
    actual, banded = catalog.bucketed(spark, SF)
    kpis, elements = plan.co_located_scores(actual, banded, fx.kpi_rules(spark), fx.weights(spark), fx.RUN_TIME)
    got = sorted(map(str, elements.collect()))
    text = elements._jdf.queryExecution().executedPlan().toString()
    # rule and weight tables are local and small, their broadcasts are decided by size
    assert "Exchange" not in text.replace("BroadcastExchange", "") and text.count("Bucketed: true") >= 2
    want = catalog.elements(spark, SF).select(elements.columns)
    assert got == sorted(map(str, want.collect())) and got
    # repeated readings count once
    twice = plan.co_located_scores(actual.unionByName(actual), banded, fx.kpi_rules(spark), fx.weights(spark), fx.RUN_TIME)[1]
    assert sorted(map(str, twice.collect())) == got
    assert kpis.where("minId is null").count() == 0
