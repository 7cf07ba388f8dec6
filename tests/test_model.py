"""The recurrent model: gradients, determinism and fit."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from bandwatch import forecast, rules, schemas
from bandwatch.models import rnn
from bandwatch.sources.readings import history_scan
from bandwatch.plans import forecasting as plan
from bandwatch.schemas import RAW_TO_ACTUAL
from tests.helpers import T0, at, cells

SMALL = {**rules.MODEL_DEFAULTS, "hidden_size": 4}


@pytest.mark.parametrize("nonlinearity", ["tanh", "relu"])
@pytest.mark.parametrize("layers", [1, 2])
def test_gradients(nonlinearity, layers):
    config = {**SMALL, "nonlinearity": nonlinearity, "num_layers": layers}
    rng = np.random.default_rng(3)
    params = rnn.init_params(3, config, rng)
    x, y = rng.random((4, 5, 3)), rng.random((4, 5, 3))
    state = rng.random((layers, 5, 4)) * 0.3

    def loss():
        return np.mean((rnn.forward(params, x, state, config)[0] - y) ** 2)

    out, _, cache = rnn.forward(params, x, state, config)
    grads = rnn.backward(params, cache, 2 * (out - y) / y.size, config)
    for name, value in params.items():
        flat = value.reshape(-1)
        for i in rng.choice(flat.size, min(6, flat.size), replace=False):
            keep, h = flat[i], 1e-6
            flat[i] = keep + h
            up = loss()
            flat[i] = keep - h
            down = loss()
            flat[i] = keep
            assert grads[name].reshape(-1)[i] == pytest.approx((up - down) / (2 * h), abs=1e-6)


def test_config_is_checked():
    with pytest.raises(ValueError, match="bidirectional"):
        rnn.fit_predict({**SMALL, "bidirectional": True})
    with pytest.raises(ValueError, match="nonlinearity"):
        rnn.fit_predict({**SMALL, "nonlinearity": "gelu"})


def raw(spark, n=300):
    """A sinusoid with a period of one block for one element, too few rows for another."""
    wave = [("sine", k, i, 50 + a * np.sin(2 * np.pi * i / 72)) for k, a in (
        ("5gcUpfSysAvgLoadCpu", 30), ("5gcUpfSysAvgLoadMe", 20)) for i in range(n)]
    short = [("short", "5gcUpfSysAvgLoadCpu", i, 1.0) for i in range(100)]
    df = cells(spark, [(r, k, s, float(v)) for r, k, s, v in wave + short])
    return df.select(
        "resId", F.lit("n").alias("nodeCode"), F.lit("DEV_5G_U_HW_COM").alias("deviceSet"), "itemPara", "recordTime",
        "kpiId", "kpiValue",
    ).select(*RAW_TO_ACTUAL.values())


RUN = T0 + dt.timedelta(days=4)


def test_forecast_table(spark):
    args = (raw(spark, 900), rules.resource_rules(spark), rules.kpi_rules(spark), RUN)
    out = forecast(*args)
    assert out.schema.names == schemas.FORECAST.names
    got = out.collect()
    # the short element has no test block
    assert {r.resId for r in got} == {"sine"} and len(got) == 2 * 72
    assert {r.resourceType for r in got} == {"UPF"} and {r.nodeCode for r in got} == {"n"}
    assert min(r.recordTime for r in got) == at(900) and max(r.recordTime for r in got) == at(971)
    again = forecast(*args).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))
    # closer to the wave than its mean is
    cpu = sorted((r.recordTime, r.forecastValue) for r in got if r.kpiId == "5gcUpfSysAvgLoadCpu")
    fitted = np.array([v for _, v in cpu])
    # 8 training and 3 test blocks: the targets of the last one are slots 721-792
    target = 50 + 30 * np.sin(2 * np.pi * np.arange(721, 793) / 72)
    assert np.mean((fitted - target) ** 2) < 0.5 * np.var(target)


def test_history_days_limit_the_scan(spark):
    args = (raw(spark), rules.resource_rules(spark), rules.kpi_rules(spark))
    assert forecast(*args, T0 + dt.timedelta(days=30), history_days=7).count() == 0


def test_incremental_forecast(spark):
    rows = raw(spark, 400)
    cut = F.lit(at(300)).cast("timestamp_ntz")
    old = history_scan(rows.where(F.col("recordTime") < cut), rules.resource_rules(spark))
    history = plan.with_attributes(plan.prepare_series(old, 300), old)
    out = forecast(
        rows.where(F.col("recordTime") >= cut), rules.resource_rules(spark), rules.kpi_rules(spark), RUN,
        history=history,
    ).where("resId = 'sine'")
    assert out.agg(F.min("recordTime")).first()[0] == at(400)
    # without any new row the history alone is forecast
    silent = forecast(
        rows.limit(0), rules.resource_rules(spark), rules.kpi_rules(spark), RUN, history=history,
    ).where("resId = 'sine'")
    assert silent.count() == 2 * 72 and silent.agg(F.min("recordTime")).first()[0] == at(300)
    assert {tuple(r) for r in silent.select("nodeCode", "resourceType").distinct().collect()} == {("n", "UPF")}


def test_times_follow_the_last_slot_not_the_last_reading(spark):
    rows = raw(spark, 300)
    last = rows.where(F.col("recordTime") == F.lit(at(299)).cast("timestamp_ntz")).withColumn(
        "recordTime", F.expr("timestampadd(SECOND, 9, recordTime)"))
    out = forecast(rows.unionByName(last), rules.resource_rules(spark), rules.kpi_rules(spark), RUN)
    assert out.agg(F.min("recordTime")).first()[0] == at(300)


def test_settings_by_type_and_active_elements(spark):
    rows = raw(spark, 300)
    args = (rules.resource_rules(spark), rules.kpi_rules(spark), RUN)
    other = rows.where("resId = 'sine'").withColumns({"resId": F.lit("amf"), "deviceSet": F.lit(rules.DEVICE_SETS["AMF"][0])}).withColumn(
        "kpiId", F.when(F.col("kpiId") == "5gcUpfSysAvgLoadCpu", "5gcAmfAvgSysLoad").otherwise(F.col("kpiId")))
    both = rows.unionByName(other)
    plain = forecast(both, *args, {"hidden_size": 4})
    typed = forecast(both, *args, {"hidden_size": 4, "by_type": {"AMF": {"hidden_size": 7}}})
    values = lambda df, who: sorted((r.kpiId, r.recordTime, r.forecastValue) for r in df.where(F.col("resId") == who).collect())
    assert values(plain, "sine") == values(typed, "sine") and values(plain, "amf") != values(typed, "amf")
    active = spark.createDataFrame([("amf",)], "resId string")
    assert {r.resId for r in forecast(both, *args, {"hidden_size": 4}, active=active).select("resId").distinct().collect()} == {"amf"}


def test_one_raw_scan_with_day_partitions(spark):
    from bandwatch.session import work_dir

    path = work_dir(spark, "raw")
    raw(spark, 300).withColumn("dt", F.to_date("recordTime")).write.partitionBy("dt").parquet(path)
    scan = plan.in_days(history_scan(spark.read.parquet(path), rules.resource_rules(spark)), RUN, 7)
    text = scan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan parquet") == 1 and "PartitionFilters: [isnotnull(dt" in text
    pushed = text[text.index("PushedFilters"):].split("\n")[0]
    assert "In(deviceSet" in pushed and "IsNotNull(recordTime)" in pushed


def test_losses(spark):
    blocks = plan.model_blocks(plan.prepare_series(raw(spark), 300), 72)
    for flags in ({}, {"batch_first": True}, {"compat_first_block": True}, {"dropout": 0.2}, {"bias": False}):
        row = plan.holdout_metrics(plan.fit_forecast(blocks, {**rules.MODEL_DEFAULTS, **flags})).first()
        assert row.trainLossLast < 0.5 * row.trainLossFirst and row.testLoss > 0 and row.kpis == 2


def test_training_is_spread_over_partitions(spark):
    """Training must not be coalesced by data size."""
    blocks = plan.model_blocks(plan.prepare_series(raw(spark), 300), 72)
    text = plan.fit_forecast(blocks, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in text
    # the cell aggregate, once more below the extents (reused when it runs), the extents, and the placement
    assert text.count("Exchange hashpartitioning(resId") == 4


def test_raw_is_read_once_and_trained_once(spark, tmp_path):
    raw(spark, 300).write.parquet(f"{tmp_path}/raw")
    stored = spark.read.parquet(f"{tmp_path}/raw")
    args = (stored, rules.resource_rules(spark), rules.kpi_rules(spark), RUN)
    for config in (None, {"by_type": {"UPF": {"hidden_size": 7}, "AMF": {"hidden_size": 5}}}):
        text = forecast(*args, config)._jdf.queryExecution().executedPlan().toString()
        assert f"{tmp_path}/raw" not in text and text.count("FlatMapGroupsInPandas") == 1
