"""Model and forecast-table queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bandwatch import fixtures as fx
from bandwatch.catalog.base import register, rounded
from bandwatch.catalog.scans import cells
from bandwatch.catalog.scoring import _LOWER, _UPPER, _limit
from bandwatch.catalog.series import prepared
from bandwatch.catalog.sql import query, r6, text
from bandwatch.operators import series as ts
from bandwatch.plans import forecasting as plan
from bandwatch.plans.incremental import forecast_changed
from bandwatch.rules import MODEL_DEFAULTS
from bandwatch.session import work_dir
from bandwatch.sinks import tables
from bandwatch.sources.readings import history_scan


@register("rnn_forecast", query(f"""SELECT e.resId, e.itemPara, k.kpiId, {text("maxTime + g.i * INTERVAL 1 HOUR")} AS recordTime,
    '2024-02-01 00:00:00' AS createTime, w.nodeCode, w.deviceSet, w.resourceType, true AS insideLimits, true AS ordered,
    CASE k.kpiId WHEN 'purchase' THEN 100.0 END AS fixedUpper, CASE WHEN k.kpiId <> 'click' THEN 0.0 END AS fixedLower
    FROM extents e JOIN (SELECT DISTINCT resId, itemPara, kpiId FROM cells) k ON e.resId = k.resId AND e.itemPara = k.itemPara
    JOIN (SELECT DISTINCT resId, nodeCode, deviceSet, resourceType FROM actual) w ON e.resId = w.resId,
    generate_series(1, 72) g(i)"""))
def rnn_forecast(spark, sf):
    """Trained forecast of the coming 72 slots for every element: what does not depend on the weights learned."""
    out = plan.forecast(
        cells(spark, sf), fx.resource_rules(spark), fx.kpi_rules(spark), fx.RUN_TIME, step=fx.STEP, history_days=None
    )
    f, up, low = F.col("forecastValue"), F.col("forecastValueUpper"), F.col("forecastValueLower")
    limited = F.col("kpiId").isin("purchase", "error")
    return out.select(
        "resId", "itemPara", "kpiId", "recordTime", "createTime", "nodeCode", "deviceSet", "resourceType",
        ((f >= 0) & (~limited | (f <= 100)) & ~F.isnan(f) & (F.col("kpiStd") >= 0)).alias("insideLimits"),
        ((low <= f) & (f <= up)).alias("ordered"),
        F.when(F.col("kpiId") == "purchase", up).alias("fixedUpper"), F.when(F.col("kpiId") != "click", low).alias("fixedLower"))


@register("forecast_by_type", query(f"""SELECT e.resId, e.itemPara, k.kpiId, {text("maxTime + g.i * INTERVAL 1 HOUR")} AS recordTime,
    w.resourceType, true AS finite, w.resourceType = 'T1' AS own
    FROM extents e JOIN (SELECT DISTINCT resId, itemPara, kpiId FROM cells) k ON e.resId = k.resId AND e.itemPara = k.itemPara
    JOIN (SELECT DISTINCT resId, resourceType FROM actual) w ON e.resId = w.resId, generate_series(1, 72) g(i)"""))
def forecast_by_type(spark, sf):
    """One type with settings of its own, in one grouped call; ``own``: forecasts that differ from those of the common settings."""
    args = (cells(spark, sf), fx.resource_rules(spark), fx.kpi_rules(spark), fx.RUN_TIME)
    quick = {"epochs": 5}
    key, f = ["resId", "itemPara", "kpiId", "recordTime"], F.col("forecastValue")
    usual = plan.forecast(*args, quick, step=fx.STEP, history_days=None).select(*key, f.alias("usual"), F.col("kpiStd").alias("usualStd"))
    typed = plan.forecast(*args, {**quick, "by_type": {"T1": {"epochs": 9}}}, step=fx.STEP, history_days=None)
    # a single value may meet a limit in both, the deviation of the unlimited series does not
    return typed.join(usual, key).select(*key, "resourceType", (~F.isnan(f)).alias("finite"), (F.col("kpiStd") != F.col("usualStd")).alias("own"))


@register("rnn_holdout_metrics", query("""SELECT resId, itemPara, count(DISTINCT kpiId) AS kpis, true AS lossFell, true AS finite
    FROM blocks GROUP BY resId, itemPara"""))
def rnn_holdout_metrics(spark, sf):
    """Whether training lowered each element's loss and left a finite hold-out loss."""
    series = plan.prepare_series(cells(spark, sf), fx.STEP)
    fitted = plan.holdout_metrics(plan.fit_forecast(plan.model_blocks(series, 72), MODEL_DEFAULTS))
    return fitted.select(
        "resId", "itemPara", "kpis", (F.col("trainLossLast") < F.col("trainLossFirst")).alias("lossFell"),
        ((F.col("testLoss") > 0) & (F.col("testLoss") < 100)).alias("finite"))


_AHEAD = """SELECT t.resId, t.itemPara, t.kpiId, t.forecastValue, e.maxTime + t.stepAhead * INTERVAL 1 HOUR AS recordTime,
    stddev_samp(t.forecastValue) OVER (PARTITION BY t.resId, t.itemPara, t.kpiId) AS kpiStd
    FROM (SELECT resId, itemPara, kpiId, kpiValue AS forecastValue, rn + 72 - n AS stepAhead FROM numbered
      WHERE rn > n - 72) t JOIN extents e ON t.resId = e.resId AND t.itemPara = e.itemPara"""


@register("forecast_assemble", query(f"""SELECT a.resId, a.itemPara, {text('a.recordTime')} AS recordTime,
    '2024-02-01 00:00:00' AS createTime, kpiId, {r6(_limit('forecastValue'))} AS forecastValue,
    {r6(_limit(_UPPER))} AS forecastValueUpper, {r6(_limit(_LOWER))} AS forecastValueLower, {r6('kpiStd')} AS kpiStd,
    w.nodeCode, w.deviceSet, w.resourceType
    FROM ahead a JOIN (SELECT DISTINCT resId, nodeCode, deviceSet, resourceType FROM actual) w ON a.resId = w.resId""", ahead=_AHEAD))
def forecast_assemble(spark, sf):
    """The last 72 slots repeated as the forecast of the next 72."""
    rows = cells(spark, sf)
    tail = ts.series_tail(prepared(spark, sf), 72)
    values = tail.select(
        "resId", "itemPara", "kpiId", F.row_number().over(ts.in_order()).alias("stepAhead"),
        F.col("kpiValue").alias("forecastValue"),
    )
    elements = ts.element_summary(history_scan(rows, fx.resource_rules(spark)), fx.STEP)
    out = plan.assemble(values, elements, fx.kpi_rules(spark), fx.STEP, fx.RUN_TIME)
    return rounded(out, "forecastValue", "forecastValueUpper", "forecastValueLower", "kpiStd")


_CUT = "TIMESTAMP '2024-01-20'"


@register("incremental_forecast_inputs", query(f"""SELECT resId, kpiId, {text('recordTime')} AS recordTime, kpiValue,
    CASE WHEN e % 4 = 1 OR (e % 4 <> 0 AND recordTime >= {_CUT}) THEN 'new' ELSE 'history' END AS origin
    FROM (SELECT *, CAST(substr(resId, 3) AS BIGINT) AS e FROM cells)"""))
def incremental_forecast_inputs(spark, sf):
    """Every fourth element has nothing new, the one after it is unknown, the others have a history until a day."""
    rows = cells(spark, sf)
    number = F.substring("resId", 3, 20).cast("long") % 4
    cut = F.col("recordTime") < F.lit("2024-01-20").cast("timestamp_ntz")
    scan = history_scan(rows, fx.resource_rules(spark))
    history = plan.with_attributes(scan.where((number == 0) | ((number != 1) & cut)), scan)
    fresh = plan.incremental_inputs(rows, history, fx.resource_rules(spark), fx.RUN_TIME, 60)
    return history.select("resId", "kpiId", "recordTime", "kpiValue", F.lit("history").alias("origin")).unionByName(
        fresh.select("resId", "kpiId", "recordTime", "kpiValue", F.lit("new").alias("origin")))


@register("forecast_times_offslot", query(f"""SELECT resId, CAST(k AS INTEGER) AS stepAhead,
    {text("last + k * INTERVAL 1 HOUR")} AS recordTime
    FROM (SELECT resId, date_trunc('hour', max(ts)) AS last FROM readings GROUP BY resId), generate_series(1, 72) g(k)"""))
def forecast_times_offslot(spark, sf):
    """Forecast times after readings at any second follow the last slot, not the last reading."""
    e = fx.events(spark, sf)
    c = fx.element_columns()
    rows = e.select(c["RESID"].alias("resId"), c["ITEM_PARA"].alias("itemPara"), c["NODECODE"].alias("nodeCode"),
                    c["DEVICE_SET"].alias("deviceSet"), F.lit("T").alias("resourceType"), F.col("ts").cast("timestamp_ntz").alias("recordTime"))
    ahead = ts.future_slots(ts.element_summary(rows, fx.STEP), fx.STEP, 72)
    return ahead.select("resId", F.col("stepAhead").cast("int").alias("stepAhead"), "recordTime")


_FIRST = f"""SELECT resId, itemPara, kpiId, m + i * INTERVAL 1 HOUR AS recordTime, TIMESTAMP '2024-01-20' AS createTime
    FROM (SELECT resId, itemPara, max(recordTime) AS m FROM cells WHERE recordTime < {_CUT} GROUP BY ALL) e
    JOIN (SELECT DISTINCT resId, itemPara, kpiId FROM cells WHERE recordTime < {_CUT}) k USING (resId, itemPara), generate_series(1, 72) g(i)"""
_SECOND = f"""SELECT resId, itemPara, kpiId, m + i * INTERVAL 1 HOUR AS recordTime, TIMESTAMP '2024-02-01' AS createTime
    FROM (SELECT resId, itemPara, max(recordTime) AS m FROM cells WHERE recordTime >= {_CUT} AND CAST(substr(resId, 3) AS BIGINT) % 2 = 0
      GROUP BY ALL) e JOIN (SELECT DISTINCT resId, itemPara, kpiId FROM cells) k USING (resId, itemPara), generate_series(1, 72) g(i)"""


class _Stopped(Exception):
    pass


@register("change_driven_forecast", query(f"""SELECT resId, itemPara, kpiId, {text('recordTime')} AS recordTime,
    {text('max(createTime)')} AS createTime FROM (SELECT * FROM first_run UNION ALL SELECT * FROM second_run)
    GROUP BY resId, itemPara, kpiId, recordTime""", first_run=_FIRST, second_run=_SECOND))
def change_driven_forecast(spark, sf):
    """Runs over stored readings: of all elements, then of every second one, which alone has new slots, then of none.

    The second run stops after its history and again before its commit, and is repeated.
    """
    rows = cells(spark, sf)
    cut = F.lit("2024-01-20").cast("timestamp_ntz")
    even = F.substring("resId", 3, 20).cast("long") % 2 == 0
    raw, history, out = (work_dir(spark, name) for name in ("readings", "history", "forecast"))
    key, day = ["recordTime", "resId", "kpiId"], F.to_date("recordTime")

    def run(when, at=lambda name: None):
        return forecast_changed(spark, raw, history, out, fx.resource_rules(spark), fx.kpi_rules(spark), when, {"epochs": 3},
                                fx.STEP, None, at)

    def stop_at(where):
        def at(step):
            if step == where:
                raise _Stopped
        return at

    tables.merge_into(rows.where(F.col("recordTime") < cut), raw, key, day)
    run(dt.datetime(2024, 1, 20))
    tables.merge_into(rows.where((F.col("recordTime") >= cut) & even), raw, key, day)
    for where in ("history", "written"):
        try:
            run(fx.RUN_TIME, stop_at(where))
        except _Stopped:
            pass
    run(fx.RUN_TIME)
    if run(dt.datetime(2024, 2, 2)):
        raise ValueError("a run without new slots forecast elements again")
    return tables.open_table(spark, out).select("resId", "itemPara", "kpiId", "recordTime", "createTime")
