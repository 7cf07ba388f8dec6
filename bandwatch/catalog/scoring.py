"""Band, score and window queries."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from bandwatch import fixtures as fx
from bandwatch.catalog.base import register, rounded
from bandwatch.catalog.sql import level, query, r2, r6, text
from bandwatch.functions.values import decimal2
from bandwatch.operators import bands, scoring, windows
from bandwatch.operators.skew import merge_bins
from bandwatch.plans import scoring as plan
from bandwatch.schemas import ELEMENT_DIMS
from bandwatch.session import work_dir
from bandwatch.sinks.buckets import write_bucketed
from bandwatch.sinks.tables import append_by_day
from bandwatch.sources.readings import rename_raw

DIMS = "nodeCode, resId, resourceType, vender"


def stored_forecasts(spark, sf):
    """Forecasts as scoring meets them: a written table, not the plan that made them."""
    return plan.stage(fx.forecast(spark, sf), "forecasts")


def joined(spark, sf):
    rules = fx.kpi_rules(spark)
    return scoring.forecast_actual_join(
        plan.rebanded(stored_forecasts(spark, sf), rules), plan.clean_actuals(fx.actual(spark, sf), rules)
    )


def scores(spark, sf):
    return scoring.kpi_scores(joined(spark, sf), fx.kpi_rules(spark), fx.RUN_TIME)


def weighted(spark, sf):
    return scoring.weighted_scores(scores(spark, sf), fx.weights(spark))


def elements(spark, sf):
    return scoring.element_scores(weighted(spark, sf), fx.RUN_TIME)


_F = "forecastValue"
_UPPER = f"CASE kpiId WHEN 'purchase' THEN 100 WHEN 'error' THEN 1.1::DOUBLE * ({_F} + 5) WHEN 'click' THEN abs(100 * {_F}) + 10000 ELSE 1.25::DOUBLE * ({_F} + 10) END"
_LOWER = f"CASE kpiId WHEN 'click' THEN 0.75::DOUBLE * {_F} ELSE 0.0 END"


def _limit(x: str) -> str:
    return f"CASE WHEN kpiId IN ('purchase', 'error') THEN greatest(0.0::DOUBLE, least(100.0::DOUBLE, {x})) ELSE greatest(0.0::DOUBLE, {x}) END"


@register("forecast_bands", query(f"""SELECT resId, itemPara, kpiId, {text('recordTime')} AS recordTime,
    {_limit(_F)} AS forecastValue, {_limit(_UPPER)} AS forecastValueUpper, {_limit(_LOWER)} AS forecastValueLower
    FROM forecasts"""))
def forecast_bands(spark, sf):
    return bands.forecast_bands(fx.forecast(spark, sf), fx.kpi_rules(spark)).select(
        "resId", "itemPara", "kpiId", "recordTime", "forecastValue", "forecastValueUpper", "forecastValueLower"
    )


@register("clamp_bounds", query(f"""SELECT resId, kpiId, {text('recordTime')} AS recordTime,
    {_limit(_F)} AS forecastValue, {_limit(f'2 * {_F}')} AS forecastValueUpper, {_limit(f'{_F} - 60')} AS forecastValueLower
    FROM forecasts"""))
def clamp_bounds(spark, sf):
    """Bounds that leave the limits on both sides."""
    f = F.col("forecastValue")
    rows = fx.forecast(spark, sf).join(fx.kpi_rules(spark).select("kpiId", "kpiClass"), "kpiId")
    wide = rows.withColumns({"forecastValueUpper": F.lit(2) * f, "forecastValueLower": f - 60})
    return bands.clamp_bounds(wide).select(
        "resId", "kpiId", "recordTime", "forecastValue", "forecastValueUpper", "forecastValueLower"
    )


@register("robust_center", query(f"""SELECT {text('recordTime')} AS recordTime, kpiId, {r6('center')} AS center
    FROM centers"""))
def robust_center(spark, sf):
    return rounded(bands.robust_center(fx.forecast(spark, sf), fx.kpi_rules(spark)), "center")


@register("reband_forecast", query(f"""SELECT resId, itemPara, {text('recordTime')} AS recordTime,
    {text('createTime')} AS createTime, kpiId, forecastValue, forecastValueUpper, forecastValueLower, nodeCode, deviceSet,
    abnormal FROM rebanded"""))
def reband_forecast(spark, sf):
    return plan.rebanded(stored_forecasts(spark, sf), fx.kpi_rules(spark))


@register("reband_stored_bins", query(f"""SELECT resId, itemPara, {text('recordTime')} AS recordTime, kpiId,
    forecastValue, forecastValueUpper, forecastValueLower, abnormal FROM rebanded"""))
def reband_stored_bins(spark, sf):
    """Forecasts that came in three batches, each stored with its sketch; bands from the sketches added up."""
    rules, rows = fx.kpi_rules(spark), stored_forecasts(spark, sf)
    batch = F.pmod(F.xxhash64("resId"), F.lit(3))
    sketches = [plan.stage(bands.forecast_bins(rows.where(batch == k), rules), "bins") for k in range(3)]
    bins = plan.stage(merge_bins(*sketches, keys=bands.SLOT_KPI), "bins")
    return plan.rebanded(rows, rules, bins).select(
        "resId", "itemPara", "recordTime", "kpiId", "forecastValue", "forecastValueUpper", "forecastValueLower", "abnormal")


@register("forecast_actual_join", query(f"""SELECT {text('minId')} AS "minId", {DIMS}, itemPara, kpiId, kpiValue,
    forecastValue, forecastValueUpper, forecastValueLower FROM joined"""))
def forecast_actual_join(spark, sf):
    return joined(spark, sf)


_BANDS = ("forecastValueUpper", "forecastValueLower")


@register("in_range_flag", query(f"""SELECT {text('minId')} AS "minId", resId, kpiId, {r2('kpiValue')} AS kpiValue,
    forecastValueUpper, forecastValueLower, ifRangeFcst FROM points"""))
def in_range_flag(spark, sf):
    inside = scoring.in_range(F.col("kpiValue"), F.col("forecastValueLower"), F.col("forecastValueUpper"))
    return joined(spark, sf).select(
        "minId", "resId", "kpiId", decimal2(F.col("kpiValue")).alias("kpiValue"), *_BANDS, inside.alias("ifRangeFcst")
    )


@register("kpi_deviation_score", query(f"""SELECT {text('minId')} AS "minId", resId, kpiId, kpiValue,
    forecastValueUpper, forecastValueLower, CAST(abnScore AS DOUBLE) AS abnScore FROM points"""))
def kpi_deviation_score(spark, sf):
    return scores(spark, sf).select("minId", "resId", "kpiId", "kpiValue", *_BANDS, "abnScore").withColumn(
        "abnScore", F.col("abnScore").cast("double")
    )


@register("kpi_score_result", query(f"""SELECT {text('minId')} AS "minId", {DIMS}, itemPara, kpiId, kpiValue, forecastValue,
    forecastValueUpper, forecastValueLower, ifRangeFcst, {level('abnScore')} AS abnLevel, abnScore,
    '2024-02-01 00:00:00' AS createTime FROM points"""))
def kpi_score_result(spark, sf):
    return scores(spark, sf)


@register("weighted_kpi_scores", query(f"""SELECT {text('minId')} AS "minId", {DIMS}, itemPara, kpiId, kpiAbnScore,
    CAST(tenths AS DOUBLE) / 10 AS abnScore FROM weighted"""))
def weighted_kpi_scores(spark, sf):
    return weighted(spark, sf)


@register("element_score", query(f"""SELECT {text('minId')} AS "minId", {DIMS}, abnScore, abnLevel,
    '2024-02-01 00:00:00' AS trainingTime, 'fcst' AS trainingAlgo, abnRate, total IS NULL AS unweighted FROM elements"""))
def element_score(spark, sf):
    return elements(spark, sf)


def bucketed(spark, sf):
    """Clean readings and bands, stored by slot and element."""
    rules, run = fx.kpi_rules(spark), uuid.uuid4().hex
    tables = {"actual": plan.clean_actuals(fx.actual(spark, sf), rules), "banded": plan.rebanded(stored_forecasts(spark, sf), rules)}
    return [write_bucketed(df, f"{name}_{run}", work_dir(spark, name), 8, order=["kpiId"]) for name, df in tables.items()]


@register("co_located_element_score", query(f"""SELECT {text('minId')} AS "minId", {DIMS}, abnScore, abnLevel,
    '2024-02-01 00:00:00' AS trainingTime, 'fcst' AS trainingAlgo, abnRate, total IS NULL AS unweighted FROM elements"""))
def co_located_element_score(spark, sf):
    """Element scores from two tables stored by slot and element."""
    return plan.co_located_scores(*bucketed(spark, sf), fx.kpi_rules(spark), fx.weights(spark), fx.RUN_TIME)[1]


@register("window_score", query(f"""SELECT {text('minId')} AS "minId", {DIMS}, abnScore,
    CAST(windowScore AS BIGINT) AS windowScore FROM windows"""))
def window_score(spark, sf):
    return windows.window_score(elements(spark, sf), fx.STEP).select("minId", *ELEMENT_DIMS, "abnScore", "windowScore")


@register("window_alarm", query(f"""SELECT {text('minId')} AS "minId", {DIMS}, CAST(windowScore AS BIGINT) AS windowScore,
    CASE WHEN windowScore >= 200 THEN 1 ELSE 0 END AS isWindowAbn,
    CASE WHEN windowScore >= 100 THEN 1 ELSE 0 END AS isWindowAlarm, abnScore, abnLevel,
    '2024-02-01 00:00:00' AS trainingTime, 'fcst' AS trainingAlgo, abnRate, '2024-02-01 00:00:00' AS createTime
    FROM windows"""))
def window_alarm(spark, sf):
    _, table = plan.score(
        fx.actual(spark, sf), stored_forecasts(spark, sf), fx.kpi_rules(spark), fx.weights(spark),
        fx.RUN_TIME, fx.STEP, staged=False,
    )
    return table


_PRIOR = """SELECT minId + k * INTERVAL 1 HOUR AS forSlot, e.* FROM elements e CROSS JOIN (VALUES (1), (2)) v(k)"""


@register("prior_window_scan", query(f"""SELECT {text('forSlot')} AS forSlot, {text('minId')} AS "minId", {DIMS}, abnScore
    FROM prior""", prior=_PRIOR))
def prior_window_scan(spark, sf):
    return windows.prior_scores(elements(spark, sf), fx.STEP)


@register("union_scores", query(f"""SELECT {text('forSlot')} AS forSlot, {text('minId')} AS "minId", {DIMS}, abnScore FROM prior
    UNION ALL SELECT {text('minId')}, {text('minId')}, {DIMS}, abnScore FROM elements""", prior=_PRIOR))
def union_scores(spark, sf):
    return windows.union_scores(elements(spark, sf), fx.STEP)


@register("element_window_join", query(f"""SELECT {text('minId')} AS "minId", {DIMS}, abnScore,
    CAST(windowScore AS BIGINT) AS windowScore FROM windows"""))
def element_window_join(spark, sf):
    return windows.element_window_join(elements(spark, sf), fx.STEP)


@register("regression_metrics", query("""SELECT kpiId, count(*) AS n, round(avg(abs(e)), 3) AS mae, round(avg(e * e), 1) AS mse,
    round(sqrt(avg(e * e)), 3) AS rmse, round(1 - avg(e * e) / var_pop(kpiValue), 6) AS r2,
    round(avg(abs(e / nullif(kpiValue, 0))) * 100, 3) AS mape FROM (
      SELECT a.kpiId, a.kpiValue, a.kpiValue - f.forecastValue AS e FROM cells a JOIN forecasts f
      ON a.resId = f.resId AND a.itemPara = f.itemPara AND a.kpiId = f.kpiId AND a.recordTime = f.recordTime)
    GROUP BY kpiId"""))
def regression_metrics(spark, sf):
    """How well the stand-in forecast fits, per KPI."""
    pairs = (
        fx.forecast(spark, sf)
        .join(fx.actual(spark, sf).select(*scoring.JOIN_KEY, "kpiValue"), scoring.JOIN_KEY)
        .select("kpiId", F.col("kpiValue").alias("actual"), F.col("forecastValue").alias("predicted"))
    )
    out = scoring.regression_metrics(pairs, ["kpiId"])
    places = {"mae": 3, "mse": 1, "rmse": 3, "r2": 6, "mape": 3}
    return out.withColumns({c: F.round(c, p) for c, p in places.items()})


_RUNS = ("2024-01-05 10:20:00", "2024-01-12 00:40:00", "2024-01-20 17:00:00", "2024-01-29 03:59:59")


@register("score_slot_run", query(f"""SELECT {text('minId')} AS "minId", {DIMS}, CAST(windowScore AS BIGINT) AS windowScore,
    abnScore, abnLevel, abnRate FROM windows WHERE minId IN ({", ".join(f"date_trunc('hour', TIMESTAMP '{t}') - INTERVAL 1 HOUR" for t in _RUNS)})"""))
def score_slot_run(spark, sf):
    """Runs at several times over tables stored by day; each reads three slots and scores the last."""
    raw = append_by_day(rename_raw(fx.raw_cells(fx.events(spark, sf))), work_dir(spark, "raw"), "recordTime")
    forecasts = append_by_day(fx.forecast(spark, sf), work_dir(spark, "forecast"), "recordTime")
    out = None
    for now in _RUNS:
        _, table = plan.score_slot(
            dt.datetime.fromisoformat(now), raw, forecasts, fx.resource_rules(spark), fx.kpi_rules(spark), fx.weights(spark),
            fx.STEP, delay=fx.STEP)
        out = table if out is None else out.unionByName(table)
    return out.select("minId", *ELEMENT_DIMS, "windowScore", "abnScore", "abnLevel", "abnRate")
