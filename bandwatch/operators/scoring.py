"""Deviation scores of readings against bands, and their roll-up to elements."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bandwatch import rules
from bandwatch.functions.values import decimal2, level_of, round2
from bandwatch.schemas import ELEMENT_DIMS, KPI_SCORE

JOIN_KEY = ["resId", "itemPara", "kpiId", "recordTime"]


def forecast_actual_join(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """Readings with the forecast of the same series and slot, without repeated rows.

    Rows are placed by slot and element before duplicates are removed; weighting
    and the element roll-up then need no further exchange.
    """
    f = forecast.select(
        *JOIN_KEY, "nodeCode", "forecastValue", "forecastValueUpper", "forecastValueLower"
    )
    a = actual.select(*JOIN_KEY, "kpiValue", "minId", "vender", "resourceType")
    return (
        f.join(a, JOIN_KEY)
        .select("minId", *ELEMENT_DIMS, "itemPara", "kpiId", "kpiValue",
                "forecastValue", "forecastValueUpper", "forecastValueLower")
        .repartition("minId", "resId")
        .distinct()
    )


def co_located_join(forecast: DataFrame, actual: DataFrame) -> DataFrame:
    """``forecast_actual_join`` of two tables stored by ``sinks.buckets`` by slot and element.

    Equal slots and elements lie in equal buckets, so neither the join nor removing
    repeated rows, weighting or the element roll-up moves rows. The session setting that
    lets a join use a placement by some of its keys is part of ``session.configure``.
    ``minId`` is the slot of the reading, which its ``recordTime`` is here.
    """
    f = forecast.select(*JOIN_KEY, "nodeCode", "forecastValue", "forecastValueUpper", "forecastValueLower")
    a = actual.select(*JOIN_KEY, "kpiValue", "vender", "resourceType")
    return (
        # a hint for the join's form only: a broadcast would read one side whole into every executor
        f.hint("merge").join(a, JOIN_KEY)
        .select(F.col("recordTime").alias("minId"), *[c for c in ELEMENT_DIMS if c != "minId"], "itemPara", "kpiId", "kpiValue",
                "forecastValue", "forecastValueUpper", "forecastValueLower")
        .distinct()
    )


def in_range(value: Column, lower: Column, upper: Column) -> Column:
    """1 for a missing value or one inside the band, compared at two decimals."""
    v = decimal2(value)
    inside = value.isNull() | ((v >= decimal2(lower)) & (v <= decimal2(upper)))
    return F.when(inside, 1).otherwise(0)


def deviation_score(value: Column, lower: Column, upper: Column, direction: Column) -> Column:
    """Points for how far a value lies beyond its bound, numerically in every tier."""
    low = F.lit(0)
    for share, points in reversed(rules.LOW_TIERS):
        low = F.when(value < F.lit(share) * lower, points).otherwise(low)
    high = F.lit(0)
    for share, points in reversed(rules.HIGH_TIERS):
        high = F.when(value > F.lit(share) * upper, points).otherwise(high)
    return (
        F.when(value.isNull(), 0).when(direction == "low", low).when(direction == "high", high).otherwise(0)
    )


def kpi_scores(joined: DataFrame, kpi_rules: DataFrame, run_time: dt.datetime) -> DataFrame:
    """Result row per element, slot and KPI."""
    v, lo, up = F.col("kpiValue"), F.col("forecastValueLower"), F.col("forecastValueUpper")
    scored = joined.join(kpi_rules.select("kpiId", "direction"), "kpiId", "left").withColumns(
        {
            "ifRangeFcst": in_range(v, lo, up),
            "abnScore": deviation_score(v, lo, up, F.col("direction")),
            "createTime": F.lit(run_time).cast("timestamp_ntz"),
        }
    )
    return scored.withColumn("abnLevel", level_of(F.col("abnScore"))).select(*KPI_SCORE.names)


def weighted_scores(scores: DataFrame, weights: DataFrame) -> DataFrame:
    """KPI scores with their weighted share; KPIs without a weight get null."""
    return (
        scores.join(weights.select("resourceType", "kpiId", "abnScoreWeight"), ["kpiId", "resourceType"], "left")
        .select("minId", *ELEMENT_DIMS, "itemPara", "kpiId",
                (F.col("abnScore").cast("int") * F.col("abnScoreWeight")).alias("abnScore"),
                F.col("abnScore").cast("int").alias("kpiAbnScore"))
        .distinct()
    )


def element_scores(weighted: DataFrame, run_time: dt.datetime) -> DataFrame:
    """Score, level and abnormal share per element and slot.

    Without any weight the score and level are null and ``unweighted`` is true.
    """
    total = F.sum("abnScore")
    share = F.lit(100.0) * F.count_if(F.col("kpiAbnScore") >= 80) / F.count(F.lit(1))
    now = F.lit(run_time).cast("timestamp_ntz")
    return (
        weighted.groupBy("minId", *ELEMENT_DIMS)
        .agg(total.alias("_total"), share.alias("_share"))
        .select(
            "minId", *ELEMENT_DIMS,
            F.round("_total", 0).cast("int").alias("abnScore"),
            level_of(F.col("_total")).alias("abnLevel"),
            now.alias("trainingTime"),
            F.lit("fcst").alias("trainingAlgo"),
            F.when(F.col("_total") >= 80, round2(F.col("_share"))).otherwise(F.lit(0.0)).alias("abnRate"),
            F.col("_total").isNull().alias("unweighted"),
        )
    )


def regression_metrics(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Error measures of ``predicted`` against ``actual`` per group.

    MAPE is the mean absolute percentage over non-zero actuals.
    """
    a, p = F.col("actual"), F.col("predicted")
    err = a - p
    sums = pairs.where(a.isNotNull() & p.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(err)).alias("mae"),
        F.avg(err * err).alias("mse"),
        F.var_pop(a).alias("_var"),
        (F.avg(F.abs(err / F.nullif(a, F.lit(0.0)))) * 100).alias("mape"),
    )
    return sums.select(
        *by, "n", "mae", "mse", F.sqrt("mse").alias("rmse"),
        (F.lit(1.0) - F.col("mse") / F.nullif(F.col("_var"), F.lit(0.0))).alias("r2"), "mape",
    )
