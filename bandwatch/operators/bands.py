"""Tolerance bands around forecasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandwatch.functions.values import clamp, is_number, round2
from bandwatch.operators.skew import in_middle, middle_bins, ranked_values, value_bin, value_bins

SLOT_KPI = ["recordTime", "kpiId"]
CENTRE_FIELDS = ["medGt", "medLe", "medLt"]


def clamp_bounds(df: DataFrame) -> DataFrame:
    """Rates and loads into [0, 100], volumes and counts to at least 0, by ``kpiClass``."""
    high = F.col("kpiClass").isin("MAX_BEST", "MIN_BEST")
    bounds = ["forecastValue", "forecastValueUpper", "forecastValueLower"]
    return df.withColumns(
        {c: F.when(high, clamp(F.col(c), 0, 100)).otherwise(clamp(F.col(c), 0)) for c in bounds}
    )


def forecast_bands(forecast: DataFrame, kpi_rules: DataFrame) -> DataFrame:
    """Bounds by KPI class from the unlimited forecast, then limits. Unclassified KPIs drop out."""
    upper = F.expr(
        "case kpiClass when 'MAX_BEST' then 100.0D when 'MIN_BEST' then 1.1D * (forecastValue + 5)"
        " when 'SCALE_INCR' then 1.25D * (forecastValue + 10)"
        " when 'SCALE_DECR' then abs(100.0D * forecastValue) + 10000 end"
    )
    lower = F.expr("if(kpiClass = 'SCALE_DECR', 0.75D * forecastValue, 0.0D)")
    banded = forecast.join(kpi_rules.select("kpiId", "kpiClass"), "kpiId").withColumns(
        {"forecastValueUpper": upper, "forecastValueLower": lower}
    )
    return clamp_bounds(banded)


def is_abnormal(value: Column) -> Column:
    """Far on the wrong side of the centre: relative distance beyond ``thr``."""
    c, below = F.col("center"), F.col("side") == "below"
    wrong = F.when(below, value < c).otherwise(value > c)
    return (F.abs(value - c) / (c + F.col("eps")) > F.col("thr")) & wrong


def _banded_rows(forecast: DataFrame, kpi_rules: DataFrame) -> DataFrame:
    """Forecasts of KPIs with a band, each marked whether it counts for its centre."""
    typical = F.expr(
        "coalesce(forecastValue > medGt, true) and coalesce(forecastValue <= medLe, true)"
        " and coalesce(forecastValue < medLt, true)"
    )
    rules = kpi_rules.where(F.col("bandRule").isNotNull()).select("kpiId", *CENTRE_FIELDS)
    return (
        forecast.where(is_number(F.col("forecastValue")))
        .join(rules, "kpiId")
        .select(*SLOT_KPI, F.col("forecastValue").cast("double").alias("v"), typical.alias("typical"))
    )


def forecast_bins(forecast: DataFrame, kpi_rules: DataFrame) -> DataFrame:
    """Sketch of the forecasts of each slot and KPI, counting the typical ones.

    Stored next to a batch of forecasts and added up with ``skew.merge_bins``, it saves
    re-banding a pass over all of them.
    """
    return value_bins(_banded_rows(forecast, kpi_rules), SLOT_KPI, F.col("v"), F.col("typical"))


def centre_statistics(forecast: DataFrame, kpi_rules: DataFrame, bins: DataFrame | None = None) -> DataFrame:
    """Per slot and KPI over all elements: the median of the typical forecasts, or the rule's default,
    and the least and greatest forecast (``_min``, ``_max``) that is not abnormal against it.

    The sketch gives the bins that hold the median; the limit of normal forecasts follows
    from it and falls into a known range of bins too. One pass fetches the distinct values
    of these bins, all other bins lie on one side of the limit and count with their ends.
    ``bins``: the ``forecast_bins`` of exactly these forecasts.
    """
    bins = forecast_bins(forecast, kpi_rules) if bins is None else bins
    limits = kpi_rules.where(F.col("bandRule").isNotNull()).select("kpiId", "side", "thr", "eps", "medDefault")
    low, high = F.coalesce("low1", "medDefault"), F.coalesce("high2", "medDefault")
    way = F.when(F.col("side") == "below", F.lit(-1.0)).otherwise(F.lit(1.0)) * F.col("thr")
    edges = [c + way * (c + F.col("eps")) for c in (low, high)]
    slack = F.lit(1e-9) * (1 + F.col("thr")) * (F.abs(low) + F.abs(high) + F.col("eps"))
    ranges = (
        middle_bins(bins, SLOT_KPI)
        .join(limits, "kpiId")
        .withColumns({"near1": value_bin(F.least(*edges) - slack) - 1, "near2": value_bin(F.greatest(*edges) + slack) + 1})
        .drop("low1", "high2")
    )
    # rows of other bins become one row on each side of the limit
    middle = in_middle(F.col("bin"))
    watched = middle | F.col("bin").between(F.col("near1"), F.col("near2"))
    group = [c for c in ranges.columns if c not in ("bin1", "bin2", "near1", "near2")]
    values = (
        _banded_rows(forecast, kpi_rules)
        .withColumn("bin", value_bin(F.col("v")))
        .join(ranges, SLOT_KPI)
        .groupBy(*group, F.when(watched, F.col("v")).alias("v"), (F.col("bin") > F.col("near2")).alias("_side"))
        .agg(F.count_if(middle & F.col("typical")).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
    )
    whole = Window.partitionBy(*SLOT_KPI)
    median = F.lit(0.5) * F.max("first").over(whole) + F.lit(0.5) * F.max("second").over(whole)
    judged = ranked_values(values, SLOT_KPI).withColumn("center", F.coalesce(median, "medDefault"))
    low, high = (F.when(~is_abnormal(F.col(c)), F.col(c)) for c in ("low", "high"))
    return judged.groupBy(*SLOT_KPI).agg(
        F.max("center").alias("center"),
        F.least(F.min(low), F.min(high)).alias("_min"), F.greatest(F.max(low), F.max(high)).alias("_max"))


def robust_center(forecast: DataFrame, kpi_rules: DataFrame, bins: DataFrame | None = None) -> DataFrame:
    """Median of the typical forecasts of each slot and KPI over all elements, or the rule's default."""
    return centre_statistics(forecast, kpi_rules, bins).select(*SLOT_KPI, "center")


def reband(forecast: DataFrame, kpi_rules: DataFrame, bins: DataFrame | None = None) -> DataFrame:
    """Bands for scoring, each forecast judged against all elements in its slot and KPI.

    Rows far on the wrong side of the centre are abnormal and get the range of the
    normal ones. The statistics hold one row per slot and KPI: while they are small
    Spark broadcasts them and the forecasts stay where they are, beyond that the
    join shuffles and hot groups are split by the skew-join settings. With ``bins``
    stored beside them, the forecasts are read twice: for the statistics and here.
    """
    f = F.col("forecastValue")
    thresholds = kpi_rules.where(F.col("bandRule").isNotNull()).select("kpiId", "side", "thr", "eps")
    judged = (
        forecast.where(is_number(f))
        .join(centre_statistics(forecast, kpi_rules, bins), SLOT_KPI)
        .join(thresholds, "kpiId")
        .withColumn("abnormal", is_abnormal(f))
        .drop("side", "thr", "eps", "center")
    )

    bands = kpi_rules.select(
        "kpiId", "lowerFactor", "upperKind", "upperValue",
        "abnLowerFactor", "abnLowerDefault", "abnUpperKind", "abnUpperDefault",
    )
    lower = F.expr(
        "if(abnormal, coalesce(abnLowerFactor * _min, abnLowerDefault), lowerFactor * forecastValue)"
    )
    upper = F.expr(
        "case when abnormal and abnUpperKind = 'const' then abnUpperDefault"
        " when abnormal then coalesce(_max, abnUpperDefault)"
        " when upperKind = 'const' then upperValue"
        " when upperKind = 'factor' then upperValue * forecastValue"
        " when 1.5D * forecastValue > 20 and 1.5D * forecastValue <= 95 then 1.5D * forecastValue"
        " else 95.0D end"
    )
    return (
        judged.join(bands, "kpiId")
        .select(
            "resId", "itemPara", "recordTime", "createTime", "kpiId",
            round2(f).alias("forecastValue"), round2(upper).alias("forecastValueUpper"),
            round2(lower).alias("forecastValueLower"), "nodeCode", "deviceSet", "abnormal",
        )
        .where(F.col("forecastValue") >= 0)
    )
