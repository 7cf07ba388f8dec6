"""Row filters, duplicate removal and type repair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwatch.functions.values import NO_READING, is_number
from bandwatch.schemas import FORECAST_KEY

RATE_CLASSES = ("MAX_BEST", "MIN_BEST")


def valid_readings(df: DataFrame, value: str = "kpiValue") -> DataFrame:
    """Drop negative, missing, NaN and no-reading values."""
    v = F.col(value)
    return df.where(is_number(v) & (v >= 0) & (v != F.lit(NO_READING)))


def cap_percentages(df: DataFrame, kpi_rules: DataFrame, value: str = "kpiValue") -> DataFrame:
    """Drop rate KPIs above 100; other KPIs, classified or not, pass."""
    rates = kpi_rules.where(F.col("kpiClass").isin(*RATE_CLASSES)).select("kpiId", F.lit(True).alias("_rate"))
    return (
        df.join(rates, "kpiId", "left")
        .where(F.col("_rate").isNull() | (F.col(value) <= 100))
        .drop("_rate")
    )


def latest_forecast(forecasts: DataFrame) -> DataFrame:
    """One forecast per slot and series: the newest, the smaller value on a tie."""
    rest = [c for c in forecasts.columns if c not in FORECAST_KEY]
    newest = F.max_by(F.struct(*rest), F.struct("createTime", -F.col("forecastValue")))
    return (
        forecasts.groupBy(*FORECAST_KEY).agg(newest.alias("_row"))
        .select(*[F.col(c) if c in FORECAST_KEY else F.col(f"_row.{c}") for c in forecasts.columns])
    )


def to_number(df: DataFrame, text: str, number: str, strict: bool = False) -> DataFrame:
    """Parse text to double. Strict raises on bad text, otherwise it becomes null and is marked."""
    if strict:
        return df.withColumn(number, F.col(text).cast("double"))
    parsed = F.col(text).try_cast("double")
    return df.withColumn(number, parsed).withColumn("rejected", F.col(text).isNotNull() & F.col(number).isNull())


def repair_tail(history: DataFrame, time_text: str = "recordTime", position: str = "position") -> DataFrame:
    """Cut an element's history after its last row with a readable time.

    Elements without any readable time vanish. Unreadable rows before the last
    readable one stay.
    """
    readable = F.try_to_timestamp(F.col(time_text), F.lit("yyyy-MM-dd HH:mm:ss")).isNotNull()
    last = (
        history.groupBy("resId")
        .agg(F.max(F.when(readable, F.col(position))).alias("_last"))
        .where(F.col("_last").isNotNull())
    )
    return history.join(last, "resId").where(F.col(position) <= F.col("_last")).drop("_last")
