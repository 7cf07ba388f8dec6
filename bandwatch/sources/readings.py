"""Scans of raw readings and of forecasts.

Filters and column lists are plain expressions over the stored columns, so they
reach the parquet scan; day partitions are pruned by the ``dt`` predicate.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwatch import schemas
from bandwatch.functions.values import vendor_of

WHOLE_ELEMENT = "-1"
PORT_TYPE = "INTERFACE"


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """Raw readings stored by day in ``dt`` partitions."""
    return spark.read.parquet(path)


def rename_raw(raw: DataFrame) -> DataFrame:
    """Raw column names to the names used downstream; only these columns are kept."""
    return raw.select(*[F.col(old).alias(new) for old, new in schemas.RAW_TO_ACTUAL.items()])


def day_range(table: DataFrame, today: dt.date | Column, back: int = 7, day: str = "dt") -> DataFrame:
    """Day partitions from ``back`` days before ``today`` up to it; missing days add nothing."""
    last = F.lit(today) if isinstance(today, dt.date) else today
    return table.where(F.col(day).between(F.date_sub(last, back), last))


def item_level(resource_type: Column, item: Column) -> Column:
    """Ports for the port type, whole elements for every other type."""
    return (resource_type == F.lit(PORT_TYPE)) != (item == F.lit(WHOLE_ELEMENT))


def device_kpis(resource_rules: DataFrame) -> DataFrame:
    """One row per (resource type, device set, KPI)."""
    return resource_rules.select(
        "resourceType", F.explode("deviceSets").alias("deviceSet"), "kpiIds"
    ).select("resourceType", "deviceSet", F.explode("kpiIds").alias("kpiId"))


def history_scan(readings: DataFrame, resource_rules: DataFrame) -> DataFrame:
    """Readings of each resource type's devices and KPIs at its item level, all elements at once.

    The rules are a small local table; their lists also go to the scan as filters.
    """
    rules = resource_rules.select("deviceSets", "kpiIds").collect()
    listed = F.col("deviceSet").isin(sorted({d for r in rules for d in r.deviceSets})) & F.col("kpiId").isin(
        sorted({k for r in rules for k in r.kpiIds}))
    day = ["dt"] if "dt" in readings.columns else []
    return (
        readings.where(listed).join(device_kpis(resource_rules), ["deviceSet", "kpiId"])
        .where(item_level(F.col("resourceType"), F.col("itemPara")))
        .select("resId", "nodeCode", "deviceSet", "itemPara", "recordTime", "kpiId", "kpiValue", "resourceType", *day)
    )


def slot_scan(readings: DataFrame, resource_rules: DataFrame, slot: Column | None = None) -> DataFrame:
    """The same rows with slot and vendor; one slot when given, else every slot."""
    if slot is not None:
        readings = readings.where(F.col("recordTime") == slot)
    return history_scan(readings, resource_rules).select(
        *schemas.ACTUAL.names[:7],
        "resourceType",
        F.col("recordTime").alias("minId"),
        vendor_of(F.col("deviceSet")).alias("vender"),
    )


def rows_after(readings: DataFrame, last_seen: DataFrame) -> DataFrame:
    """Rows newer than each element's last known time; unknown elements come whole.

    ``last_seen`` has ``lastTime`` by ``resId``, or by ``resId`` and ``itemPara``.
    """
    key = [c for c in ("resId", "itemPara") if c in last_seen.columns]
    return (
        readings.join(last_seen, key, "left")
        .where(F.col("lastTime").isNull() | (F.col("recordTime") > F.col("lastTime")))
        .select(*readings.columns)
    )


def days_after(table: DataFrame, last_seen: DataFrame, oldest: dt.date, day: str = "dt") -> DataFrame:
    """Day partitions from ``oldest`` on that can hold rows newer than an element's last time.

    ``oldest`` prunes the partitions, so one silent element does not make a run read all
    days; within them each known element is read from the day of its last time, an
    unknown one whole.
    """
    key = [c for c in ("resId", "itemPara") if c in last_seen.columns]
    kept = table.where(F.col(day) >= F.lit(oldest)).join(last_seen, key, "left")
    return kept.where(F.col("lastTime").isNull() | (F.col(day) >= F.to_date("lastTime"))).select(*table.columns)


def forecast_slot_scan(forecasts: DataFrame, slot: Column | None = None, day: str = "dt") -> DataFrame:
    """Forecast rows of one slot from its day partition, or of every slot."""
    if slot is not None:
        forecasts = forecasts.where((F.col(day) == F.to_date(slot)) & (F.col("recordTime") == slot))
    return forecasts.select(
        "resId", "itemPara", "recordTime", "createTime", "kpiId", "forecastValue", "nodeCode", "deviceSet"
    )


def read_weights(spark: SparkSession, path: str) -> DataFrame:
    """Weight table from CSV with a leading index column."""
    layout = "_idx int, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.WEIGHT)
    return spark.read.csv(path, header=True, schema=layout).drop("_idx")


def weight_dim(weights: DataFrame) -> DataFrame:
    """The four columns scoring needs."""
    return weights.select("resourceType", "kpiId", "abnScoreWeight", "isRateKpi")
