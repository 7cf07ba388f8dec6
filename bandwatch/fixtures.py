"""KPI tables derived from an event table.

Elements are groups of 40 users, KPIs are event types, slots are hours. Cells use
``max``, which does not depend on summation order.
"""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bandwatch import rules
from bandwatch.functions.times import shift, slot_of
from bandwatch.session import configure
from bandwatch.sources.readings import rename_raw, slot_scan

STEP = 3600
RUN_TIME = dt.datetime(2024, 2, 1)
KPIS = ["click", "error", "purchase", "signup", "view"]
VENDORS = ["ER", "HW", "ZX"]
KPI_TABLE = {
    "purchase": ("MAX_BEST", "RATE", "low"),
    "click": ("SCALE_DECR", "VOLUME", "low"),
    "error": ("MIN_BEST", "CPU", "high"),
    "signup": ("SCALE_INCR", "LOAD", "high"),
    "view": ("SCALE_INCR", "FAIL", "high"),
}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/events.parquet")


def kpi_rules(spark: SparkSession) -> DataFrame:
    rows = [rules.kpi_rule_row(kpi, *parts) for kpi, parts in KPI_TABLE.items()]
    return rules.local_table(spark, rows, rules.KPI_RULE_FIELDS)


def resource_rules(spark: SparkSession, narrow: bool = False) -> DataFrame:
    """T0 and T1 by the third token of the device set; narrow leaves out parts of T1."""
    devices = {
        kind: [f"DEV_5G_{letter}_{v}_COM" for v in VENDORS]
        for kind, letter in (("T0", "A"), ("T1", "S"))
    }
    kpis = {"T0": KPIS, "T1": KPIS}
    if narrow:
        devices["T1"] = devices["T1"][:2]
        kpis["T1"] = [k for k in KPIS if k != "signup"]
    return rules.resource_rules(spark, devices, kpis)


def weights(spark: SparkSession) -> DataFrame:
    """0.2 for every KPI; T1 has none for views."""
    rows = [
        dict(resourceType=kind, kpiId=kpi, kpiName=None, abnScoreWeight=Decimal("0.2000000000000000"),
             isRateKpi=int(kpi == "purchase"))
        for kind in ("T0", "T1")
        for kpi in KPIS
        if (kind, kpi) != ("T1", "view")
    ]
    fields = {
        "resourceType": pa.string(), "kpiId": pa.string(), "kpiName": pa.string(),
        "abnScoreWeight": pa.decimal128(20, 16), "isRateKpi": pa.int32(),
    }
    return rules.local_table(spark, rows, fields)


def element_columns() -> dict:
    """Element, node, device set and item of an event.

    The item is -1 for every event, as a column the optimizer cannot fold out of the keys.
    """
    element = "cast(floor(user_id / 40) as bigint)"
    letter = f"if({element} % 2 = 0, 'A', 'S')"
    vendor = f"case {element} % 3 when 0 then 'ER' when 1 then 'HW' else 'ZX' end"
    return {
        "RESID": F.expr(f"concat('ne', {element})"),
        "NODECODE": F.expr("concat('node', cast(floor(user_id / 160) as bigint))"),
        "DEVICE_SET": F.expr(f"concat_ws('_', 'DEV_5G', {letter}, {vendor}, 'COM')"),
        "ITEM_PARA": F.expr("concat('-', cast(sign(user_id + 1) as int))"),
        "RECORD_TIME": slot_of(F.col("ts"), STEP),
        "ITEM_CODE": F.col("event_type"),
    }


def reading_value(floor_at_zero: bool):
    rate = "100 - value / 4"
    if floor_at_zero:
        rate = f"greatest(0.0D, {rate})"
    return F.expr(f"case event_type when 'purchase' then {rate} when 'click' then value * 1000 else value end")


def raw_cells(events: DataFrame) -> DataFrame:
    """Raw readings, one per element, KPI and hour."""
    columns = element_columns()
    return (
        events.select(*[c.alias(n) for n, c in columns.items()], reading_value(True).alias("VALUE"))
        .groupBy(*columns)
        .agg(F.max("VALUE").alias("VALUE"))
    )


def event_readings(events: DataFrame) -> DataFrame:
    """One reading per event, out-of-range values included."""
    return events.select(
        "event_id", *[c.alias(n) for n, c in element_columns().items()], reading_value(False).alias("VALUE")
    )


def actual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slot_scan(rename_raw(raw_cells(events(spark, sf_dir))), resource_rules(spark))


def forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean of the three cells before, standing in for a model's forecast."""
    cells = rename_raw(raw_cells(events(spark, sf_dir)))
    order = Window.partitionBy("resId", "kpiId").orderBy("recordTime")
    before = {f"l{i}": F.lag("kpiValue", i).over(order) for i in (1, 2, 3)}
    return (
        cells.withColumns(before)
        .withColumn("forecastValue", F.expr("(l1 + l2 + l3) / 3.0D"))
        .where("l3 is not null")
        .select("resId", "itemPara", "recordTime", shift(F.col("recordTime"), -6 * 3600).alias("createTime"),
                "kpiId", "forecastValue", "nodeCode", "deviceSet")
    )
