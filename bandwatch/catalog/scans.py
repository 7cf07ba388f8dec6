"""Scans, filters, cleaning and registry queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from bandwatch import fixtures as fx
from bandwatch.catalog.base import register
from bandwatch.catalog.sql import query, text
from bandwatch.functions import times
from bandwatch.functions.values import vendor_of
from bandwatch.operators import cleaning, registry, series
from bandwatch.session import work_dir
from bandwatch.sinks.tables import append_by_day
from bandwatch.sources import readings as src
from bandwatch.sources.filestats import add_stats, rows_after_by_files


def cells(spark, sf):
    return src.rename_raw(fx.raw_cells(fx.events(spark, sf)))


def event_rows(spark, sf):
    """Readings per event under downstream names."""
    raw = fx.event_readings(fx.events(spark, sf))
    return raw.select("event_id", *[F.col(o).alias(n) for o, n in src.schemas.RAW_TO_ACTUAL.items()])


@register("kpi_history_scan", query(f"""SELECT resId, nodeCode, deviceSet, itemPara, {text('recordTime')} AS recordTime,
    kpiId, kpiValue, resourceType FROM actual
    WHERE resourceType = 'T0' OR (vender <> 'ZX' AND kpiId <> 'signup')"""))
def kpi_history_scan(spark, sf):
    return src.history_scan(cells(spark, sf), fx.resource_rules(spark, narrow=True))


@register("kpi_slot_scan", query(f"""SELECT resId, nodeCode, deviceSet, itemPara, {text('recordTime')} AS recordTime,
    kpiId, kpiValue, resourceType, {text('minId')} AS minId, vender FROM actual"""))
def kpi_slot_scan(spark, sf):
    return src.slot_scan(cells(spark, sf), fx.resource_rules(spark))


@register("date_partition_scan", query("""SELECT CAST(CAST(today AS DATE) AS VARCHAR) AS today,
    CAST(count(*) AS BIGINT) AS days, CAST(sum(n) AS BIGINT) AS n FROM (
      SELECT d, count(*) AS n, unnest(generate_series(d, d + INTERVAL 7 DAY, INTERVAL 1 DAY)) AS today
      FROM (SELECT CAST(recordTime AS DATE) AS d FROM readings) GROUP BY d) GROUP BY today"""))
def date_partition_scan(spark, sf):
    """Partitions and rows of a table stored by day that a run on each day would read: its own day and the seven before."""
    stored = append_by_day(event_rows(spark, sf), work_dir(spark, "days"), "recordTime")
    per_day = stored.groupBy("dt").agg(F.count(F.lit(1)).alias("n"))
    runs = per_day.withColumn("today", F.explode(F.sequence("dt", F.date_add("dt", 7))))
    return (
        src.day_range(runs, F.col("today"), 7).groupBy("today")
        .agg(F.count(F.lit(1)).alias("days"), F.sum("n").alias("n"))
    )


@register("incremental_scan", query(f"""SELECT a.resId, a.kpiId, {text('a.recordTime')} AS recordTime, a.kpiValue
    FROM cells a LEFT JOIN (
      SELECT resId, max(recordTime) AS lastTime FROM actual
      WHERE (vender = 'ER' AND recordTime < TIMESTAMP '2024-01-10') OR (vender = 'HW' AND recordTime < TIMESTAMP '2024-01-20')
      GROUP BY resId) h ON a.resId = h.resId
    WHERE lastTime IS NULL OR a.recordTime > lastTime"""))
def incremental_scan(spark, sf):
    rows = cells(spark, sf)
    until = {"ER": dt.datetime(2024, 1, 10), "HW": dt.datetime(2024, 1, 20)}
    known = F.lit(False)
    for vendor, day in until.items():
        known = known | (
            (vendor_of(F.col("deviceSet")) == vendor) & (F.col("recordTime") < F.lit(day).cast("timestamp_ntz"))
        )
    last_seen = rows.where(known).groupBy("resId").agg(F.max("recordTime").alias("lastTime"))
    return src.rows_after(rows, last_seen).select("resId", "kpiId", "recordTime", "kpiValue")


@register("forecast_slot_scan", query(f"""SELECT resId, itemPara, {text('recordTime')} AS recordTime,
    {text('createTime')} AS createTime, kpiId, forecastValue, nodeCode, deviceSet FROM forecasts
    WHERE recordTime = TIMESTAMP '2024-01-07 08:00:00'"""))
def forecast_slot_scan(spark, sf):
    """One slot from the day partition of a stored table."""
    stored = append_by_day(fx.forecast(spark, sf), work_dir(spark, "forecast"), "recordTime")
    return src.forecast_slot_scan(stored, F.lit("2024-01-07 08:00:00").cast("timestamp_ntz"))


@register("kpi_weight_dim", query("""SELECT DISTINCT resourceType, kpiId, 0.2::DOUBLE AS abnScoreWeight,
    CASE kpiId WHEN 'purchase' THEN 1 ELSE 0 END AS isRateKpi FROM actual
    WHERE NOT (resourceType = 'T1' AND kpiId = 'view')"""))
def kpi_weight_dim(spark, sf):
    """Weights of the KPIs in use, written as CSV with an index column and read with the fixed layout."""
    used = fx.actual(spark, sf).select("resourceType", "kpiId").distinct()
    path = work_dir(spark, "weights")
    table = used.join(fx.weights(spark), ["resourceType", "kpiId"])
    table.select(F.lit(1).alias("_idx"), *src.schemas.WEIGHT.names).write.csv(path, header=True)
    return src.weight_dim(src.read_weights(spark, path))


@register("rename_raw", query(f"""SELECT resId, nodeCode, deviceSet, itemPara, {text('recordTime')} AS recordTime,
    kpiId, kpiValue FROM cells"""))
def rename_raw(spark, sf):
    return cells(spark, sf)


@register("item_level_filter", query(f"""SELECT * FROM (SELECT DISTINCT resId,
    CASE kpiId WHEN 'view' THEN 'port' || user_id ELSE '-1' END AS itemPara,
    CASE split_part(deviceSet, '_', 3) WHEN 'A' THEN 'T0' ELSE 'INTERFACE' END AS resourceType,
    kpiId, {text('recordTime')} AS recordTime FROM readings)
    WHERE (resourceType = 'INTERFACE') <> (itemPara = '-1')"""))
def item_level_filter(spark, sf):
    """Views count as port readings, elements of the second kind as ports."""
    e = fx.events(spark, sf)
    c = fx.element_columns()
    port = F.when(F.col("event_type") == "view", F.concat(F.lit("port"), F.col("user_id"))).otherwise("-1")
    kind = F.when(F.split_part(c["DEVICE_SET"], F.lit("_"), F.lit(3)) == "A", "T0").otherwise(src.PORT_TYPE)
    rows = e.select(c["RESID"].alias("resId"), port.alias("itemPara"), kind.alias("resourceType"),
                    F.col("event_type").alias("kpiId"), c["RECORD_TIME"].alias("recordTime"))
    return rows.where(src.item_level(F.col("resourceType"), F.col("itemPara"))).distinct()


@register("valid_reading_filter", query("""SELECT event_id, resId, kpiId, kpiValue FROM readings
    WHERE kpiValue >= 0 AND kpiValue <> 9223372036854775807::DOUBLE AND NOT isnan(kpiValue)"""))
def valid_reading_filter(spark, sf):
    return cleaning.valid_readings(event_rows(spark, sf)).select("event_id", "resId", "kpiId", "kpiValue")


@register("percent_cap_filter", query("""SELECT event_id, resId, kpiId, kpiValue FROM readings
    WHERE kpiId NOT IN ('purchase', 'error') OR kpiValue <= 100"""))
def percent_cap_filter(spark, sf):
    return cleaning.cap_percentages(event_rows(spark, sf), fx.kpi_rules(spark)).select(
        "event_id", "resId", "kpiId", "kpiValue"
    )


@register("vendor_extract", query("SELECT resId, deviceSet, vender, count(*) AS n FROM actual GROUP BY ALL"))
def vendor_extract(spark, sf):
    rows = cells(spark, sf).withColumn("vender", vendor_of(F.col("deviceSet")))
    return rows.groupBy("resId", "deviceSet", "vender").agg(F.count(F.lit(1)).alias("n"))


@register("dedup_rows", query(f"""SELECT DISTINCT resId, itemPara, {text('recordTime')} AS recordTime, kpiId,
    floor(kpiValue / 50.0) * 50.0 AS kpiValue FROM readings"""))
def dedup_rows(spark, sf):
    """Readings in coarse values, so that equal rows occur."""
    coarse = F.floor(F.col("kpiValue") / 50.0) * F.lit(50.0)
    return event_rows(spark, sf).select("resId", "itemPara", "recordTime", "kpiId", coarse.alias("kpiValue")).distinct()


_ISSUES = """SELECT resId, itemPara, recordTime, createTime, kpiId, forecastValue, nodeCode, deviceSet FROM forecasts
    UNION ALL SELECT resId, itemPara, recordTime, recordTime - INTERVAL 5400 SECOND, kpiId, l1, nodeCode, deviceSet
    FROM lagged WHERE l1 > l2"""


@register("dedup_latest_forecast", query(f"""SELECT resId, itemPara, {text('recordTime')} AS recordTime,
    {text('createTime')} AS createTime, kpiId, forecastValue, nodeCode, deviceSet
    FROM (SELECT *, row_number() OVER (PARTITION BY resId, itemPara, recordTime, kpiId
      ORDER BY createTime DESC, forecastValue) AS rn FROM issues) WHERE rn = 1""", issues=_ISSUES))
def dedup_latest_forecast(spark, sf):
    """Two overlapping issues: the usual one, and a later one for rising series."""
    order = Window.partitionBy("resId", "kpiId").orderBy("recordTime")
    rows = cells(spark, sf).withColumns(
        {"l1": F.lag("kpiValue", 1).over(order), "l2": F.lag("kpiValue", 2).over(order)}
    )
    usual = fx.forecast(spark, sf)
    later = rows.where(F.col("l1") > F.col("l2")).select(
        "resId", "itemPara", "recordTime", times.shift(F.col("recordTime"), -5400).alias("createTime"),
        "kpiId", F.col("l1").alias("forecastValue"), "nodeCode", "deviceSet",
    )
    return cleaning.latest_forecast(usual.unionByName(later))


@register("coerce_numeric", r"""SELECT event_id, txt, TRY_CAST(txt AS DOUBLE) AS number,
    txt IS NOT NULL AND TRY_CAST(txt AS DOUBLE) IS NULL AS rejected FROM (
      SELECT event_id, CASE event_type WHEN 'error' THEN props ELSE regexp_extract(props, '([0-9]+)', 1) END AS txt
      FROM events)""")
def coerce_numeric(spark, sf):
    """The number inside the properties; errors keep their whole text, which is not a number."""
    digits = F.regexp_extract("props", "([0-9]+)", 1)
    rows = fx.events(spark, sf).select(
        "event_id", F.when(F.col("event_type") == "error", F.col("props")).otherwise(digits).alias("txt")
    )
    return cleaning.to_number(rows, "txt", "number")


@register("repair_history_tail", query(f"""SELECT h.resId, event_id, recordTime FROM (
      SELECT resId, event_id, CASE kpiId WHEN 'error' THEN 'unknown' ELSE {text('ts')} END AS recordTime FROM readings) h
    JOIN (SELECT resId, max(event_id) AS last FROM readings WHERE kpiId <> 'error' GROUP BY resId) l
      ON h.resId = l.resId WHERE event_id <= last"""))
def repair_history_tail(spark, sf):
    """Error events have an unreadable time."""
    e = fx.events(spark, sf)
    stamp = F.when(F.col("event_type") == "error", "unknown").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    rows = e.select(fx.element_columns()["RESID"].alias("resId"), "event_id", stamp.alias("recordTime"))
    return cleaning.repair_tail(rows, position="event_id")


_BUSY = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY kpiId ORDER BY n DESC, resId) AS rank FROM (
        SELECT kpiId, 'u' || user_id AS resId, count(*) AS n FROM readings
        WHERE ts >= TIMESTAMP '2024-01-15 09:00:00' AND ts <= TIMESTAMP '2024-01-15 12:00:00' GROUP BY ALL)) WHERE rank <= 3"""


@register("active_elements_topk", query("""SELECT kpiId AS "resourceType", resId, n AS "rows", CAST(rank AS INTEGER) AS rank
    FROM busy""", busy=_BUSY))
def active_elements_topk(spark, sf):
    """Users as elements and event types as resource types: the three busiest of three hours, ties by id."""
    rows = fx.events(spark, sf).select(
        F.concat(F.lit("u"), F.col("user_id")).alias("resId"), F.col("event_type").alias("resourceType"),
        F.col("ts").cast("timestamp_ntz").alias("recordTime"))
    return registry.active_elements(rows, dt.datetime(2024, 1, 15, 12), k=3)


@register("element_registry", query("SELECT DISTINCT nodeCode, resId, resourceType, vender FROM actual"))
def element_registry(spark, sf):
    return registry.element_registry(fx.actual(spark, sf))


@register("series_extent", query(f"""SELECT resId, itemPara, {text('minTime')} AS minTime, {text('maxTime')} AS maxTime
    FROM extents"""))
def series_extent(spark, sf):
    return series.series_extent(cells(spark, sf))


@register("element_attrs", query("""SELECT resId, itemPara, any_value(nodeCode) AS nodeCode,
    any_value(deviceSet) AS deviceSet FROM cells GROUP BY resId, itemPara"""))
def element_attrs(spark, sf):
    return series.element_attrs(cells(spark, sf))


@register("slot_align", f"""SELECT event_id, {text('s')} AS "minId", {text('s - INTERVAL 5 MINUTE')} AS minIdBefore1,
    {text('s - INTERVAL 10 MINUTE')} AS minIdBefore2
    FROM (SELECT event_id, time_bucket(INTERVAL 5 MINUTE, ts, TIMESTAMP '2000-01-01') - INTERVAL 25 MINUTE AS s FROM events)""")
def slot_align(spark, sf):
    """Scoring slots if each event's time were now."""
    return fx.events(spark, sf).select("event_id", *[c.alias(n) for n, c in times.scoring_slots(F.col("ts")).items()])


def _months(n: int) -> str:
    return text(f"CAST(ts AS DATE) - INTERVAL {n} MONTH + (ts - date_trunc('day', ts))")


@register("time_anchors", f"""SELECT event_id, {text('ts + INTERVAL 5 MINUTE')} AS nextSlot,
    {text('ts - INTERVAL 5 MINUTE')} AS lastSlot, {text('ts - INTERVAL 10 MINUTE')} AS last2Slot,
    {text('ts - INTERVAL 1 DAY')} AS lastDay, {text('ts + INTERVAL 1 DAY')} AS nextDay,
    {_months(1)} AS lastMonth, {_months(2)} AS last2Month,
    strftime(ts, '%Y-%m-%dT%H:%M:%S.000Z') AS f0, strftime(ts, '%Y-%m-%d %H:%M:%S') AS f1,
    strftime(ts, '%Y%m%d%H%M') AS f2, strftime(ts, '%Y%m%d') AS f3, strftime(ts, '%Y%m') AS f4,
    strftime(ts, '%Y-%m-%d %H:%M') AS f5 FROM (SELECT event_id, date_trunc('second', ts) AS ts FROM events)""")
def time_anchors(spark, sf):
    second = times.slot_of(F.col("ts"), 1)
    rows = fx.events(spark, sf).select("event_id", second.alias("ts"))
    named = [c.alias(n) for n, c in times.calendar_anchors(F.col("ts")).items()]
    texts = [times.format_time(F.col("ts"), kind).alias(f"f{kind}") for kind in times.TIME_FORMATS]
    return rows.select("event_id", *named, *texts)


@register("run_time_stamp", query(f"""SELECT resId, {text('max(recordTime) + INTERVAL 1 HOUR')} AS createTime FROM cells GROUP BY resId"""))
def run_time_stamp(spark, sf):
    """Stamp of the first run that has all of an element's readings: the slot after its last one, in text form 1."""
    last = cells(spark, sf).groupBy("resId").agg(F.max("recordTime").alias("t"))
    return last.select("resId", times.format_time(times.shift(F.col("t"), fx.STEP), 1).alias("createTime"))


_SEEN = """SELECT resId, CASE WHEN resId = 'ne2' THEN TIMESTAMP '2024-01-12 10:00:00' ELSE TIMESTAMP '2024-01-27 04:00:00' END AS lastTime
    FROM cells WHERE resId <> 'ne1' GROUP BY resId"""


@register("incremental_scan_by_files", query(f"""SELECT c.resId, kpiId, {text('recordTime')} AS recordTime, kpiValue, true AS fewerFiles
    FROM cells c LEFT JOIN seen s ON c.resId = s.resId
    WHERE CASE WHEN c.resId = 'ne1' THEN recordTime >= TIMESTAMP '2024-01-25' ELSE recordTime > s.lastTime END""", seen=_SEEN))
def incremental_scan_by_files(spark, sf):
    """New rows of a table stored by day, read through its files' statistics, which are added to after each of two deliveries.

    One element is unknown and reports from the 25th on only; the others are known up to some time.
    """
    raw = src.rename_raw(fx.raw_cells(fx.events(spark, sf))).where("resId <> 'ne1' or recordTime >= timestamp_ntz'2024-01-25'")
    root, middle = work_dir(spark, "by-files"), F.lit("2024-01-20").cast("timestamp_ntz")
    for part in (raw.where(F.col("recordTime") < middle), raw.where(F.col("recordTime") >= middle)):
        table = append_by_day(part, f"{root}/raw", "recordTime")
        stats = add_stats(table, f"{root}/stats")
    last = F.when(F.col("resId") == "ne2", F.lit("2024-01-12 10:00:00")).otherwise(F.lit("2024-01-27 04:00:00"))
    seen = table.where("resId <> 'ne1'").groupBy("resId", "itemPara").agg(F.max("recordTime").alias("_")).select(
        "resId", "itemPara", last.cast("timestamp_ntz").alias("lastTime"))
    rows, opened = rows_after_by_files(table, stats, seen)
    return rows.select("resId", "kpiId", "recordTime", "kpiValue", F.lit(opened < len(table.inputFiles())).alias("fewerFiles"))
