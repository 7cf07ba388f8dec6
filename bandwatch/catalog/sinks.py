"""Sink queries: each writes to the shared folder and reads back."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from bandwatch import fixtures as fx
from bandwatch import schemas
from bandwatch.catalog.base import register
from bandwatch.catalog.sql import query, text
from bandwatch.schemas import KPI_SCORE_KEY
from bandwatch.session import work_dir
from bandwatch.sources.readings import rename_raw
from bandwatch.sinks import tables
from bandwatch.sinks.audit import differences
from bandwatch.sinks.history import HistoryStore


@register("forecast_day_sink", query("""SELECT CAST(CAST(recordTime AS DATE) AS VARCHAR) AS dt, count(*) AS n,
    max(forecastValue) AS top FROM forecasts GROUP BY 1"""))
def forecast_day_sink(spark, sf):
    table = tables.append_by_day(fx.forecast(spark, sf), work_dir(spark, "forecast"), "recordTime")
    return table.groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.max("forecastValue").alias("top"))


_ID = f"md5({text('minId')} || '-' || resId || '-' || kpiId)"


@register("record_id_hash", query(f"""SELECT {_ID} AS _id, {text('minId')} AS "minId", resId, kpiId FROM actual"""))
def record_id_hash(spark, sf):
    return tables.with_record_id(fx.actual(spark, sf), KPI_SCORE_KEY).select("_id", *KPI_SCORE_KEY)


@register("keyed_upsert_sink", query(f"""SELECT {_ID} AS _id, {text('minId')} AS "minId", resId, kpiId, resourceType,
    CASE resourceType WHEN 'T1' THEN kpiValue + 1 ELSE kpiValue END AS kpiValue FROM actual"""))
def keyed_upsert_sink(spark, sf):
    """All cells, then corrected cells of one type, then those once more."""
    cells = fx.actual(spark, sf).select("minId", "resId", "kpiId", "resourceType", "kpiValue")
    fixed = cells.where(F.col("resourceType") == "T1").withColumn("kpiValue", F.col("kpiValue") + 1)
    path, day = work_dir(spark, "scores"), F.to_date("minId")
    for batch in (cells, fixed, fixed):
        table = tables.upsert(batch, path, KPI_SCORE_KEY, day)
    return table.drop("part")


@register("enforce_output_schema", query(f"""SELECT resId, nodeCode, deviceSet, itemPara, {text('recordTime')} AS recordTime,
    kpiId, kpiValue, resourceType, {text('minId')} AS "minId", vender FROM actual"""))
def enforce_output_schema(spark, sf):
    """Columns in another order, with times as text, brought to the declared layout."""
    mixed = fx.actual(spark, sf).select(
        *[F.col(c).cast("string") if c in ("minId", "recordTime") else F.col(c) for c in sorted(schemas.ACTUAL.names)]
    )
    return tables.enforce_schema(mixed, schemas.ACTUAL)


@register("write_audit", query("SELECT count(*) AS offered, count(*) AS stored, true AS complete FROM actual"))
def write_audit(spark, sf):
    table, offered = tables.audited_write(fx.actual(spark, sf), work_dir(spark, "audit"))
    return table.agg(F.lit(offered).cast("long").alias("offered"), F.count(F.lit(1)).alias("stored")).withColumn(
        "complete", F.col("offered") == F.col("stored")
    )


@register("records_to_json", query(f"""SELECT CAST(to_json({{'minId': {text('minId')}, 'resId': resId, 'kpiId': kpiId,
    'resourceType': resourceType, 'vender': vender}}) AS VARCHAR) AS record FROM actual"""))
def records_to_json(spark, sf):
    stamp = F.date_format("minId", "yyyy-MM-dd HH:mm:ss").alias("minId")
    return tables.as_json(fx.actual(spark, sf).select(stamp, "resId", "kpiId", "resourceType", "vender"))


@register("stale_forecast_rewrite", query(f"""SELECT resId, itemPara, kpiId, {text('recordTime')} AS recordTime,
    {text("createTime + CASE WHEN kpiId IN ('click', 'view') THEN INTERVAL 1 HOUR ELSE INTERVAL 0 HOUR END")} AS createTime,
    CASE WHEN kpiId IN ('click', 'view') THEN forecastValue + 1 ELSE forecastValue END AS forecastValue FROM forecasts"""))
def stale_forecast_rewrite(spark, sf):
    """Newer forecasts of some KPIs first, then all the older ones once more."""
    old = fx.forecast(spark, sf)
    new = old.where(F.col("kpiId").isin("click", "view")).withColumns(
        {"createTime": F.expr("timestampadd(HOUR, 1, createTime)"), "forecastValue": F.col("forecastValue") + 1})
    path, day = work_dir(spark, "stale"), F.to_date("recordTime")
    for batch in (new, old):
        table = tables.upsert(batch, path, schemas.FORECAST_KEY, day, [F.col("createTime")], "dt")
    return table.select("resId", "itemPara", "kpiId", "recordTime", "createTime", "forecastValue")


@register("port_scores_sink", query(f"""SELECT md5({text('recordTime')} || '-' || resId || '-' || kpiId || '-port' || user_id) AS _id,
    resId, 'port' || user_id AS itemPara, kpiId, {text('recordTime')} AS "minId", max(kpiValue) AS kpiValue
    FROM readings GROUP BY resId, user_id, kpiId, recordTime"""))
def port_scores_sink(spark, sf):
    """Each user a port of its element: ports stay apart in a keyed table that is written twice."""
    c = fx.element_columns()
    rows = fx.events(spark, sf).select(
        c["RECORD_TIME"].alias("minId"), c["RESID"].alias("resId"), F.concat(F.lit("port"), F.col("user_id")).alias("itemPara"),
        F.col("event_type").alias("kpiId"), fx.reading_value(False).alias("kpiValue"))
    cells = rows.groupBy("minId", "resId", "itemPara", "kpiId").agg(F.max("kpiValue").alias("kpiValue"))
    path = work_dir(spark, "ports")
    for batch in (cells, cells.where(F.col("kpiId") == "error")):
        table = tables.upsert(batch, path, KPI_SCORE_KEY, F.to_date("minId"))
    return table.drop("part")


class _Stopped(Exception):
    pass


@register("recovered_upsert_sink", query(f"""SELECT {_ID} AS _id, {text('minId')} AS "minId", resId, kpiId, resourceType,
    CASE WHEN kpiId = 'view' THEN kpiValue + 2 WHEN resourceType = 'T1' THEN kpiValue + 1 ELSE kpiValue END AS kpiValue FROM actual"""))
def recovered_upsert_sink(spark, sf):
    """Corrections of one type that stop at every step and are repeated, while another writer changes a KPI of the same days."""
    cells = fx.actual(spark, sf).select("minId", "resId", "kpiId", "resourceType", "kpiValue")
    fixed = cells.where((F.col("resourceType") == "T1") & (F.col("kpiId") != "view")).withColumn("kpiValue", F.col("kpiValue") + 1)
    views = cells.where(F.col("kpiId") == "view").withColumn("kpiValue", F.col("kpiValue") + 2)
    path, day = work_dir(spark, "recovered"), F.to_date("minId")
    tables.upsert(cells, path, KPI_SCORE_KEY, day)
    for where in ("staged", "written", "committed"):
        def stop(step, where=where):
            if step == where:
                raise _Stopped

        try:
            tables.upsert(fixed, path, KPI_SCORE_KEY, day, step=stop)
        except _Stopped:
            pass
    others = iter([views])

    def meanwhile(step):
        for rows in others if step == "written" else ():
            tables.upsert(rows, path, KPI_SCORE_KEY, day)

    tables.upsert(fixed, path, KPI_SCORE_KEY, day, step=meanwhile)
    return tables.open_table(spark, path).drop("part")


_CHANGED = "kpiId = 'click' AND hour(minId) = 5 AND CAST(minId AS DATE) = DATE '2024-01-09'"
_SWAPPED = "kpiId = 'error' AND hour(minId) = 7 AND CAST(minId AS DATE) = DATE '2024-01-20'"


@register("write_fingerprint_audit", query(f"""SELECT CAST(CAST(minId AS DATE) AS VARCHAR) AS "day", {text('minId')} AS "minId", resId, kpiId,
    'changed' AS kind FROM actual WHERE {_CHANGED}
    UNION ALL SELECT CAST(CAST(minId AS DATE) AS VARCHAR), {text('minId')}, resId, kpiId, 'missing' FROM actual WHERE {_SWAPPED}
    UNION ALL SELECT CAST(CAST(minId AS DATE) AS VARCHAR), {text('minId')}, resId || '-x', kpiId, 'extra' FROM actual WHERE {_SWAPPED}"""))
def write_fingerprint_audit(spark, sf):
    """A stored copy with as many rows as were offered, of which some have another value and some another element."""
    cells = fx.actual(spark, sf).select("minId", "resId", "kpiId", "kpiValue").withColumn("day", F.to_date("minId"))
    spoilt = cells.withColumn("kpiValue", F.when(F.expr(_CHANGED), F.col("kpiValue") + 1).otherwise(F.col("kpiValue"))).withColumn(
        "resId", F.when(F.expr(_SWAPPED), F.concat("resId", F.lit("-x"))).otherwise(F.col("resId")))
    offered, _ = tables.audited_write(cells, work_dir(spark, "offered"), "offered")
    stored, _ = tables.audited_write(spoilt, work_dir(spark, "stored"), "stored")
    return differences(offered, stored, ["minId", "resId", "kpiId"], ["day"])


@register("history_versions", query(f"""SELECT resId, kpiId, {text('recordTime')} AS recordTime, kpiValue, 2 AS version FROM (
      SELECT *, row_number() OVER (PARTITION BY resId ORDER BY recordTime DESC, kpiId DESC) AS back FROM cells) WHERE back > 3"""))
def history_versions(spark, sf):
    """Histories with text times whose tails are unreadable: version 3 is damaged, version 4 never completed; version 2 is read."""
    store = HistoryStore(spark, work_dir(spark, "history"))
    rows = rename_raw(fx.raw_cells(fx.events(spark, sf))).select("resId", "kpiId", "recordTime", "kpiValue")
    place = Window.partitionBy("resId").orderBy("recordTime", "kpiId")
    back = Window.partitionBy("resId").orderBy(F.desc("recordTime"), F.desc("kpiId"))
    texts = rows.withColumns({"position": F.row_number().over(place), "back": F.row_number().over(back)}).select(
        "resId", "kpiId", F.when(F.col("back") <= 3, "cut o").otherwise(F.date_format("recordTime", "yyyy-MM-dd HH:mm:ss")).alias("recordTime"),
        "kpiValue", "position")
    for factor in (0.0, 1.0, 2.0):
        store.write(texts.withColumn("kpiValue", F.col("kpiValue") * factor))
    texts.limit(5).write.mode("overwrite").parquet(store.path(3))
    texts.limit(7).write.parquet(store.path(4))
    version, history = store.read()
    return history.select("resId", "kpiId", "recordTime", "kpiValue", F.lit(version).alias("version"))
