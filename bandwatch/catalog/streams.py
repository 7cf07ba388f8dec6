"""Streaming queries: the event table as a stream, run until its end."""

from __future__ import annotations

from pyspark.sql import functions as F

from bandwatch import fixtures as fx
from bandwatch.catalog.base import register
from bandwatch.catalog.scoring import stored_forecasts
from bandwatch.catalog.sql import query, text
from bandwatch.functions.values import vendor_of
from bandwatch.plans import scoring as plan
from bandwatch.schemas import KPI_SCORE_KEY
from bandwatch.session import work_dir
from bandwatch.sinks.tables import append_by_day, open_table
from bandwatch.streaming import jobs

# slots the watermark has passed at the end of the input
_CLOSED = "recordTime + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 25 MINUTE"


def stream_source(spark, folder: str, layout, pattern: str = "*.parquet"):
    return spark.readStream.schema(layout).option("pathGlobFilter", pattern).parquet(folder)


def as_readings(events):
    """Event rows as stream readings with a zoned time."""
    raw = {n: c.alias(m) for (n, c), m in zip(
        fx.element_columns().items(), ["resId", "nodeCode", "deviceSet", "itemPara", "recordTime", "kpiId"]
    ) if n != "RECORD_TIME"}
    kind = F.when(F.split_part("deviceSet", F.lit("_"), F.lit(3)) == "A", "T0").otherwise("T1")
    return events.select(
        F.col("ts").cast("timestamp").alias("ts"), *raw.values(), fx.reading_value(True).alias("kpiValue")
    ).withColumns({"resourceType": kind, "vender": vendor_of(F.col("deviceSet"))})


def event_stream(spark, sf):
    layout = fx.events(spark, sf).schema
    return as_readings(stream_source(spark, sf, layout, "events.parquet"))


def run(spark, name: str, stream):
    root = work_dir(spark, name)
    return jobs.drain(spark, stream, f"{root}/table", f"{root}/state")


@register("stream_kpi_slots", query(f"""SELECT {text('minId')} AS "minId", resId, nodeCode, deviceSet, itemPara, kpiId,
    resourceType, vender, kpiValue FROM actual WHERE {_CLOSED}"""))
def stream_kpi_slots(spark, sf):
    slots = jobs.slot_stream(event_stream(spark, sf), fx.STEP)
    table, _ = run(spark, "slots", slots.withColumn("minId", jobs.slot_time()).drop("slot"))
    return table


@register("stream_window_score", query(f"""SELECT {text('minId')} AS "minId", nodeCode, resId, resourceType, vender,
    CAST(windowScore AS BIGINT) AS windowScore, abnScore,
    CASE WHEN abnScore IS NULL THEN NULL WHEN abnScore < 40 THEN 1 WHEN abnScore < 60 THEN 2
      WHEN abnScore < 80 THEN 3 ELSE 4 END AS abnLevel,
    CASE WHEN windowScore >= 100 THEN 1 ELSE 0 END AS isWindowAlarm,
    CASE WHEN windowScore >= 200 THEN 1 ELSE 0 END AS isWindowAbn
    FROM windows WHERE {_CLOSED.replace('recordTime', 'minId')}"""))
def stream_window_score(spark, sf):
    """Readings to element windows as one streaming plan over stored bands."""
    rules = fx.kpi_rules(spark)
    bands = plan.stage(plan.rebanded(stored_forecasts(spark, sf), rules), "bands")
    stream = jobs.score_stream(event_stream(spark, sf), bands, rules, fx.weights(spark), fx.STEP)
    table, _ = run(spark, "windows", stream)
    return table


@register("stream_keyed_upsert", query(f"""SELECT md5({text('minId')} || '-' || resId || '-' || kpiId) AS _id,
    {text('minId')} AS "minId", resId, kpiId, kpiValue FROM actual WHERE {_CLOSED}"""))
def stream_keyed_upsert(spark, sf):
    """Closed slots through a keyed sink, which receives each batch twice."""
    root = work_dir(spark, "upserts")
    slots = jobs.slot_stream(event_stream(spark, sf), fx.STEP)
    write = jobs.upsert_batches(f"{root}/table", KPI_SCORE_KEY, lambda df: F.to_date("minId"))

    def twice(batch, number):
        held = batch.persist()  # the stream's state is gone through once
        try:
            write(held, number)
            write(held, number)
        finally:
            held.unpersist()

    job = (
        slots.select(jobs.slot_time().alias("minId"), "resId", "kpiId", "kpiValue")
        .writeStream.foreachBatch(twice).option("checkpointLocation", f"{root}/state")
        .trigger(availableNow=True).start()
    )
    job.awaitTermination()
    return open_table(spark, f"{root}/table").drop("part")


@register("stream_dedup", query(f"""SELECT DISTINCT resId, itemPara, kpiId, {text('recordTime')} AS slot FROM readings"""))
def stream_dedup(spark, sf):
    stream = jobs.dedup_stream(event_stream(spark, sf), fx.STEP)
    table, _ = run(spark, "dedup", stream.select("resId", "itemPara", "kpiId", F.col("slot").cast("timestamp_ntz").alias("slot")))
    return table


_ONTIME = "(SELECT max(ts) - INTERVAL 25 MINUTE FROM events WHERE event_type <> 'error')"


@register("stream_late_data", query(f"""SELECT kpiId, count(*) AS slots, true AS someDropped FROM (
      SELECT DISTINCT resId, kpiId, recordTime FROM readings WHERE {_CLOSED}
        AND (kpiId <> 'error' OR recordTime + INTERVAL 1 HOUR > {_ONTIME})) GROUP BY kpiId"""))
def stream_late_data(spark, sf):
    """Error events are delivered after the stream has passed the month, and the stream resumes."""
    root = work_dir(spark, "late")
    events = fx.events(spark, sf)
    dropped = 0
    for late in (False, True):
        events.where((F.col("event_type") == "error") == late).write.mode("append").parquet(f"{root}/source")
        stream = jobs.slot_stream(as_readings(stream_source(spark, f"{root}/source", events.schema)), fx.STEP)
        table, late_rows = jobs.drain(
            spark, stream.withColumn("minId", jobs.slot_time()).drop("slot"), f"{root}/table", f"{root}/state"
        )
        dropped += late_rows
    return table.groupBy("kpiId").agg(F.count(F.lit(1)).alias("slots"), F.lit(dropped > 0).alias("someDropped"))


_WINDOWS = f"""SELECT {text('minId')} AS "minId", nodeCode, resId, resourceType, vender,
    CAST(windowScore AS DOUBLE) AS windowScore, CAST(abnScore AS DOUBLE) AS abnScore,
    CASE WHEN abnScore IS NULL THEN NULL WHEN abnScore < 40 THEN 1 WHEN abnScore < 60 THEN 2
      WHEN abnScore < 80 THEN 3 ELSE 4 END AS abnLevel,
    CASE WHEN windowScore >= 100 THEN 1 ELSE 0 END AS isWindowAlarm,
    CASE WHEN windowScore >= 200 THEN 1 ELSE 0 END AS isWindowAbn
    FROM windows WHERE {_CLOSED.replace('recordTime', 'minId')}"""


@register("stream_rolling_forecast", query(_WINDOWS))
def stream_rolling_forecast(spark, sf):
    """Running streams that have consumed the first half of the events when the forecasts of the second half are written.

    One scores slots as they close, the other keeps three scores of each element as its state.
    """
    root, middle = work_dir(spark, "rolling"), F.lit("2024-01-16").cast("timestamp_ntz")
    events, forecasts = fx.events(spark, sf), stored_forecasts(spark, sf)
    halves = (events.where(F.col("ts") < middle), forecasts.where(F.col("recordTime") < middle)), (
        events.where(F.col("ts") >= middle), forecasts.where(F.col("recordTime") >= middle))
    running = []
    try:
        for e, f in halves:
            append_by_day(f, f"{root}/forecast", "recordTime")
            e.write.mode("append").parquet(f"{root}/source")
            if not running:
                stream = as_readings(stream_source(spark, f"{root}/source", events.schema))
                running.append(jobs.score_closed_slots(
                    stream, f"{root}/forecast", root, fx.kpi_rules(spark), fx.weights(spark), fx.STEP).start())
                running.append(
                    jobs.rolling_windows(spark, root, fx.STEP).writeStream.format("parquet").option("path", f"{root}/windows")
                    .option("checkpointLocation", f"{root}/window-state").start())
            for job in running:
                job.processAllAvailable()
    finally:
        for job in running:
            job.stop()
    return spark.read.parquet(f"{root}/windows")


@register("stream_late_corrections", query(_WINDOWS))
def stream_late_corrections(spark, sf):
    """Error events come after the stream has passed the month; their slots are scored again, and the windows are those of all events."""
    root = work_dir(spark, "corrections")
    events = fx.events(spark, sf)
    append_by_day(stored_forecasts(spark, sf), f"{root}/forecast", "recordTime")
    for late in (False, True):
        events.where((F.col("event_type") == "error") == late).write.mode("append").parquet(f"{root}/source")
        stream = as_readings(stream_source(spark, f"{root}/source", events.schema))
        job = jobs.score_with_corrections(stream, f"{root}/forecast", root, fx.kpi_rules(spark), fx.weights(spark), fx.STEP, by="day")
        job.trigger(availableNow=True).start().awaitTermination()
    return open_table(spark, f"{root}/windows").drop("_id", "day")
