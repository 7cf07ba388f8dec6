"""Continuous scoring with Structured Streaming.

Streams need a zoned time column; it is named ``ts`` here and results turn back to
zone-free times.
"""

from __future__ import annotations

import datetime as dt
import threading
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from bandwatch.functions.times import epoch, from_epoch, slot_of
from bandwatch.functions.values import level_of
from bandwatch.operators.bands import reband
from bandwatch.operators.cleaning import cap_percentages, latest_forecast, valid_readings
from bandwatch.operators.scoring import deviation_score, element_scores, forecast_actual_join, kpi_scores, weighted_scores
from bandwatch.operators.windows import flags, window_score
from bandwatch.schemas import ELEMENT_DIMS, ELEMENT_WINDOW, WINDOW_KEY
from bandwatch.session import adaptive, work_dir
from bandwatch.sinks.log import TableLog
from bandwatch.sinks.tables import merge_into, open_table, upsert
from bandwatch.streaming import state as window_state

# the processor travels with its module, so executors need no installed copy
cloudpickle.register_pickle_by_value(window_state)

LATENESS = "25 minutes"
ELEMENT_SCORE = T.StructType([f for f in ELEMENT_WINDOW if f.name in ("minId", *ELEMENT_DIMS, "abnScore")])
CELL_DIMS = ["resId", "nodeCode", "deviceSet", "itemPara", "kpiId", "resourceType", "vender"]


def seconds(n: int) -> str:
    return f"{n} seconds"


def slot_stream(readings: DataFrame, step: int = 300, lateness: str = LATENESS,
                dims: list[str] | None = None) -> DataFrame:
    """Largest value per slot and series, emitted once the watermark passes the slot."""
    return (
        readings.withWatermark("ts", lateness)
        .groupBy(F.window("ts", seconds(step)).alias("slot"), *(dims or CELL_DIMS))
        .agg(F.max("kpiValue").alias("kpiValue"))
    )


def slot_time(column: str = "slot"):
    return F.col(f"{column}.start").cast("timestamp_ntz")


def element_stream(cells: DataFrame, bands: DataFrame, kpi_rules: DataFrame, weights: DataFrame) -> DataFrame:
    """Weighted element score per slot: cells joined with stored bands, rules and weights.

    Bands grow with elements and slots, and a stream plans by the size of their files, far below that of their rows; the
    hint keeps them from being broadcast.
    """
    band = bands.select(
        "resId", "itemPara", "kpiId", F.col("recordTime").alias("_slot"), "forecastValueUpper", "forecastValueLower"
    ).hint("merge")
    points = deviation_score(
        F.col("kpiValue"), F.col("forecastValueLower"), F.col("forecastValueUpper"), F.col("direction")
    )
    return (
        cap_percentages(valid_readings(cells), kpi_rules)
        .withColumn("_slot", slot_time())
        .join(band, ["resId", "itemPara", "kpiId", "_slot"])
        .join(kpi_rules.select("kpiId", "direction"), "kpiId", "left")
        .join(weights.select("resourceType", "kpiId", "abnScoreWeight"), ["resourceType", "kpiId"], "left")
        .groupBy("slot", *ELEMENT_DIMS)
        .agg(F.round(F.sum(points * F.col("abnScoreWeight")), 0).cast("int").alias("abnScore"))
    )


def window_stream(elements: DataFrame, step: int = 300) -> DataFrame:
    """Sum over three slots, sliding by one; windows without a row in their last slot are left out."""
    span = F.window(F.window_time("slot"), seconds(3 * step), seconds(step))
    return (
        elements.withColumn("_start", F.col("slot.start"))
        .groupBy(span.alias("span"), *ELEMENT_DIMS)
        .agg(F.sum("abnScore").alias("windowScore"), F.max("_start").alias("_last"),
             F.max_by("abnScore", "_start").alias("abnScore"))
        .where(F.col("_last") == F.col("span.end") - F.expr(f"interval {step} seconds"))
        .select(
            F.col("_last").cast("timestamp_ntz").alias("minId"), *ELEMENT_DIMS, "windowScore", "abnScore",
            level_of(F.col("abnScore")).alias("abnLevel"),
            *[c.alias(n) for n, c in flags(F.col("windowScore")).items()],
        )
    )


def dedup_stream(readings: DataFrame, step: int = 300, lateness: str = LATENESS) -> DataFrame:
    """First reading of each series and slot; the slot is part of the key."""
    return (
        readings.withWatermark("ts", lateness)
        .withColumn("slot", F.window("ts", seconds(step)).start)
        .dropDuplicatesWithinWatermark(["resId", "itemPara", "kpiId", "slot"])
    )


def score_stream(readings: DataFrame, bands: DataFrame, kpi_rules: DataFrame, weights: DataFrame,
                 step: int = 300, lateness: str = LATENESS) -> DataFrame:
    """Readings to element windows as one streaming plan."""
    cells = slot_stream(readings, step, lateness)
    return window_stream(element_stream(cells, bands, kpi_rules, weights), step)


def upsert_batches(path: str, key: list[str], partition: Callable[[DataFrame], object]):
    """Batch function for foreachBatch: a repeated batch leaves the same table."""

    def write(batch: DataFrame, _: int) -> None:
        with adaptive(batch.sparkSession):  # files by partition, not by task and partition
            upsert(batch, path, key, partition(batch))

    return write


def start(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Run over everything available into a parquet table, then stop."""
    return (
        stream.writeStream.format("parquet").outputMode(mode)
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


class LateRows(StreamingQueryListener):
    """Counts rows that came behind the watermark, over all batches of the queries it hears of."""

    def __init__(self):
        self.rows, self.ended = 0, threading.Event()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self.rows += sum(op.numRowsDroppedByWatermark for op in event.progress.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.ended.set()


def drain(spark: SparkSession, stream: DataFrame, path: str, checkpoint: str) -> tuple[DataFrame, int]:
    """Run to the end of the input; the written table, and how many rows came too late for it."""
    late = LateRows()
    spark.streams.addListener(late)
    try:
        query = start(stream, path, checkpoint)
        query.awaitTermination()
        late.ended.wait(60)  # its last events come after the query's end
    finally:
        spark.streams.removeListener(late)
    if query.exception() is not None:
        raise query.exception()
    return spark.read.schema(stream.schema).parquet(path), late.rows


def closed_scores(cells: DataFrame, forecasts: DataFrame, kpi_rules: DataFrame, weights: DataFrame) -> DataFrame:
    """Element scores of cells (with their slot as ``minId``) against stored forecasts of the same slots."""
    of_slots = forecasts.join(cells.select(F.col("minId").alias("recordTime")).distinct(), "recordTime", "left_semi")
    banded = reband(latest_forecast(of_slots), kpi_rules)
    actual = cap_percentages(valid_readings(cells), kpi_rules).withColumn("recordTime", F.col("minId"))
    joined = forecast_actual_join(cap_percentages(banded, kpi_rules, "forecastValue"), actual)
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    elements = element_scores(weighted_scores(kpi_scores(joined, kpi_rules, now), weights), now)
    return elements.select(*[F.col(f.name).cast(f.dataType) for f in ELEMENT_SCORE])


def score_closed_slots(readings: DataFrame, forecast_path: str, root: str, kpi_rules: DataFrame, weights: DataFrame,
                       step: int = 300, lateness: str = LATENESS):
    """A stream writer that scores the elements of slots as they close, against forecasts stored by then.

    Each batch reads the day partitions of exactly its slots from the forecast table, so forecasts written after the
    start are seen and the table may grow for ever. A batch's scores appear below ``root`` as one folder, at once and
    one time only, however often the batch is repeated; ``rolling_windows`` goes on from there. Start it with a trigger.
    """
    cells = slot_stream(readings, step, lateness).select(slot_time().alias("minId"), *CELL_DIMS, "kpiValue")
    _folder(readings.sparkSession, f"{root}/elements")

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        files, done = _folder(spark, f"{root}/elements"), spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{root}/elements/b{number:012d}")
        if files.exists(done):
            return
        held = batch.persist()
        try:
            days = [str(r.day) for r in held.select(F.to_date("minId").alias("day")).distinct().collect()]
            if not days:
                return
            draft = work_dir(spark, "elements")
            forecasts = open_table(spark, forecast_path, days).drop("dt")
            closed_scores(held, forecasts, kpi_rules, weights).hint("rebalance").write.parquet(draft)
        finally:
            held.unpersist()
        files.rename(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(draft), done)

    return cells.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", f"{root}/state")


def _folder(spark: SparkSession, path: str):
    """The file system of a folder, which is made where it is missing."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(where)
    return files


def rolling_windows(spark: SparkSession, root: str, step: int = 300) -> DataFrame:
    """Streaming windows over the scores that ``score_closed_slots`` delivers: one row per element and closed slot.

    Slots are delivered in order, and the state holds three scores of each element that has reported within three slots.
    """
    _folder(spark, f"{root}/elements")
    scores = spark.readStream.schema(ELEMENT_SCORE).option("recursiveFileLookup", "true").parquet(f"{root}/elements")
    keyed = scores.select(
        *ELEMENT_DIMS, epoch(F.col("minId")).alias("at"), F.col("abnScore").cast("double").alias("abnScore"),
        F.col("minId").cast("timestamp").alias("ts")).withWatermark("ts", seconds(step))
    dims = ", ".join(f"{c} string" for c in ELEMENT_DIMS)
    summed = keyed.groupBy(*ELEMENT_DIMS).transformWithState(
        window_state.RollingSum(step, ELEMENT_DIMS), f"{dims}, at long, abnScore double, windowScore double", "append", "eventTime")
    return summed.select(
        from_epoch(F.col("at")).alias("minId"), *ELEMENT_DIMS, "windowScore", "abnScore", level_of(F.col("abnScore")).alias("abnLevel"),
        *[c.alias(n) for n, c in flags(F.col("windowScore")).items()])


# partitions of the kept tables: by hour for runs of every few minutes, by day for coarse slots
PARTS = {"hour": ("yyyyMMddHH", "%Y%m%d%H"), "day": ("yyyyMMdd", "%Y%m%d")}


def _parts(slots: Iterable[int], by: str) -> set[str]:
    return {dt.datetime.fromtimestamp(s, dt.timezone.utc).strftime(PARTS[by][1]) for s in slots}


def _slot_table(spark: SparkSession, slots: Iterable[int]) -> DataFrame:
    times = [dt.datetime.fromtimestamp(s, dt.timezone.utc).replace(tzinfo=None) for s in sorted(slots)]
    return spark.createDataFrame(pa.table({"minId": pa.array(times, pa.timestamp("us"))}))


def score_with_corrections(readings: DataFrame, forecast_path: str, root: str, kpi_rules: DataFrame, weights: DataFrame,
                           step: int = 300, lateness: int = 1500, by: str = "hour"):
    """A stream writer that scores slots as they close and scores a slot again when a reading comes too late for it.

    A slot closes once a reading ``lateness`` seconds past its end has come in an earlier batch. Below ``root``:
    ``cells``, the largest value of each series and slot, late ones included; ``quarantine``, the late readings as
    they came, a folder for each batch with any; ``elements`` and ``windows``, all kept ``by`` hour or day. Late readings put their
    slots and the two windows after each back to work, so in the end the tables are those of a batch run over all
    readings. What each batch saw as the newest reading is part of the cells' log entry, so a repeated batch closes the
    same slots. Of the tables only these slots' partitions are read; slots, not rows, reach the driver.
    """
    keys = ["minId", "resId", "itemPara", "kpiId"]
    part = F.date_format("minId", PARTS[by][0])

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        held = batch.withColumn("minId", slot_of(F.col("ts").cast("timestamp_ntz"), step)).persist()
        try:
            start = epoch(F.col("minId"))
            low, high = held.agg(F.min(start), F.max(F.unix_seconds("ts"))).first()
            if low is None:
                return
            log = TableLog(spark, f"{root}/cells")
            mark = log.snapshot().marks.get("readings")
            if mark is None:
                before = None
            else:
                before = mark["notes"]["before" if mark["number"] == number else "after"]
            after = high if before is None else max(before, high)
            late_before = -(2**62) if before is None else before - lateness  # slots that end by then were closed
            late = held.where(start + step <= late_before)
            again = {r.at for r in late.select(start.alias("at")).distinct().collect()}
            if again:
                late.drop("minId").write.mode("overwrite").parquet(f"{root}/quarantine/b{number:012d}")
            cells = held.groupBy("minId", *CELL_DIMS).agg(F.max("kpiValue").alias("kpiValue"))
            state, layout = merge_into(cells, f"{root}/cells", keys, part, [F.col("kpiValue")], by,
                                       writer="readings", number=number, notes={"before": before, "after": after})
        finally:
            held.unpersist()
        # the slots whose end the watermark passes with this batch, from the first one there is
        closed = after - lateness
        first = low if before is None else (late_before - step) // step * step + step
        todo = again | set(range(first, closed - step + 1, step))
        if not todo:
            return
        scored = log.read(layout, state, _parts(todo, by)).join(_slot_table(spark, todo), "minId", "left_semi")
        days = {f"{d[:4]}-{d[4:6]}-{d[6:]}" for d in _parts(todo, "day")}
        elements = closed_scores(scored, open_table(spark, forecast_path, days).drop("dt"), kpi_rules, weights)
        state, layout = merge_into(elements, f"{root}/elements", WINDOW_KEY, part, (), by)
        windows = {s + k * step for s in todo for k in range(3) if s + (k + 1) * step <= closed}
        near = TableLog(spark, f"{root}/elements").read(layout, state, _parts((w - k * step for w in windows for k in range(3)), by))
        summed = window_score(near.select(*ELEMENT_SCORE.names), step).join(_slot_table(spark, windows), "minId", "left_semi")
        flagged = summed.withColumns({"abnLevel": level_of(F.col("abnScore")), **flags(F.col("windowScore"))})
        merge_into(flagged, f"{root}/windows", WINDOW_KEY, part, (), by)

    return readings.writeStream.foreachBatch(write).option("checkpointLocation", f"{root}/state")

