"""Rolling histories kept by increments.

A roll appends the new slots as a segment and never opens the slots that stay. The median
that fills gaps comes from a digest of every series, its distinct values in order with
their counts, which takes the values that enter and those that leave the window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bandwatch.functions.times import epoch, shift, step_interval
from bandwatch.plans.scoring import stage
from bandwatch.schemas import ELEMENT, SERIES
from bandwatch.sinks.log import Conflict, Snapshot, TableLog, write_files

WRITER = "roll"
VALUES = "resId string, itemPara string, kpiId string, recordTime timestamp_ntz, kpiValue double, imputed boolean, segment string"
DIGESTS = ("resId string, itemPara string, kpiId string, firstTime timestamp_ntz, lastTime timestamp_ntz, "
           "digest array<struct<value: double, n: bigint>>, bucket string")


def median_of(entries: DataFrame) -> DataFrame:
    """Exact median of each series from (series, value, n) entries with distinct values."""
    in_order = Window.partitionBy(*SERIES).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = entries.select(*SERIES, "value", F.sum("n").over(in_order).alias("_upto"), F.sum("n").over(Window.partitionBy(*SERIES)).alias("_all"))
    lower = F.min(F.when(F.col("_upto") > F.floor((F.col("_all") - 1) / 2), F.col("value")))
    upper = F.min(F.when(F.col("_upto") > F.floor(F.col("_all") / 2), F.col("value")))
    return ranked.groupBy(*SERIES).agg((lower * 0.5 + upper * 0.5).alias("median"))


class RollingStore:
    """A history below one folder, as segments of slots and digests by element, under one log.

    ``buckets`` is fixed by the first roll; digests of buckets without new slots are not touched. A segment goes when
    every element's window has left it, so an element that falls silent keeps the segments of its last window.
    """

    def __init__(self, spark: SparkSession, root: str, buckets: int = 32):
        self.spark, self.log, self.buckets = spark, TableLog(spark, root), buckets

    def _bucket(self, buckets: int) -> Column:
        return F.concat(F.lit("digest-"), F.pmod(F.xxhash64(*ELEMENT), F.lit(buckets)).cast("string"))

    def _read(self, layout: str, state: Snapshot, parts: list[str] | set[str]) -> DataFrame:
        return self.log.read(self.spark.createDataFrame([], layout).schema, state, parts)

    def digests(self, state: Snapshot | None = None) -> DataFrame:
        state = state or self.log.snapshot()
        return self._read(DIGESTS, state, {p for p in state.parts() if p.startswith("digest-")})

    def read(self, state: Snapshot | None = None) -> DataFrame:
        """All slots of the windows: series, recordTime, kpiValue, imputed."""
        state = state or self.log.snapshot()
        rows = self._read(VALUES, state, {p for p in state.parts() if p.startswith("values-")}).drop("segment")
        windows = self.digests(state).select(*ELEMENT, "firstTime").distinct()
        return rows.join(windows, ELEMENT).where(F.col("recordTime") >= F.col("firstTime")).drop("firstTime")

    def leaving(self, state: Snapshot, moved: DataFrame) -> DataFrame:
        """Stored slots that the windows of ``moved`` elements leave, from the segments that overlap these times."""
        gone = moved.where(F.col("newFirst") > F.col("firstTime")).agg(
            F.min(epoch(F.col("firstTime"))), F.max(F.least(epoch(F.col("newFirst")), epoch(F.col("priorLast")) + 1))).first()
        spans = state.marks.get(WRITER, {}).get("notes", {}).get("segments", {})
        opened = [] if gone[0] is None else [p for p, (a, b) in spans.items() if a < gone[1] and b >= gone[0]]
        t = F.col("recordTime")
        rows = self._read(VALUES, state, opened)
        if opened:
            rows = rows.where((epoch(t) >= gone[0]) & (epoch(t) < gone[1]))
        windows = moved.select(*ELEMENT, "firstTime", "newFirst")
        return rows.join(windows, ELEMENT).where((t >= F.col("firstTime")) & (t < F.col("newFirst"))).select(*SERIES, "recordTime", "kpiValue")

    def roll(self, fresh: DataFrame, step: int, number: int | None = None) -> Snapshot:
        """Extend the series of elements with slots after their last one, and keep the length of their windows.

        Results are those of ``series.roll_history`` over the stored history. ``fresh`` holds cells (series, recordTime,
        kpiValue); those up to an element's last slot are not taken. Elements not seen before keep all their slots, a
        series without any value is left out. With ``number`` a roll that is repeated after its commit does nothing.
        """
        fresh = stage(fresh.select(*SERIES, "recordTime", "kpiValue"), "roll-fresh")
        while True:
            state = self.log.snapshot()
            done = state.marks.get(WRITER, {}).get("number", -1)
            if number is not None and done >= number:
                return state
            try:
                return self._roll(state, fresh, step, done + 1 if number is None else number)
            except Conflict:
                continue  # another writer was first: roll over what it left

    def _windows(self, known: DataFrame, fresh: DataFrame, step: int) -> DataFrame:
        """Elements that move: their window before (firstTime, priorLast) and after it (newFirst, newLast)."""
        seen = fresh.groupBy(*ELEMENT).agg(F.min("recordTime").alias("_min"), F.max("recordTime").alias("_max"))
        known = known.select(*ELEMENT, "firstTime", F.col("lastTime").alias("priorLast")).distinct()
        first = F.coalesce("firstTime", "_min")
        steps = F.floor((epoch(F.col("_max")) - epoch(first)) / step).cast("long")
        length = epoch(F.col("priorLast")) - epoch(F.col("firstTime"))
        return (
            seen.join(known, ELEMENT, "left")
            .withColumns({"firstTime": first, "newLast": shift(first, steps * step)})
            .where(F.col("priorLast").isNull() | (F.col("newLast") > F.col("priorLast")))
            .withColumn("newFirst", F.coalesce(shift(F.col("newLast"), -length), F.col("firstTime")))
            .select(*ELEMENT, "firstTime", "priorLast", "newFirst", "newLast")
        )

    def _roll(self, state: Snapshot, fresh: DataFrame, step: int, number: int) -> Snapshot:
        notes = state.marks.get(WRITER, {}).get("notes", {"buckets": self.buckets, "segments": {}, "first": {}})
        bucket, t = self._bucket(notes["buckets"]), F.col("recordTime")
        touched = {r[0] for r in fresh.select(bucket).distinct().collect()}  # at most one for each bucket
        digests = self._read(DIGESTS, state, touched)
        moved = stage(self._windows(digests, fresh, step), "roll-moved")
        taken = fresh.join(moved, ELEMENT).where(
            F.col("kpiValue").isNotNull() & ((epoch(t) - epoch(F.col("firstTime"))) % step == 0)
            & (F.col("priorLast").isNull() | (t > F.col("priorLast"))))
        taken = stage(taken.groupBy(*SERIES, "recordTime").agg(F.max("kpiValue").alias("kpiValue")), "roll-taken")

        mine = digests.join(moved.select(*ELEMENT), ELEMENT, "left_semi")
        before = mine.select(*SERIES, F.explode("digest").alias("_e")).select(*SERIES, "_e.value", "_e.n")
        entering = taken.select(*SERIES, F.col("kpiValue").alias("value"), F.lit(1).cast("long").alias("n"))
        middle = median_of(before.unionByName(entering).groupBy(*SERIES, "value").agg(F.sum("n").alias("n")))
        known = mine.select(*SERIES, F.lit(True).alias("_known"))
        start = F.when(F.col("_known"), F.greatest(shift(F.col("priorLast"), step), F.col("newFirst"))).otherwise(F.col("newFirst"))
        slots = (
            middle.join(known, SERIES, "left").join(moved, ELEMENT)
            .select(*SERIES, "median", F.explode(F.sequence(start, F.col("newLast"), step_interval(step))).alias("recordTime"))
            .join(taken, [*SERIES, "recordTime"], "left")
            .select(*SERIES, "recordTime", F.coalesce("kpiValue", "median").alias("kpiValue"), F.col("kpiValue").isNull().alias("imputed"),
                    F.lit(f"values-{state.version + 1:012d}").alias("segment"))
        )
        values = write_files(self.log, slots, "segment")
        if not values:
            return state
        written = self._read(VALUES, Snapshot(files={f["file"]: f for f in values}), {f["part"] for f in values})

        one = F.lit(1).cast("long")
        after = (
            before.unionByName(written.select(*SERIES, F.col("kpiValue").alias("value"), one.alias("n")))
            .unionByName(self.leaving(state, moved).select(*SERIES, F.col("kpiValue").alias("value"), (-one).alias("n")))
            .groupBy(*SERIES, "value").agg(F.sum("n").alias("n")).where(F.col("n") > 0)
            .groupBy(*SERIES).agg(F.sort_array(F.collect_list(F.struct("value", "n"))).alias("digest"))
            .join(moved.select(*ELEMENT, F.col("newFirst").alias("firstTime"), F.col("newLast").alias("lastTime")), ELEMENT)
        )
        still = digests.join(moved.select(*ELEMENT), ELEMENT, "left_anti").drop("bucket")
        files = write_files(self.log, after.unionByName(still.select(*after.columns)).withColumn("bucket", bucket), "bucket")

        now = self._read(DIGESTS, Snapshot(files={f["file"]: f for f in files}), {f["part"] for f in files})
        first = dict(notes["first"]) | {r[0]: r[1] for r in now.groupBy("bucket").agg(F.min(epoch(F.col("firstTime")))).collect()}
        ends = written.agg(F.min(epoch(t)), F.max(epoch(t))).first()
        spans = dict(notes["segments"]) | {values[0]["part"]: list(ends)}
        oldest = min(first.values())
        left = {p for p, (_, last) in spans.items() if last < oldest}
        add = [f for f in values + files if f["part"] not in left]
        remove = [n for n, f in state.files.items() if f["part"] in touched or f["part"] in left]
        marks = {WRITER: {"number": number, "notes": notes | {"first": first, "segments": {p: s for p, s in spans.items() if p not in left}}}}
        self.log.commit(state.version + 1, add, remove, marks, state)
        out = Snapshot(state.version, dict(state.files), dict(state.marks))
        out.apply({"version": state.version + 1, "whole": False, "add": add, "remove": remove, "marks": marks})
        return out
