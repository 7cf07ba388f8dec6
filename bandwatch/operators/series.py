"""Regular series: gridding, imputation, supervised frames, blocks, scaling.

One exchange by element serves all of them: windows here are partitioned by
element or by series (an element's KPI), which that exchange already satisfies.
Copies are merged before it and readings between slots are removed, so a series
holds at most one row per slot of the time range, however many rows were read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from bandwatch.functions.times import epoch, shift, slot_of, step_interval
from bandwatch.schemas import ELEMENT, SERIES
from bandwatch.session import parallelism

ELEMENTS_PER_TASK = 200


def by_series() -> WindowSpec:
    return Window.partitionBy(*SERIES)


def in_order() -> WindowSpec:
    return by_series().orderBy("recordTime")


def slot_cells(readings: DataFrame, step: int | None = None) -> DataFrame:
    """Largest value per series and time; combines before the shuffle.

    With ``step`` readings count for the slot they fall into, so one late message
    does not move an element's grid; ``moved_readings`` counts those.
    """
    time = F.col("recordTime") if step is None else slot_of(F.col("recordTime"), step)
    return readings.groupBy(*SERIES, time.alias("recordTime")).agg(F.max("kpiValue").alias("kpiValue"))


def moved_readings(readings: DataFrame, step: int) -> DataFrame:
    """Number of readings per element that do not lie on a slot's start; none, no row."""
    return readings.where(F.col("recordTime") != slot_of(F.col("recordTime"), step)).groupBy(*ELEMENT).agg(
        F.count(F.lit(1)).alias("moved"))


def element_partitions(readings: DataFrame, per_task: int = ELEMENTS_PER_TASK) -> int:
    """Partitions for work by element: enough for ``per_task`` elements each, at least one per core."""
    elements = readings.agg(F.approx_count_distinct(F.struct(*ELEMENT))).first()[0]
    return max(parallelism(readings.sparkSession), -(-elements // per_task))


def by_element(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Place all rows of an element together.

    The partition count is fixed: gridding multiplies rows and training costs time
    after this exchange, so coalescing by its bytes would leave cores idle.
    """
    return df.repartition(partitions or parallelism(df.sparkSession), *ELEMENT)


def series_extent(readings: DataFrame) -> DataFrame:
    return readings.groupBy(*ELEMENT).agg(
        F.min("recordTime").alias("minTime"), F.max("recordTime").alias("maxTime")
    )


def duplicate_cells(readings: DataFrame) -> DataFrame:
    """Cells holding more than one reading, which a pivot could not place."""
    return readings.groupBy(*SERIES, "recordTime").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def on_slot(start: Column, step: int) -> Column:
    return (epoch(F.col("recordTime")) - epoch(start)) % step == 0


def regular_grid(cells: DataFrame, step: int, partitions: int | None = None) -> DataFrame:
    """Every slot from an element's first to its last, for each of its KPIs.

    Slots are counted from the element's first reading; readings between slots are
    left out before rows are placed together, so an element has at most one row per
    slot and KPI in its task. Its extent comes from one aggregate, joined by key. Each
    reading brings the empty slots up to the next one, so no join with a generated
    grid is needed.
    """
    kept = cells.join(series_extent(cells), ELEMENT).where(on_slot(F.col("minTime"), step))
    t = F.col("recordTime")
    first = F.coalesce(F.when(F.lag(t).over(in_order()).isNull(), F.col("minTime")), t)
    last = F.coalesce(shift(F.lead(t).over(in_order()), -step), F.col("maxTime"))
    return (
        by_element(kept.select(*SERIES, "recordTime", "kpiValue", "minTime", "maxTime"), partitions)
        .select(*SERIES, "recordTime", "kpiValue", first.alias("_first"), last.alias("_last"))
        .select(*SERIES, "recordTime", "kpiValue",
                F.explode(F.sequence("_first", "_last", step_interval(step))).alias("_slot"))
        .select(*SERIES, F.col("_slot").alias("recordTime"),
                F.when(F.col("_slot") == t, F.col("kpiValue")).alias("kpiValue"))
    )


def drop_empty_series(grid: DataFrame) -> DataFrame:
    """Leave out a KPI that has no value at all for an element."""
    return (
        grid.withColumn("_n", F.count("kpiValue").over(by_series())).where(F.col("_n") > 0).drop("_n")
    )


def impute_median(grid: DataFrame) -> DataFrame:
    """Fill empty slots with the series median."""
    middle = F.median("kpiValue").over(by_series())
    return grid.withColumn("imputed", F.col("kpiValue").isNull()).withColumn(
        "kpiValue", F.coalesce("kpiValue", middle)
    )


def to_supervised(series: DataFrame, n_in: int = 1, n_out: int = 1) -> DataFrame:
    """Past and coming values next to each row; incomplete rows are left out.

    Columns ``lag_n_in .. lag_1`` and ``lead_0 .. lead_(n_out-1)``.
    """
    columns = {f"lag_{i}": F.lag("kpiValue", i).over(in_order()) for i in range(n_in, 0, -1)}
    columns |= {f"lead_{i}": F.lead("kpiValue", i).over(in_order()) for i in range(n_out)}
    return series.select(*SERIES, "recordTime", *[c.alias(name) for name, c in columns.items()]).dropna(
        subset=list(columns)
    )


def sliding_sequences(series: DataFrame, n_in: int, n_out: int) -> DataFrame:
    """Pairs of ``n_in`` values and the ``n_out`` after them, one per starting row."""
    ahead = in_order().rowsBetween(0, n_in + n_out - 1)
    return (
        series.select(*SERIES, "recordTime", F.collect_list("kpiValue").over(ahead).alias("_run"))
        .where(F.size("_run") == n_in + n_out)
        .select(*SERIES, "recordTime",
                F.slice("_run", 1, n_in).alias("seqIn"), F.slice("_run", n_in + 1, n_out).alias("seqOut"))
    )


def train_test_blocks(frame: DataFrame, block: int = 72, train: float = 0.7, test: float = 0.3) -> DataFrame:
    """Consecutive blocks for training, then for testing; the tail is left out.

    An element too short for one test block is left out whole.
    """
    n = F.count(F.lit(1)).over(by_series())
    placed = (
        frame.withColumn("_pos", F.row_number().over(in_order()) - 1)
        .withColumn("_train", F.floor(n * F.lit(train) / F.lit(block)))
        .withColumn("_test", F.floor(n * F.lit(test) / F.lit(block)))
    )
    block_id = F.floor(F.col("_pos") / F.lit(block))
    return (
        placed.where((F.col("_test") > 0) & (F.col("_pos") < (F.col("_train") + F.col("_test")) * block))
        .withColumn("blockId", block_id.cast("int"))
        .withColumn("step", (F.col("_pos") % block).cast("int"))
        .withColumn("split", F.when(F.col("blockId") < F.col("_train"), "train").otherwise("test"))
        .drop("_pos", "_train", "_test")
    )


def chrono_split(series: DataFrame, train: float = 0.7) -> DataFrame:
    """First part of each series for training, the rest for testing."""
    n = F.count(F.lit(1)).over(by_series())
    return series.withColumn(
        "split",
        F.when(F.row_number().over(in_order()) <= F.floor(n * F.lit(train)), "train").otherwise("test"),
    )


def scale01(x: Column, low: Column, high: Column) -> Column:
    """To [0, 1]; a constant feature becomes 0."""
    return F.when(x.isNotNull(), F.coalesce((x - low) / F.nullif(high - low, F.lit(0.0)), F.lit(0.0)))


def unscale01(y: Column, low: Column, high: Column) -> Column:
    return y * F.when(high == low, F.lit(1.0)).otherwise(high - low) + low


def minmax_scale(frame: DataFrame, columns: list[str], fit_on_train: bool = True) -> DataFrame:
    """Scale columns per series, with limits from the training part or from each part itself."""
    limits = {}
    for c in columns:
        if fit_on_train:
            fitted = F.when(F.col("split") == "train", F.col(c))
            part = by_series()
        else:
            fitted = F.col(c)
            part = Window.partitionBy(*SERIES, "split")
        limits[f"{c}_min"] = F.min(fitted).over(part)
        limits[f"{c}_max"] = F.max(fitted).over(part)
    scaled = {f"{c}_scaled": scale01(F.col(c), F.col(f"{c}_min"), F.col(f"{c}_max")) for c in columns}
    return frame.withColumns(limits).withColumns(scaled)


def restore_blocks(blocks: DataFrame, column: str) -> DataFrame:
    """First step of every test block, back in its own unit."""
    return (
        blocks.where((F.col("split") == "test") & (F.col("step") == 0))
        .withColumn(
            f"{column}_restored",
            unscale01(F.col(f"{column}_scaled"), F.col(f"{column}_min"), F.col(f"{column}_max")),
        )
    )


def series_tail(series: DataFrame, n: int = 72) -> DataFrame:
    """Last ``n`` rows of each series."""
    newest = by_series().orderBy(F.desc("recordTime"))
    return series.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= n).drop("_rn")


def future_slots(extent: DataFrame, step: int, horizon: int = 72) -> DataFrame:
    """The ``horizon`` slots after each element's last time, counted from 1."""
    last = F.col("maxTime")
    slots = F.sequence(shift(last, step), shift(last, step * horizon), step_interval(step))
    return extent.select(*ELEMENT, F.posexplode(slots).alias("_i", "recordTime")).select(
        *ELEMENT, (F.col("_i") + 1).alias("stepAhead"), "recordTime"
    )


def first_reading() -> Column:
    return F.min(F.struct("recordTime", "nodeCode", "deviceSet"))


def element_attrs(readings: DataFrame) -> DataFrame:
    """Node and device set of each element's first reading."""
    return readings.groupBy(*ELEMENT).agg(first_reading().alias("_f")).select(
        *ELEMENT, F.col("_f.nodeCode").alias("nodeCode"), F.col("_f.deviceSet").alias("deviceSet")
    )


def element_summary(readings: DataFrame, step: int | None = None) -> DataFrame:
    """Last time, attributes and resource type of each element in one aggregate.

    With ``step`` the last time is that of the last slot, which a grid of the readings ends with.
    """
    last = F.max("recordTime")
    return (
        readings.groupBy(*ELEMENT)
        .agg((last if step is None else slot_of(last, step)).alias("maxTime"), F.min("resourceType").alias("resourceType"),
             first_reading().alias("_f"))
        .select(*ELEMENT, "maxTime", "resourceType", "_f.nodeCode", "_f.deviceSet")
    )


def attributed_cells(readings: DataFrame, step: int) -> DataFrame:
    """``slot_cells`` that also carry what ``element_summary`` takes from their readings, so these are read once."""
    return readings.groupBy(*SERIES, slot_of(F.col("recordTime"), step).alias("recordTime")).agg(
        F.max("kpiValue").alias("kpiValue"), F.min("resourceType").alias("resourceType"), first_reading().alias("_f"))


def cell_elements(cells: DataFrame) -> DataFrame:
    """``element_summary`` from attributed cells."""
    return (
        cells.groupBy(*ELEMENT)
        .agg(F.max("recordTime").alias("maxTime"), F.min("resourceType").alias("resourceType"), F.min("_f").alias("_f"))
        .select(*ELEMENT, "maxTime", "resourceType", "_f.nodeCode", "_f.deviceSet")
    )


def pivot_kpis(cells: DataFrame, kpis: list[str], strict: bool = False) -> DataFrame:
    """One column per named KPI; of several readings of a cell the largest, or with ``strict`` an error."""
    value = F.max("kpiValue")
    if strict:
        value = F.when(F.count("kpiValue") > 1, F.raise_error(F.lit("more than one reading of a cell")).cast("double")).otherwise(value)
    return cells.groupBy(*ELEMENT, "recordTime").pivot("kpiId", kpis).agg(value)


def unpivot_kpis(wide: DataFrame, kpis: list[str], value: str = "kpiValue") -> DataFrame:
    return wide.unpivot([*ELEMENT, "recordTime"], kpis, "kpiId", value)


def roll_history(history: DataFrame, fresh: DataFrame, step: int, partitions: int | None = None) -> DataFrame:
    """Extend each series by its new cells and keep its length.

    The grid spans old and new rows together, so the gap between them is filled
    too; empty slots get the median. An element without history keeps all its
    new slots, one without new rows its history.
    """
    both = history.select(*SERIES, "recordTime", "kpiValue", F.lit(True).alias("_old")).unionByName(
        fresh.select(*SERIES, "recordTime", "kpiValue"), allowMissingColumns=True
    )
    merged = (
        both.groupBy(*SERIES, "recordTime")
        .agg(F.coalesce(F.max(F.when(F.col("_old").isNull(), F.col("kpiValue"))), F.max("kpiValue")).alias("kpiValue"))
    )
    span = epoch(F.max("recordTime")) - epoch(F.min("recordTime"))
    lengths = history.groupBy(*ELEMENT).agg((span / step + 1).alias("_keep"))
    grid = impute_median(regular_grid(merged, step, partitions)).where(F.col("kpiValue").isNotNull())
    newest = by_series().orderBy(F.desc("recordTime"))
    return (
        grid.withColumn("_rn", F.row_number().over(newest))
        .join(lengths, ELEMENT, "left")
        .where(F.col("_keep").isNull() | (F.col("_rn") <= F.col("_keep")))
        .drop("_rn", "_keep")
    )
