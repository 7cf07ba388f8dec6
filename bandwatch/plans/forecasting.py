"""Forecast of every element in one job."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bandwatch.functions.times import shift
from bandwatch.models import rnn
from bandwatch.operators import series as ts
from bandwatch.operators.bands import forecast_bands
from bandwatch.plans.scoring import stage
from bandwatch.rules import MODEL_DEFAULTS
from bandwatch.schemas import ELEMENT, FORECAST, SERIES
from bandwatch.sources.readings import day_range, history_scan, rows_after

# the grouped function travels with its module, so executors need no installed copy
cloudpickle.register_pickle_by_value(rnn)


def prepare_series(readings: DataFrame, step: int, partitions: int | None = None) -> DataFrame:
    """Gridded and imputed series; all windows share the exchange by element.

    Readings count for the slot they fall into. A series without any value stays
    empty through imputation and drops out. ``partitions``: see ``element_partitions``.
    """
    return series_of_cells(ts.slot_cells(readings, step), step, partitions)


def series_of_cells(cells: DataFrame, step: int, partitions: int | None = None) -> DataFrame:
    """``prepare_series`` of readings that are in their slots already."""
    return ts.impute_median(ts.regular_grid(cells, step, partitions)).where(F.col("kpiValue").isNotNull())


def model_blocks(series: DataFrame, block: int, fit_on_train: bool = True) -> DataFrame:
    """Scaled input and target of every block step."""
    frame = ts.to_supervised(series, 1, 1).withColumnsRenamed({"lag_1": "x", "lead_0": "y"})
    return ts.minmax_scale(ts.train_test_blocks(frame, block), ["x", "y"], fit_on_train)


def fit_forecast(blocks: DataFrame, config: Mapping) -> DataFrame:
    """Train one model per element; the scaled forecast with its losses.

    The blocks are still placed by element, so training needs no exchange.
    """
    return slim_blocks(blocks).groupBy(*ELEMENT).applyInPandas(rnn.fit_predict(config), rnn.OUTPUT)


def slim_blocks(blocks: DataFrame) -> DataFrame:
    """The columns of ``model_blocks`` that training reads."""
    return blocks.select(
        *SERIES, "blockId", "step", "split",
        F.col("x_scaled").alias("x"), F.col("y_scaled").alias("y"),
        F.col("y_min").alias("yMin"), F.col("y_max").alias("yMax"),
    )


def fit_by_type(blocks: DataFrame, elements: DataFrame, config: Mapping) -> DataFrame:
    """``fit_forecast`` with the settings of each element's resource type, where ``by_type`` has any.

    All types train in one grouped call: the type travels with the blocks and picks its settings there.
    """
    by_type = config.get("by_type") or {}
    common = {k: v for k, v in config.items() if k != "by_type"}
    if not by_type:
        return fit_forecast(blocks, common)
    usual = rnn.fit_predict(common)
    own = {kind: rnn.fit_predict({**common, **settings}) for kind, settings in by_type.items()}

    def run(pdf):
        return own.get(pdf["resourceType"].iat[0], usual)(pdf)

    typed = slim_blocks(blocks).join(elements.select(*ELEMENT, "resourceType"), ELEMENT)
    return typed.groupBy(*ELEMENT).applyInPandas(run, rnn.OUTPUT)


def holdout_metrics(fitted: DataFrame) -> DataFrame:
    """Losses per element."""
    return (
        fitted.where(F.col("stepAhead") == 1)
        .groupBy(*ELEMENT)
        .agg(*[F.max(c).alias(c) for c in ("trainLossFirst", "trainLossLast", "testLoss")],
             F.count(F.lit(1)).alias("kpis"))
    )


def with_std(forecast: DataFrame) -> DataFrame:
    """Sample deviation of each series over the forecast horizon."""
    return forecast.withColumn("kpiStd", F.stddev_samp("forecastValue").over(Window.partitionBy(*SERIES)))


def assemble(values: DataFrame, elements: DataFrame, kpi_rules: DataFrame, step: int,
             run_time: dt.datetime) -> DataFrame:
    """Forecast table from ``stepAhead`` values: times, deviation, element attributes, bands.

    ``elements`` is an ``element_summary`` whose ``maxTime`` is each element's last slot.
    """
    timed = (
        with_std(values)
        .join(elements, ELEMENT)
        .withColumn("recordTime", shift(F.col("maxTime"), F.col("stepAhead") * step))
    )
    return forecast_bands(
        timed.withColumn("createTime", F.lit(run_time).cast("timestamp_ntz")), kpi_rules
    ).select(*FORECAST.names)


def with_attributes(series: DataFrame, readings: DataFrame) -> DataFrame:
    """A gridded series as a history: with the node, device set and resource type of each element."""
    return series.select(*SERIES, "recordTime", "kpiValue").join(
        ts.element_summary(readings).drop("maxTime"), ELEMENT)


def incremental_inputs(raw: DataFrame, history: DataFrame, resource_rules: DataFrame, run_time: dt.datetime,
                       history_days: int | None = 7) -> DataFrame:
    """Rows newer than an element's history, and all rows in range of elements without one.

    Where ``raw`` is stored by day in ``dt``, the range of days is a partition filter.
    """
    known = history.groupBy(*ELEMENT).agg(F.max("recordTime").alias("lastTime"))
    return rows_after(in_days(history_scan(raw, resource_rules), run_time, history_days), known)


def in_days(scan: DataFrame, run_time: dt.datetime, back: int | None) -> DataFrame:
    """Rows of the last days up to the run, by their time and, where stored, by their day partition."""
    if back is None:
        return scan
    first = dt.datetime.combine(run_time.date() - dt.timedelta(days=back), dt.time())
    end = dt.datetime.combine(run_time.date() + dt.timedelta(days=1), dt.time())
    kept = scan.where((F.col("recordTime") >= F.lit(first).cast("timestamp_ntz")) & (F.col("recordTime") < F.lit(end).cast("timestamp_ntz")))
    return day_range(kept, run_time.date(), back) if "dt" in scan.columns else kept


def forecast(
    raw: DataFrame,
    resource_rules: DataFrame,
    kpi_rules: DataFrame,
    run_time: dt.datetime,
    model_config: Mapping | None = None,
    step: int = 300,
    history: DataFrame | None = None,
    history_days: int | None = 7,
    fit_on_train: bool = True,
    partitions: int | None = None,
    active: DataFrame | None = None,
) -> DataFrame:
    """Banded forecast of one block of slots for every element.

    ``raw`` holds readings in downstream names, from the last ``history_days`` days
    before the run, or all when it is None. With ``history`` (``with_attributes`` of a
    gridded table) only rows newer than an element's history are added to it; elements
    without new rows are forecast from their history alone, unknown ones from all their
    rows in range. ``active`` (with resId, such as ``active_elements``) limits the run
    to these elements. ``model_config`` may hold settings per resource type under
    ``by_type``. ``partitions`` is derived from the number of elements when not given.

    ``raw`` is read once: its cells with their element's attributes are staged in the
    shared folder, and counts, extents, attributes and series come from there.
    """
    config = {**MODEL_DEFAULTS, **(model_config or {})}
    if active is not None:
        some = active.select("resId").distinct()
        raw = raw.join(some, "resId", "left_semi")
        history = None if history is None else history.join(some, "resId", "left_semi")
    if history is None:
        cells = stage(ts.attributed_cells(in_days(history_scan(raw, resource_rules), run_time, history_days), step), "cells")
        prepared = series_of_cells(cells, step, partitions or ts.element_partitions(cells))
        elements = ts.cell_elements(cells)
    else:
        fresh = incremental_inputs(raw, history, resource_rules, run_time, history_days)
        cells = stage(ts.attributed_cells(fresh, step), "cells")
        # elements without a history are not among its, so both are counted
        both = history.select(*ELEMENT).unionByName(cells.select(*ELEMENT))
        prepared = ts.roll_history(history, cells, step, partitions or ts.element_partitions(both))
        elements = ts.cell_elements(cells.unionByName(ts.attributed_cells(history, step)))
    fitted = fit_by_type(model_blocks(prepared, config["block"], fit_on_train), elements, config)
    values = fitted.select(
        *SERIES, "stepAhead",
        ts.unscale01(F.col("scaledValue"), F.col("yMin"), F.col("yMax")).alias("forecastValue"),
    )
    return assemble(values, elements, kpi_rules, step, run_time)
