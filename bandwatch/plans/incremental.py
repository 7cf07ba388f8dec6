"""Forecast runs over stored tables that follow the changes of the readings."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwatch import schemas
from bandwatch.operators import series as ts
from bandwatch.plans import forecasting as plan
from bandwatch.plans.scoring import stage
from bandwatch.schemas import ELEMENT
from bandwatch.sinks import tables
from bandwatch.sinks.history import HistoryStore
from bandwatch.sinks.log import Snapshot, TableLog
from bandwatch.sources.readings import history_scan

WRITER = "forecast"


def changed_rows(log: TableLog, since: int, state: Snapshot) -> DataFrame | None:
    """Rows of the files that a table has at ``state`` and had not at entry ``since``, None without any.

    Other files are not opened. A rewritten partition brings its old rows along; the
    caller tells them from new ones by the times it knows.
    """
    before = log.snapshot(since).files if since >= 0 else {}
    files = {name: f for name, f in state.files.items() if name not in before}
    if not files:
        return None
    layout = log.spark.read.parquet(f"{log.path}/{next(iter(files))}").schema
    return log.read(layout, Snapshot(files=files))


def forecast_changed(
    spark: SparkSession,
    raw_path: str,
    history_root: str,
    forecast_path: str,
    resource_rules: DataFrame,
    kpi_rules: DataFrame,
    run_time: dt.datetime,
    model_config: Mapping | None = None,
    step: int = 300,
    history_days: int | None = 7,
    at: Callable[[str], None] = lambda name: None,
) -> int:
    """Forecast the elements with slots newer than the last committed run; returns how many there were.

    ``raw_path`` is a log table of readings in downstream names (``tables.upsert``). The
    forecast table's log remembers up to which entry of it a run went and which version
    of the history it left; that entry commits forecasts, place and version at once. A
    run that stops before it is repeated from the last commit, whatever it has written,
    and one that stops after it has nothing left to do. Readings that come late, for
    slots up to an element's last known one, do not change its history. Where the
    history is damaged, the run starts again from all readings in ``history_days``.
    Without readings nothing is written.
    """
    out, raw, store = TableLog(spark, forecast_path), TableLog(spark, raw_path), HistoryStore(spark, history_root)
    mark = out.snapshot().marks.get(WRITER, {"number": -1, "notes": {}})
    since, known = mark["notes"].get("raw", -1), mark["notes"].get("history")
    state = raw.snapshot()
    history = store.read_version(known) if known is not None else None
    rows = changed_rows(raw, since if history is not None else -1, state)
    if state.version == since or rows is None:
        return 0
    if history is None:
        scan = plan.in_days(history_scan(rows, resource_rules), run_time, history_days)
        rolled = plan.with_attributes(plan.prepare_series(scan, step, ts.element_partitions(scan)), scan)
        rest = None
    else:
        fresh = stage(plan.incremental_inputs(rows, history, resource_rules, run_time, history_days), "fresh")
        moved = stage(fresh.select(*ELEMENT).distinct(), "moved")
        old, rest = history.join(moved, ELEMENT, "left_semi"), history.join(moved, ELEMENT, "left_anti")
        same = [*ELEMENT, "recordTime", "nodeCode", "deviceSet", "resourceType"]
        series = ts.roll_history(old, ts.slot_cells(fresh, step), step, ts.element_partitions(moved))
        rolled = plan.with_attributes(series, fresh.select(*same).unionByName(old.select(*same)))
    rolled = stage(rolled, "rolled")
    version = store.write(rolled if rest is None else rolled.unionByName(rest.select(*rolled.columns)), keep=None)
    at("history")
    none = rows.limit(0)
    forecasts = plan.forecast(none, resource_rules, kpi_rules, run_time, model_config, step, rolled, history_days)
    tables.merge_into(
        tables.enforce_schema(forecasts, schemas.FORECAST), forecast_path, schemas.FORECAST_KEY, F.to_date("recordTime"),
        [F.col("createTime")], "dt", writer=WRITER, number=mark["number"] + 1, notes={"raw": state.version, "history": version}, step=at)
    # this version and the one before stay; those that stopped runs left go
    store.retire([v for v in store.versions() if v not in (version, known)])
    return rolled.select(*ELEMENT).distinct().count()
