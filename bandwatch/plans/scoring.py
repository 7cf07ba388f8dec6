"""Scoring of all resource types and slots in one plan."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwatch.operators import scoring as sc
from bandwatch.operators.bands import forecast_bins, reband
from bandwatch.operators.cleaning import cap_percentages, latest_forecast, valid_readings
from bandwatch.operators.windows import window_alarm
from bandwatch.session import work_dir
from bandwatch.sources.readings import slot_scan


def clean_actuals(actual: DataFrame, kpi_rules: DataFrame) -> DataFrame:
    return cap_percentages(valid_readings(actual.distinct()), kpi_rules)


def rebanded(forecast: DataFrame, kpi_rules: DataFrame, bins: DataFrame | None = None) -> DataFrame:
    """Bands of the newest forecasts; ``bins`` is their ``forecast_bins`` where it is stored."""
    return cap_percentages(reband(latest_forecast(forecast), kpi_rules, bins), kpi_rules, "forecastValue")


def kpi_score_table(actual: DataFrame, forecast: DataFrame, kpi_rules: DataFrame,
                    run_time: dt.datetime, bins: DataFrame | None = None) -> DataFrame:
    """Every reading with a forecast, scored."""
    joined = sc.forecast_actual_join(rebanded(forecast, kpi_rules, bins), clean_actuals(actual, kpi_rules))
    return sc.kpi_scores(joined, kpi_rules, run_time)


def stage(df: DataFrame, name: str) -> DataFrame:
    """A written copy, which later passes and retries read instead of recomputing."""
    path = work_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def score(
    actual: DataFrame,
    forecast: DataFrame,
    kpi_rules: DataFrame,
    weights: DataFrame,
    run_time: dt.datetime,
    step: int = 300,
    staged: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """KPI result table and element window table.

    ``staged`` (left out only for small tables) writes the newest forecasts and the KPI results to the shared folder
    first: re-banding passes over the forecasts three times, and both results build
    on the KPI table. The sketch of the forecasts is small and staged too.
    """
    bins = None
    if staged:
        forecast = stage(latest_forecast(forecast), "forecasts")
        bins = stage(forecast_bins(forecast, kpi_rules), "bins")
    kpis = kpi_score_table(actual, forecast, kpi_rules, run_time, bins)
    if staged:
        kpis = stage(kpis, "scores")
    elements = sc.element_scores(sc.weighted_scores(kpis, weights), run_time)
    return kpis, window_alarm(elements, run_time, step)


def co_located_scores(actual: DataFrame, banded: DataFrame, kpi_rules: DataFrame, weights: DataFrame,
                      run_time: dt.datetime) -> tuple[DataFrame, DataFrame]:
    """KPI results and element scores of two tables stored by slot and element, without an exchange after the scans.

    ``actual`` holds clean readings, ``banded`` the bands of ``rebanded``, both written by ``sinks.buckets.write_bucketed``.
    """
    kpis = sc.kpi_scores(sc.co_located_join(banded, actual), kpi_rules, run_time)
    return kpis, sc.element_scores(sc.weighted_scores(kpis, weights), run_time)


def slots_of_run(now: dt.datetime, step: int = 300, delay: int = 1500) -> list[dt.datetime]:
    """The slot a run at ``now`` scores, after the two before it."""
    since = int((now - dt.datetime(1970, 1, 1)).total_seconds())
    slot = dt.datetime(1970, 1, 1) + dt.timedelta(seconds=since - since % step - delay)
    return [slot - dt.timedelta(seconds=k * step) for k in (2, 1, 0)]


def of_slots(table: DataFrame, slots: list[dt.datetime], time: str = "recordTime", day: str = "dt") -> DataFrame:
    """Rows of the slots; by their day partitions too, where the table has them."""
    kept = table.where(F.col(time).isin([F.lit(s).cast("timestamp_ntz") for s in slots]))
    if day not in table.columns:
        return kept
    return kept.where(F.col(day).isin([F.lit(d) for d in sorted({s.date() for s in slots})])).drop(day)


def score_slot(
    now: dt.datetime,
    raw: DataFrame,
    forecasts: DataFrame,
    resource_rules: DataFrame,
    kpi_rules: DataFrame,
    weights: DataFrame,
    step: int = 300,
    delay: int = 1500,
) -> tuple[DataFrame, DataFrame]:
    """KPI results and element windows of the slot that a run at ``now`` scores.

    ``raw`` holds readings in downstream names. Only the slot and the two before it,
    which its window sums over, are read from either table, pruned by ``dt`` where
    stored by day.
    """
    slots = slots_of_run(now, step, delay)
    last = F.lit(slots[-1]).cast("timestamp_ntz")
    actual = slot_scan(of_slots(raw, slots), resource_rules)
    kpis, windows = score(actual, of_slots(forecasts, slots), kpi_rules, weights, now, step)
    return kpis.where(F.col("minId") == last), windows.where(F.col("minId") == last)
