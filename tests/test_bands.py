"""Centre and normal range of forecasts against a brute-force computation."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from bandwatch import fixtures as fx
from bandwatch.operators.bands import SLOT_KPI, centre_statistics, forecast_bins
from bandwatch.operators.skew import merge_bins


def drawn(kpi, k, rng):
    """Groups of one KPI: spread, tied, one value, all untypical, about zero with both signs, close to the limit."""
    scale = {"click": 60000.0, "purchase": 90.0}.get(kpi, 15.0)
    return [
        rng.normal(scale, scale / 3, 401), rng.normal(scale, scale * 2, 300), np.full(50, scale), np.repeat([scale, scale / 2], 40),
        np.array([scale]), rng.normal(0, 1e-3, 120), np.array([0.0, -0.0, 5e-324, -1e-300]), np.full(20, -3.0), rng.normal(1e6, 10, 99),
        np.concatenate([np.full(30, scale), scale * (1 - np.array([0.2499999, 0.25, 0.2500001, 0.97])), scale * (1 + np.array([2.0, 3.3, 3.3001]))]),
    ][k]


@pytest.fixture(scope="module")
def drawn_forecasts(spark):
    rng = np.random.default_rng(3)
    rows = [(f"e{i}", dt.datetime(2024, 1, 1, k), kpi, float(v)) for kpi in fx.KPIS for k in range(10) for i, v in enumerate(drawn(kpi, k, rng))]
    rows += [("x", dt.datetime(2024, 1, 1, 0), kpi, v) for kpi in fx.KPIS for v in (None, float("nan"))]
    return pd.DataFrame(rows, columns=["resId", "recordTime", "kpiId", "forecastValue"]), spark.createDataFrame(
        rows, "resId string, recordTime timestamp_ntz, kpiId string, forecastValue double").repartition(5)


def brute(pdf, rules):
    out = {}
    for (t, kpi), g in pdf.dropna().groupby(["recordTime", "kpiId"]):
        r = rules[kpi]
        v = g.forecastValue.to_numpy()
        typical = np.sort(v[(v > (r.medGt if r.medGt is not None else -np.inf)) & (v <= (r.medLe if r.medLe is not None else np.inf))
                            & (v < (r.medLt if r.medLt is not None else np.inf))])
        n = len(typical)
        center = 0.5 * typical[(n - 1) // 2] + 0.5 * typical[n // 2] if n else r.medDefault
        off = np.abs(v - center) / (center + r.eps) > r.thr
        normal = v[~(off & ((v < center) if r.side == "below" else (v > center)))]
        out[t, kpi] = (center, *((normal.min(), normal.max()) if len(normal) else (None, None)))
    return out


def as_dict(df):
    return {(r.recordTime, r.kpiId): (r.center, r._min, r._max) for r in df.collect()}


def test_statistics_are_exact(spark, drawn_forecasts):
    pdf, forecasts = drawn_forecasts
    rules = fx.kpi_rules(spark)
    want = brute(pdf, {r.kpiId: r for r in rules.collect()})
    assert as_dict(centre_statistics(forecasts, rules)) == want
    parts = [forecast_bins(forecasts.where(f"pmod(hash(resId), 2) = {k}"), rules) for k in (0, 1)]
    assert as_dict(centre_statistics(forecasts, rules, merge_bins(*parts, keys=SLOT_KPI))) == want


def test_stored_sketches_leave_one_pass(spark, drawn_forecasts, tmp_path):
    _, forecasts = drawn_forecasts
    rules = fx.kpi_rules(spark)
    forecasts.write.parquet(f"{tmp_path}/forecasts")
    forecast_bins(forecasts, rules).write.parquet(f"{tmp_path}/bins")
    stored = spark.read.parquet(f"{tmp_path}/forecasts")
    plan = centre_statistics(stored, rules, spark.read.parquet(f"{tmp_path}/bins"))._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert sum("forecastValue" in s for s in scans) == 1 and "percentile" not in plan


def test_no_rows(spark, drawn_forecasts):
    _, forecasts = drawn_forecasts
    assert centre_statistics(forecasts.where("false"), fx.kpi_rules(spark)).count() == 0
