"""Time-series preparation queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from bandwatch import fixtures as fx
from bandwatch.catalog.base import register, rounded
from bandwatch.catalog.scans import cells, event_rows
from bandwatch.catalog.sql import query, r6, text
from bandwatch.operators import series as ts
from bandwatch.plans.forecasting import model_blocks, prepare_series, with_std
from bandwatch.session import work_dir
from bandwatch.sinks.rolling import RollingStore
from bandwatch.sinks.tables import write_history

KEY = "resId, itemPara, kpiId"


def prepared(spark, sf):
    return prepare_series(cells(spark, sf), fx.STEP)


def blocks(spark, sf):
    return model_blocks(prepared(spark, sf), 72)


@register("regular_grid", query(f"SELECT {KEY}, {text('recordTime')} AS recordTime, kpiValue FROM grid"))
def regular_grid(spark, sf):
    return ts.regular_grid(cells(spark, sf), fx.STEP)


@register("duplicate_cell_check", query(f"""SELECT {KEY}, {text('recordTime')} AS recordTime, count(*) AS n
    FROM readings GROUP BY resId, itemPara, kpiId, recordTime HAVING count(*) > 1"""))
def duplicate_cell_check(spark, sf):
    return ts.duplicate_cells(event_rows(spark, sf))


@register("drop_all_null_kpi", query(f"""SELECT {KEY}, {text('recordTime')} AS recordTime, kpiValue FROM cells
    WHERE NOT (split_part(deviceSet, '_', 3) = 'S' AND kpiId = 'view')"""))
def drop_all_null_kpi(spark, sf):
    """The views of T1 lose all their values."""
    t1 = F.split_part("deviceSet", F.lit("_"), F.lit(3)) == "S"
    gone = F.when(~(t1 & (F.col("kpiId") == "view")), F.col("kpiValue"))
    rows = cells(spark, sf).select("resId", "itemPara", "kpiId", "recordTime", gone.alias("kpiValue"))
    return ts.drop_empty_series(rows)


@register("impute_median", query(f"""SELECT {KEY}, {text('recordTime')} AS recordTime, {r6('kpiValue')} AS kpiValue,
    imputed FROM imputed"""))
def impute_median(spark, sf):
    return rounded(prepared(spark, sf), "kpiValue")


@register("kpi_pivot", query(f"""SELECT resId, itemPara, {text('recordTime')} AS recordTime,
    max(kpiValue) FILTER (kpiId = 'click') AS click, max(kpiValue) FILTER (kpiId = 'error') AS error,
    max(kpiValue) FILTER (kpiId = 'purchase') AS purchase, max(kpiValue) FILTER (kpiId = 'signup') AS signup,
    max(kpiValue) FILTER (kpiId = 'view') AS "view" FROM cells GROUP BY resId, itemPara, recordTime"""))
def kpi_pivot(spark, sf):
    return ts.pivot_kpis(cells(spark, sf), fx.KPIS)


@register("kpi_unpivot", query(f"""SELECT s.resId, s.itemPara, {text('s.recordTime')} AS recordTime, k.kpiId, c.kpiValue
    FROM (SELECT DISTINCT resId, itemPara, recordTime FROM cells) s
    CROSS JOIN (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')) k(kpiId)
    LEFT JOIN cells c ON c.resId = s.resId AND c.itemPara = s.itemPara AND c.recordTime = s.recordTime
      AND c.kpiId = k.kpiId"""))
def kpi_unpivot(spark, sf):
    """Back to long form, empty cells included."""
    return ts.unpivot_kpis(ts.pivot_kpis(cells(spark, sf), fx.KPIS), fx.KPIS)


@register("series_to_supervised", query(f"""SELECT {KEY}, {text('recordTime')} AS recordTime, lag_2, lag_1, lead_0, lead_1
    FROM (SELECT *, lag(kpiValue, 2) OVER w AS lag_2, lag(kpiValue) OVER w AS lag_1, kpiValue AS lead_0,
      lead(kpiValue) OVER w AS lead_1 FROM grid WINDOW w AS (PARTITION BY resId, itemPara, kpiId ORDER BY recordTime))
    WHERE lag_2 IS NOT NULL AND lag_1 IS NOT NULL AND lead_0 IS NOT NULL AND lead_1 IS NOT NULL"""))
def series_to_supervised(spark, sf):
    return ts.to_supervised(ts.regular_grid(cells(spark, sf), fx.STEP), 2, 2)


@register("sliding_sequences", query(f"""SELECT {KEY}, {text('recordTime')} AS recordTime,
    kpiValue AS in_1, b AS in_2, c AS in_3, d AS out_1, e AS out_2 FROM (
      SELECT *, lead(kpiValue, 1) OVER w AS b, lead(kpiValue, 2) OVER w AS c, lead(kpiValue, 3) OVER w AS d,
        lead(kpiValue, 4) OVER w AS e FROM cells
      WINDOW w AS (PARTITION BY resId, itemPara, kpiId ORDER BY recordTime)) WHERE e IS NOT NULL"""))
def sliding_sequences(spark, sf):
    pairs = ts.sliding_sequences(cells(spark, sf), 3, 2)
    return pairs.select(
        "resId", "itemPara", "kpiId", "recordTime",
        *[F.get("seqIn", F.lit(i)).alias(f"in_{i + 1}") for i in range(3)],
        *[F.get("seqOut", F.lit(i)).alias(f"out_{i + 1}") for i in range(2)],
    )


@register("train_test_blocks", query(f"""SELECT {KEY}, {text('recordTime')} AS recordTime, {r6('x')} AS x, {r6('y')} AS y,
    "blockId", step, split FROM blocks"""))
def train_test_blocks(spark, sf):
    frame = ts.to_supervised(prepared(spark, sf)).withColumnsRenamed({"lag_1": "x", "lead_0": "y"})
    return rounded(ts.train_test_blocks(frame), "x", "y")


@register("chrono_split", query(f"""SELECT {KEY}, {text('recordTime')} AS recordTime, kpiValue,
    CASE WHEN rn <= floor(n * 0.7::DOUBLE) THEN 'train' ELSE 'test' END AS split FROM (
      SELECT *, row_number() OVER (PARTITION BY resId, itemPara, kpiId ORDER BY recordTime) AS rn,
        count(*) OVER (PARTITION BY resId, itemPara, kpiId) AS n FROM cells)"""))
def chrono_split(spark, sf):
    rows = cells(spark, sf).select("resId", "itemPara", "kpiId", "recordTime", "kpiValue")
    return ts.chrono_split(rows)


@register("minmax_scale", query(f"""SELECT {KEY}, {text('recordTime')} AS recordTime, split,
    {r6('x_scaled')} AS x_scaled, {r6('y_scaled')} AS y_scaled FROM scaled"""))
def minmax_scale(spark, sf):
    out = blocks(spark, sf).select("resId", "itemPara", "kpiId", "recordTime", "split", "x_scaled", "y_scaled")
    return rounded(out, "x_scaled", "y_scaled")


@register("minmax_inverse", query(f"SELECT {KEY}, {text('recordTime')} AS recordTime, {r6('y')} AS y FROM scaled"))
def minmax_inverse(spark, sf):
    """Scaled and back again."""
    back = ts.unscale01(F.col("y_scaled"), F.col("y_min"), F.col("y_max"))
    return rounded(blocks(spark, sf).select("resId", "itemPara", "kpiId", "recordTime", back.alias("y")), "y")


@register("block_restore", query(f"""SELECT {KEY}, {text('recordTime')} AS recordTime, "blockId", {r6('y')} AS y_restored
    FROM scaled WHERE split = 'test' AND step = 0"""))
def block_restore(spark, sf):
    out = ts.restore_blocks(blocks(spark, sf), "y")
    return rounded(out.select("resId", "itemPara", "kpiId", "recordTime", "blockId", "y_restored"), "y_restored")


@register("future_horizon", query(f"""SELECT resId, itemPara, CAST(i AS INTEGER) AS stepAhead,
    {text('maxTime + i * INTERVAL 1 HOUR')} AS recordTime
    FROM (SELECT *, unnest(generate_series(1, 72)) AS i FROM extents)"""))
def future_horizon(spark, sf):
    return ts.future_slots(ts.series_extent(cells(spark, sf)), fx.STEP)


@register("series_tail", query(f"""SELECT {KEY}, {text('recordTime')} AS recordTime, kpiValue FROM (
      SELECT *, row_number() OVER (PARTITION BY resId, itemPara, kpiId ORDER BY recordTime DESC) AS rn FROM cells)
    WHERE rn <= 72"""))
def series_tail(spark, sf):
    return ts.series_tail(cells(spark, sf).select("resId", "itemPara", "kpiId", "recordTime", "kpiValue"))


@register("forecast_std", query(f"""SELECT {KEY}, {text('recordTime')} AS recordTime, forecastValue,
    {r6('stddev_samp(forecastValue) OVER (PARTITION BY resId, itemPara, kpiId)')} AS kpiStd FROM forecasts"""))
def forecast_std(spark, sf):
    out = with_std(fx.forecast(spark, sf))
    return rounded(out.select("resId", "itemPara", "kpiId", "recordTime", "forecastValue", "kpiStd"), "kpiStd")


@register("history_concat", query(f"""SELECT resId, itemPara, {text('recordTime')} AS recordTime,
    max(kpiValue) FILTER (kpiId = 'click') AS click,
    max(kpiValue) FILTER (kpiId = 'error' AND recordTime < TIMESTAMP '2024-01-15') AS error,
    max(kpiValue) FILTER (kpiId = 'view' AND recordTime >= TIMESTAMP '2024-01-15') AS "view"
    FROM cells GROUP BY resId, itemPara, recordTime"""))
def history_concat(spark, sf):
    """Old rows know click and error, new ones click and view."""
    rows = cells(spark, sf)
    new = F.col("recordTime") >= F.lit(dt.datetime(2024, 1, 15)).cast("timestamp_ntz")
    old = ts.pivot_kpis(rows.where(~new), ["click", "error"])
    return old.unionByName(ts.pivot_kpis(rows.where(new), ["click", "view"]), allowMissingColumns=True)


_HISTORY = """SELECT s.resId, s.itemPara, k.kpiId, s.recordTime, c.kpiValue FROM (
      SELECT resId, itemPara, unnest(generate_series(min(recordTime), max(recordTime), INTERVAL 1 HOUR)) AS recordTime
      FROM cells WHERE recordTime < TIMESTAMP '2024-01-15' GROUP BY resId, itemPara) s
    JOIN (SELECT DISTINCT resId, itemPara, kpiId FROM cells WHERE recordTime < TIMESTAMP '2024-01-15') k
      ON s.resId = k.resId AND s.itemPara = k.itemPara
    LEFT JOIN cells c ON c.resId = s.resId AND c.itemPara = s.itemPara AND c.kpiId = k.kpiId
      AND c.recordTime = s.recordTime"""
_OLD = """SELECT resId, itemPara, kpiId, recordTime,
    coalesce(kpiValue, median(kpiValue) OVER (PARTITION BY resId, itemPara, kpiId)) AS kpiValue FROM history"""
_BOTH = """SELECT * FROM old_cells UNION ALL SELECT resId, itemPara, kpiId, recordTime, kpiValue FROM cells
    WHERE recordTime >= TIMESTAMP '2024-01-15'"""


@register("rolling_history", query(f"""SELECT {KEY}, {text('recordTime')} AS recordTime, {r6('kpiValue')} AS kpiValue,
    imputed FROM (
      SELECT g.*, row_number() OVER (PARTITION BY g.resId, g.itemPara, g.kpiId ORDER BY recordTime DESC) AS rn, keep
      FROM (SELECT s.resId, s.itemPara, k.kpiId, s.recordTime, b.kpiValue IS NULL AS imputed,
          coalesce(b.kpiValue, median(b.kpiValue) OVER (PARTITION BY s.resId, s.itemPara, k.kpiId)) AS kpiValue
        FROM slots s JOIN (SELECT DISTINCT resId, itemPara, kpiId FROM both_cells) k
          ON s.resId = k.resId AND s.itemPara = k.itemPara
        LEFT JOIN both_cells b ON b.resId = s.resId AND b.itemPara = s.itemPara AND b.kpiId = k.kpiId
          AND b.recordTime = s.recordTime) g
      LEFT JOIN (SELECT resId, itemPara, count(DISTINCT recordTime) AS keep FROM old_cells GROUP BY ALL) l
        ON g.resId = l.resId AND g.itemPara = l.itemPara)
    WHERE keep IS NULL OR rn <= keep""", history=_HISTORY, old_cells=_OLD, both_cells=_BOTH))
def rolling_history(spark, sf):
    """Two weeks of history, stored, then rolled forward by the rest of the month and stored again."""
    rows = cells(spark, sf)
    cut = F.lit(dt.datetime(2024, 1, 15)).cast("timestamp_ntz")
    root = work_dir(spark, "history")
    old = write_history(prepare_series(rows.where(F.col("recordTime") < cut), fx.STEP), root, 1)
    rolled = ts.roll_history(old, ts.slot_cells(rows.where(F.col("recordTime") >= cut)), fx.STEP)
    return rounded(write_history(rolled, root, 2), "kpiValue")


_CUTS = (15, 20, 26)


def _times(first: int | None, end: int | None) -> str:
    return " AND ".join(["true", *([f"recordTime >= TIMESTAMP '2024-01-{first}'"] if first else []), *([f"recordTime < TIMESTAMP '2024-01-{end}'"] if end else [])])


def _rolls() -> dict[str, str]:
    """Every roll from the whole history before it: union, extent, grid, median over all of it, then the newest slots."""
    out = {"rolled_0": f"""SELECT * EXCLUDE (last) FROM (SELECT s.resId, s.itemPara, k.kpiId, s.recordTime, c.kpiValue IS NULL AS imputed,
          coalesce(c.kpiValue, median(c.kpiValue) OVER (PARTITION BY s.resId, s.itemPara, k.kpiId)) AS kpiValue, 0 AS last
        FROM (SELECT resId, itemPara, unnest(generate_series(min(recordTime), max(recordTime), INTERVAL 1 HOUR)) AS recordTime
          FROM cells WHERE {_times(None, _CUTS[0])} GROUP BY resId, itemPara) s
        JOIN (SELECT DISTINCT resId, itemPara, kpiId FROM cells WHERE {_times(None, _CUTS[0])}) k ON s.resId = k.resId AND s.itemPara = k.itemPara
        LEFT JOIN cells c ON c.resId = s.resId AND c.itemPara = s.itemPara AND c.kpiId = k.kpiId AND c.recordTime = s.recordTime)"""}
    for i, first in enumerate(_CUTS, 1):
        end = _CUTS[i] if i < len(_CUTS) else None
        out[f"both_{i}"] = f"""SELECT resId, itemPara, kpiId, recordTime, kpiValue, imputed FROM rolled_{i - 1}
            UNION ALL SELECT resId, itemPara, kpiId, recordTime, kpiValue, false FROM cells WHERE {_times(first, end)}"""
        out[f"rolled_{i}"] = f"""SELECT g.resId, g.itemPara, g.kpiId, g.recordTime, g.imputed, g.kpiValue FROM (
              SELECT s.resId, s.itemPara, k.kpiId, s.recordTime, coalesce(b.imputed, true) AS imputed,
                coalesce(b.kpiValue, median(b.kpiValue) OVER (PARTITION BY s.resId, s.itemPara, k.kpiId)) AS kpiValue,
                row_number() OVER (PARTITION BY s.resId, s.itemPara, k.kpiId ORDER BY s.recordTime DESC) AS back
              FROM (SELECT resId, itemPara, unnest(generate_series(min(recordTime), max(recordTime), INTERVAL 1 HOUR)) AS recordTime
                FROM both_{i} GROUP BY resId, itemPara) s
              JOIN (SELECT DISTINCT resId, itemPara, kpiId FROM both_{i}) k ON s.resId = k.resId AND s.itemPara = k.itemPara
              LEFT JOIN both_{i} b ON b.resId = s.resId AND b.itemPara = s.itemPara AND b.kpiId = k.kpiId AND b.recordTime = s.recordTime) g
            LEFT JOIN (SELECT resId, itemPara, count(DISTINCT recordTime) AS keep FROM rolled_{i - 1} GROUP BY ALL) l
              ON g.resId = l.resId AND g.itemPara = l.itemPara WHERE keep IS NULL OR back <= keep"""
    return out


@register("rolling_history_increments", query(f"""SELECT {KEY}, {text('recordTime')} AS recordTime, {r6('kpiValue')} AS kpiValue, imputed
    FROM rolled_{len(_CUTS)}""", **_rolls()))
def rolling_history_increments(spark, sf):
    """Two weeks of history, then three rolls that append new slots and take medians from stored digests."""
    rows = cells(spark, sf)
    store = RollingStore(spark, work_dir(spark, "rolling"), 8)
    day = [F.lit(dt.datetime(2024, 1, d)).cast("timestamp_ntz") for d in _CUTS]
    t = F.col("recordTime")
    store.roll(ts.slot_cells(rows.where(t < day[0])), fx.STEP)
    for i, first in enumerate(day):
        state = store.roll(ts.slot_cells(rows.where((t >= first) & (t < day[i + 1] if i + 1 < len(day) else F.lit(True)))), fx.STEP)
    return rounded(store.read(state), "kpiValue")
