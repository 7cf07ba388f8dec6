"""Comparison SQL: named parts over the event table, joined as needed."""

from __future__ import annotations

import re

T = "%Y-%m-%d %H:%M:%S"


def text(ts: str) -> str:
    return f"strftime({ts}, '{T}')"


def r2(x: str) -> str:
    return f"floor(({x}) * 100.0 + 0.5) / 100.0"


def r6(x: str) -> str:
    return f"floor(({x}) * 1000000.0 + 0.5) / 1000000.0"


def level(x: str) -> str:
    return (
        f"CASE WHEN {x} IS NULL THEN NULL WHEN {x} >= 0 AND {x} < 40 THEN 1 WHEN {x} >= 40 AND {x} < 60 THEN 2 "
        f"WHEN {x} >= 60 AND {x} < 80 THEN 3 ELSE 4 END"
    )


_WHO = """'ne' || (user_id // 40) AS resId, 'node' || (user_id // 160) AS nodeCode,
    'DEV_5G_' || CASE (user_id // 40) % 2 WHEN 0 THEN 'A' ELSE 'S' END || '_'
      || CASE (user_id // 40) % 3 WHEN 0 THEN 'ER' WHEN 1 THEN 'HW' ELSE 'ZX' END || '_COM' AS deviceSet,
    '-1' AS itemPara, date_trunc('hour', ts) AS recordTime, event_type AS kpiId"""

PARTS = {
    "readings": f"""SELECT event_id, ts, user_id, {_WHO},
    CASE event_type WHEN 'purchase' THEN 100 - value / 4 WHEN 'click' THEN value * 1000 ELSE value END AS kpiValue
    FROM events""",
    "cells": """SELECT resId, nodeCode, deviceSet, itemPara, recordTime, kpiId,
    max(CASE kpiId WHEN 'purchase' THEN greatest(0.0, kpiValue) ELSE kpiValue END) AS kpiValue
    FROM readings GROUP BY ALL""",
    "actual": """SELECT *, CASE split_part(deviceSet, '_', 3) WHEN 'A' THEN 'T0' ELSE 'T1' END AS resourceType,
    recordTime AS minId, split_part(deviceSet, '_', 4) AS vender FROM cells""",
    "clean": """SELECT * FROM actual WHERE kpiValue >= 0 AND kpiValue <> 9223372036854775807::DOUBLE
    AND NOT isnan(kpiValue) AND (kpiId NOT IN ('purchase', 'error') OR kpiValue <= 100)""",
    "lagged": """SELECT *, lag(kpiValue, 1) OVER w AS l1, lag(kpiValue, 2) OVER w AS l2, lag(kpiValue, 3) OVER w AS l3
    FROM cells WINDOW w AS (PARTITION BY resId, kpiId ORDER BY recordTime)""",
    "forecasts": """SELECT resId, itemPara, recordTime, recordTime - INTERVAL 6 HOUR AS createTime, kpiId,
    (l1 + l2 + l3) / 3.0 AS forecastValue, nodeCode, deviceSet FROM lagged WHERE l3 IS NOT NULL""",
    "centers": """SELECT recordTime, kpiId, CASE kpiId
      WHEN 'purchase' THEN coalesce(median(forecastValue) FILTER (forecastValue > 70 AND forecastValue <= 100), 90)
      WHEN 'click' THEN coalesce(median(forecastValue) FILTER (forecastValue > 10000), 50000)
      WHEN 'error' THEN coalesce(median(forecastValue) FILTER (forecastValue < 80), 10)
      WHEN 'signup' THEN coalesce(median(forecastValue) FILTER (forecastValue < 80), 20)
      WHEN 'view' THEN coalesce(median(forecastValue) FILTER (forecastValue < 50), 10) END AS center
    FROM forecasts GROUP BY recordTime, kpiId""",
    "judged": """SELECT f.*, CASE f.kpiId
      WHEN 'purchase' THEN forecastValue < center AND abs(forecastValue - center) / (center + 0.001) > 0.25
      WHEN 'click' THEN forecastValue < center AND abs(forecastValue - center) / (center + 0.0001) > 0.97
      WHEN 'error' THEN forecastValue > center AND abs(forecastValue - center) / (center + 0.001) > 3.3
      WHEN 'signup' THEN forecastValue > center AND abs(forecastValue - center) / (center + 0.0001) > 2
      WHEN 'view' THEN forecastValue > center AND abs(forecastValue - center) / (center + 0.001) > 500000
      END AS abnormal
    FROM forecasts f JOIN centers c ON f.recordTime = c.recordTime AND f.kpiId = c.kpiId""",
    "normals": """SELECT recordTime, kpiId, min(forecastValue) AS mn, max(forecastValue) AS mx
    FROM judged WHERE NOT abnormal GROUP BY recordTime, kpiId""",
    "banded": f"""SELECT j.resId, j.itemPara, j.recordTime, j.createTime, j.kpiId, j.nodeCode, j.deviceSet, j.abnormal,
    {r2("j.forecastValue")} AS forecastValue,
    {r2('''CASE WHEN j.kpiId = 'purchase' THEN CASE WHEN abnormal THEN coalesce(0.9::DOUBLE * mn, 70) ELSE 0.9::DOUBLE * forecastValue END
      WHEN j.kpiId = 'click' THEN CASE WHEN abnormal THEN coalesce(mn, 10000) ELSE 0.7::DOUBLE * forecastValue END
      ELSE 0.0::DOUBLE END''')} AS forecastValueLower,
    {r2('''CASE WHEN j.kpiId = 'purchase' THEN 100.0::DOUBLE
      WHEN j.kpiId = 'click' THEN CASE WHEN abnormal THEN coalesce(mx, 1000000) ELSE 10::DOUBLE * forecastValue END
      WHEN abnormal THEN coalesce(mx, CASE j.kpiId WHEN 'error' THEN 80 WHEN 'signup' THEN 90 ELSE 50 END)
      WHEN 1.5::DOUBLE * forecastValue <= 95 AND 1.5::DOUBLE * forecastValue > 20 THEN 1.5::DOUBLE * forecastValue
      ELSE 95 END''')} AS forecastValueUpper
    FROM judged j LEFT JOIN normals n ON j.recordTime = n.recordTime AND j.kpiId = n.kpiId""",
    "rebanded": """SELECT * FROM banded WHERE forecastValue >= 0
    AND (kpiId NOT IN ('purchase', 'error') OR forecastValue <= 100)""",
    "joined": """SELECT DISTINCT c.minId, f.nodeCode, f.resId, f.itemPara, c.resourceType, c.vender, f.kpiId, c.kpiValue,
    f.forecastValue, f.forecastValueUpper, f.forecastValueLower
    FROM rebanded f JOIN clean c ON f.resId = c.resId AND f.itemPara = c.itemPara AND f.kpiId = c.kpiId
      AND f.recordTime = c.recordTime""",
    "points": f"""SELECT *, CASE WHEN kpiValue IS NULL
        OR ({r2("kpiValue")} >= forecastValueLower AND {r2("kpiValue")} <= forecastValueUpper) THEN 1 ELSE 0 END AS ifRangeFcst,
    CASE WHEN kpiValue IS NULL THEN 0
      WHEN kpiId IN ('purchase', 'click') THEN CASE
        WHEN kpiValue < 0.6::DOUBLE * forecastValueLower THEN 100 WHEN kpiValue < 0.8::DOUBLE * forecastValueLower THEN 75
        WHEN kpiValue < 0.9::DOUBLE * forecastValueLower THEN 55 WHEN kpiValue < forecastValueLower THEN 35 ELSE 0 END
      ELSE CASE
        WHEN kpiValue > 1.4::DOUBLE * forecastValueUpper THEN 100 WHEN kpiValue > 1.2::DOUBLE * forecastValueUpper THEN 75
        WHEN kpiValue > 1.1::DOUBLE * forecastValueUpper THEN 55 WHEN kpiValue > forecastValueUpper THEN 35 ELSE 0 END
    END AS abnScore FROM joined""",
    "weighted": """SELECT DISTINCT minId, nodeCode, resId, itemPara, resourceType, vender, kpiId, abnScore AS kpiAbnScore,
    CASE WHEN resourceType = 'T1' AND kpiId = 'view' THEN NULL ELSE abnScore * 2 END AS tenths FROM points""",
    "elements": f"""SELECT *, CAST(round(CAST(total AS DECIMAL(20, 1)) / 10, 0) AS INTEGER) AS abnScore,
    {level("total / 10.0")} AS abnLevel,
    CASE WHEN total >= 800 THEN {r2("share")} ELSE 0.0 END AS abnRate FROM (
      SELECT minId, nodeCode, resId, resourceType, vender, sum(tenths) AS total,
        100.0::DOUBLE * count(*) FILTER (kpiAbnScore >= 80) / count(*) AS share
      FROM weighted GROUP BY ALL)""",
    "windows": """SELECT *, sum(abnScore) OVER (PARTITION BY nodeCode, resId, resourceType, vender ORDER BY minId
      RANGE BETWEEN INTERVAL 2 HOUR PRECEDING AND CURRENT ROW) AS windowScore FROM elements""",
    "extents": """SELECT resId, itemPara, min(recordTime) AS minTime, max(recordTime) AS maxTime
    FROM cells GROUP BY ALL""",
    "slots": """SELECT resId, itemPara, unnest(generate_series(minTime, maxTime, INTERVAL 1 HOUR)) AS recordTime
    FROM extents""",
    "grid": """SELECT s.resId, s.itemPara, k.kpiId, s.recordTime, c.kpiValue
    FROM slots s JOIN (SELECT DISTINCT resId, itemPara, kpiId FROM cells) k
      ON s.resId = k.resId AND s.itemPara = k.itemPara
    LEFT JOIN cells c ON c.resId = s.resId AND c.itemPara = s.itemPara AND c.kpiId = k.kpiId
      AND c.recordTime = s.recordTime""",
    "imputed": """SELECT resId, itemPara, kpiId, recordTime, kpiValue IS NULL AS imputed,
    coalesce(kpiValue, median(kpiValue) OVER (PARTITION BY resId, itemPara, kpiId)) AS kpiValue FROM grid""",
    "numbered": """SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY resId, itemPara, kpiId) AS n,
    lag(kpiValue) OVER w AS x, kpiValue AS y FROM imputed
    WINDOW w AS (PARTITION BY resId, itemPara, kpiId ORDER BY recordTime)""",
    "blocks": """SELECT resId, itemPara, kpiId, recordTime, x, y, CAST((rn - 2) // 72 AS INTEGER) AS blockId,
    CAST((rn - 2) % 72 AS INTEGER) AS step,
    CASE WHEN (rn - 2) // 72 < floor((n - 1) * 0.7::DOUBLE / 72) THEN 'train' ELSE 'test' END AS split
    FROM numbered WHERE rn > 1 AND floor((n - 1) * 0.3::DOUBLE / 72) > 0
      AND rn - 2 < (floor((n - 1) * 0.7::DOUBLE / 72) + floor((n - 1) * 0.3::DOUBLE / 72)) * 72""",
    "scaled": """SELECT *, CASE WHEN x IS NULL THEN NULL ELSE coalesce((x - x_min) / nullif(x_max - x_min, 0), 0) END AS x_scaled,
    CASE WHEN y IS NULL THEN NULL ELSE coalesce((y - y_min) / nullif(y_max - y_min, 0), 0) END AS y_scaled
    FROM (SELECT *, min(x) FILTER (split = 'train') OVER s AS x_min, max(x) FILTER (split = 'train') OVER s AS x_max,
      min(y) FILTER (split = 'train') OVER s AS y_min, max(y) FILTER (split = 'train') OVER s AS y_max
      FROM blocks WINDOW s AS (PARTITION BY resId, itemPara, kpiId))""",
}


def query(select: str, **extra: str) -> str:
    """The select with the parts it names, directly or through other parts, in front."""
    parts = {**PARTS, **extra}
    needed: set[str] = set()

    def visit(sql: str) -> None:
        for name in parts:
            if name not in needed and re.search(rf"\b{name}\b", sql):
                needed.add(name)
                visit(parts[name])

    visit(select)
    body = ",\n".join(f"{name} AS ({parts[name]})" for name in parts if name in needed)
    return f"WITH {body}\n{select}" if body else select
