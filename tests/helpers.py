"""Small tables for tests."""

import datetime as dt

from bandwatch import schemas

T0 = dt.datetime(2024, 3, 1)


def at(slot: int, step: int = 300) -> dt.datetime:
    return T0 + dt.timedelta(seconds=slot * step)


def cells(spark, rows, item="-1"):
    """(resId, kpiId, slot, value) rows as gridded cells."""
    return spark.createDataFrame(
        [(r, item, k, at(s) if isinstance(s, int) else s, v) for r, k, s, v in rows],
        "resId string, itemPara string, kpiId string, recordTime timestamp_ntz, kpiValue double",
    )


def actual(spark, rows, kind="UPF"):
    """(resId, kpiId, slot, value) rows as cleaned actuals."""
    return spark.createDataFrame(
        [(r, "node", "DEV_5G_U_HW_COM", "-1", at(s), k, v, kind, at(s), "HW") for r, k, s, v in rows], schemas.ACTUAL
    )


def forecasts(spark, rows):
    """(resId, kpiId, slot, forecast) rows as stored forecasts."""
    return spark.createDataFrame(
        [(r, "-1", at(s), T0, k, v, "node", "DEV_5G_U_HW_COM") for r, k, s, v in rows],
        "resId string, itemPara string, recordTime timestamp_ntz, createTime timestamp_ntz, kpiId string, "
        "forecastValue double, nodeCode string, deviceSet string",
    )


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)
