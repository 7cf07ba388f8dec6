"""Table layouts. Times are zone-free; streams convert at their edge."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _N, _I = T.StringType(), T.DoubleType(), T.TimestampNTZType(), T.IntegerType()


def _layout(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


RAW = _layout(RESID=_S, NODECODE=_S, DEVICE_SET=_S, ITEM_PARA=_S, RECORD_TIME=_N, ITEM_CODE=_S, VALUE=_D)

ACTUAL = _layout(
    resId=_S, nodeCode=_S, deviceSet=_S, itemPara=_S, recordTime=_N, kpiId=_S, kpiValue=_D,
    resourceType=_S, minId=_N, vender=_S,
)

FORECAST = _layout(
    resId=_S, itemPara=_S, recordTime=_N, createTime=_N, kpiId=_S, forecastValue=_D,
    forecastValueUpper=_D, forecastValueLower=_D, kpiStd=_D, nodeCode=_S, deviceSet=_S, resourceType=_S,
)

WEIGHT = _layout(
    resourceType=_S, kpiId=_S, kpiName=_S, abnScoreWeight=T.DecimalType(20, 16), isRateKpi=_I,
)

KPI_SCORE = _layout(
    minId=_N, nodeCode=_S, resId=_S, itemPara=_S, resourceType=_S, vender=_S, kpiId=_S, kpiValue=_D, forecastValue=_D,
    forecastValueUpper=_D, forecastValueLower=_D, ifRangeFcst=_I, abnLevel=_I, abnScore=_D, createTime=_N,
)

ELEMENT_WINDOW = _layout(
    minId=_N, nodeCode=_S, resId=_S, resourceType=_S, vender=_S, windowScore=_D, isWindowAbn=_I,
    isWindowAlarm=_I, abnScore=_D, abnLevel=_I, trainingTime=_N, trainingAlgo=_S, abnRate=_D, createTime=_N,
)

# raw names in reading order, and the names used from there on
RAW_TO_ACTUAL = dict(zip(RAW.names, ACTUAL.names))

# columns that identify one row of each output
FORECAST_KEY = ["recordTime", "resId", "itemPara", "kpiId"]
KPI_SCORE_KEY = ["minId", "resId", "kpiId"]
WINDOW_KEY = ["minId", "resId"]

ELEMENT = ["resId", "itemPara"]
SERIES = ["resId", "itemPara", "kpiId"]
ELEMENT_DIMS = ["nodeCode", "resId", "resourceType", "vender"]
