"""KPI classes, band rules, resource types and weights as small tables.

All of them are ordinary DataFrames built from local data, so Spark knows their
size and broadcasts them only while they fit its threshold.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from bandwatch import schemas

# ---------------------------------------------------------------- fixed values
# Names, lists and thresholds that results depend on.

KPI_SETS = {
    "AMF": [
        "5gcAmfMaxRegStatusUserNum", "5gcAmfNotUserReasonAuthSuccRate", "5gcAmfAttSucRateWithOutUser",
        "5gcAmfFinReqSuccRate", "5gcAmfPageReqNum", "5gcAmfN2SerReqSccRate", "5gcAmfSwit5gTo4gSuccRate",
        "5gcAmfSwit4gTo5gSuccRate", "5gcAmfNet4gTo5gReqSuccRate", "5gcAmfNet5gTo4gSuccRate",
        "5gcAmfXnInterSwitSuccRate1", "5gcAmfN2InterSwitSuccRate1", "5gcAmfInterSwitInSuccRate1",
        "5gcAmfInterSwitOutSuccRate1", "5gcAmfAvgSysLoad",
    ],
    "SMF": [
        "5gcSmfAvgPduSessNum", "5gcSmfMaxPduSessNum", "5gcSmf4GAvgPduSessNum", "5gcSmf4GMaxPduSessNum",
        "5gcSmf45GAvgPduSessNum", "5gcSmf45GMaxPduSessNum", "5gcSmfIMSEstSucRate", "5gcSmfSessBuiSuccRate",
        "5gcSmfFallbackSuccRate", "5gcSmfAvgSystemLoad",
    ],
    "UPF": [
        "5gcUpfPduSessSuccRate", "5gcUpfPduSessModiFailNum", "5gcUpfUsrCurrOnlSessNum",
        "5gcUpfN3SaveGtp13MessThou", "5gcUpfN3ReceGtpMaxKbMessRate", "5gcUpfN3SendGtpMessThou",
        "5gcUpfN3SendGtpMaxKbMessRate", "5gcUpfN6SendGtp13MessThou", "5gcUpfN6RecUsrPeakMaxKBRate",
        "5gcUpfN6SendGtp14MessThou", "5gcUpfN6SendUsrPeakMaxKBRate", "5gcUpfN9RecUsrPeakMaxKBRate",
        "5gcUpfN9SendUsrPeakMaxKBRate", "5gcUpf7560Num", "5gcUpfShaXinZhuFaSucceRate",
        "5gcUpfXiaXinZhuFaSucceRate", "5gcUpfSysAvgLoadCpu", "5gcUpfSysAvgLoadMe",
    ],
    "UDM": [
        "5gcUdmSubUserNum", "5gcUdm3gppActiUserNum", "5gcUdmAmfSuccMessRate", "5gcUdmSmfSuccMessRate",
        "5gcUdmSignSuccMessRate",
    ],
    "SWITCH": ["Dcswitchcpuusage"],
    "INTERFACE": [
        "Dcswitchportincomingdiscardpackets", "Dcswitchportincomingerrorpackets",
        "Dcswitchportoutgoingdiscardpackets", "Dcswitchportoutgoingerrorpackets",
    ],
}

DEVICE_SETS = {
    "AMF": ["DEV_5G_A_ER_COM", "DEV_5G_A_HW_COM", "DEV_5G_A_ZX_COM"],
    "SMF": ["DEV_5G_S_ER_COM", "DEV_5G_S_HW_COM", "DEV_5G_S_ZX_COM"],
    "UPF": ["DEV_5G_U_ER_COM", "DEV_5G_U_HW_COM", "DEV_5G_U_ZX_COM", "DEV_5G_U_YJY_COM"],
    "UDM": ["DEV_5G_H_HW_COM", "DEV_5G_H_ER_COM", "DEV_5G_H_ZX_COM"],
    "SWITCH": [
        "DEV_DC_T_HW_COM", "DEV_DC_T_ZX_COM", "DEV_DC_T_H3_COM",
        "DEV_DC_E_HW_COM", "DEV_DC_E_ZX_COM", "DEV_DC_E_H3_COM",
    ],
    "INTERFACE": [
        "DEV_DC_T_HW_COM", "DEV_DC_T_ZX_COM", "DEV_DC_T_H3_COM",
        "DEV_DC_E_HW_COM", "DEV_DC_E_ZX_COM", "DEV_DC_E_H3_COM",
    ],
}

# loads, failure counts and switch load; volumes; rates
MIN_BEST = ["5gcUpfSysAvgLoadCpu", "5gcUpfSysAvgLoadMe"]
SCALE_INCR = ["5gcSmfAvgSystemLoad", "5gcAmfAvgSysLoad", "5gcUpfPduSessModiFailNum", "Dcswitchcpuusage"]
SCALE_DECR = [
    "5gcAmfMaxRegStatusUserNum", "5gcAmfPageReqNum", "5gcSmfAvgPduSessNum", "5gcSmfMaxPduSessNum",
    "5gcSmf4GAvgPduSessNum", "5gcSmf4GMaxPduSessNum", "5gcSmf45GAvgPduSessNum", "5gcSmf45GMaxPduSessNum",
    "5gcUpfUsrCurrOnlSessNum", "5gcUpfN3SaveGtp13MessThou", "5gcUpfN3ReceGtpMaxKbMessRate",
    "5gcUpfN3SendGtpMessThou", "5gcUpfN3SendGtpMaxKbMessRate", "5gcUpfN6SendGtp13MessThou",
    "5gcUpfN6RecUsrPeakMaxKBRate", "5gcUpfN6SendGtp14MessThou", "5gcUpfN6SendUsrPeakMaxKBRate",
    "5gcUpfN9RecUsrPeakMaxKBRate", "5gcUpfN9SendUsrPeakMaxKBRate", "5gcUpf7560Num", "5gcUdmSubUserNum",
    "5gcUdm3gppActiUserNum",
]
# port KPIs belong to no class
MAX_BEST = [
    "5gcAmfNotUserReasonAuthSuccRate", "5gcAmfAttSucRateWithOutUser", "5gcAmfFinReqSuccRate",
    "5gcAmfN2SerReqSccRate", "5gcAmfSwit5gTo4gSuccRate", "5gcAmfSwit4gTo5gSuccRate",
    "5gcAmfNet4gTo5gReqSuccRate", "5gcAmfNet5gTo4gSuccRate", "5gcAmfXnInterSwitSuccRate1",
    "5gcAmfN2InterSwitSuccRate1", "5gcAmfInterSwitInSuccRate1", "5gcAmfInterSwitOutSuccRate1",
    "5gcSmfIMSEstSucRate", "5gcSmfSessBuiSuccRate", "5gcSmfFallbackSuccRate", "5gcUpfPduSessSuccRate",
    "5gcUpfShaXinZhuFaSucceRate", "5gcUpfXiaXinZhuFaSucceRate", "5gcUdmAmfSuccMessRate",
    "5gcUdmSmfSuccMessRate", "5gcUdmSignSuccMessRate",
]
CLASSES = {"MAX_BEST": MAX_BEST, "MIN_BEST": MIN_BEST, "SCALE_DECR": SCALE_DECR, "SCALE_INCR": SCALE_INCR}

# band rule of a class, and of single KPIs where it differs
CLASS_RULE = {"MAX_BEST": "RATE", "SCALE_DECR": "VOLUME", "SCALE_INCR": "LOAD"}
KPI_RULE = {"5gcUpfSysAvgLoadCpu": "CPU", "5gcUpfSysAvgLoadMe": "MEM", "5gcUpfPduSessModiFailNum": "FAIL"}

# side on which a deviation counts; the switch load is banded but not scored
CLASS_DIRECTION = {"MAX_BEST": "low", "SCALE_DECR": "low", "MIN_BEST": "high", "SCALE_INCR": "high"}
UNSCORED = ["Dcswitchcpuusage"]

# Centre: median of forecasts with medGt < f <= medLe and f < medLt, else medDefault.
# A forecast on the wrong side of it by more than thr (relative, eps against zero) is abnormal.
# Normal band: lowerFactor*f and, by upperKind, upperValue | upperValue*f | a stepped load limit.
# Abnormal band: abnLowerFactor*min and max of the normal forecasts, or the fallbacks.
BAND_RULES = {
    "RATE": dict(
        medGt=70.0, medLe=100.0, medLt=None, medDefault=90.0, eps=0.001, side="below", thr=0.25,
        lowerFactor=0.9, upperKind="const", upperValue=100.0,
        abnLowerFactor=0.9, abnLowerDefault=70.0, abnUpperKind="const", abnUpperDefault=100.0,
    ),
    "VOLUME": dict(
        medGt=10000.0, medLe=None, medLt=None, medDefault=50000.0, eps=0.0001, side="below", thr=0.97,
        lowerFactor=0.7, upperKind="factor", upperValue=10.0,
        abnLowerFactor=1.0, abnLowerDefault=10000.0, abnUpperKind="max", abnUpperDefault=1000000.0,
    ),
    "CPU": dict(
        medGt=None, medLe=None, medLt=80.0, medDefault=10.0, eps=0.001, side="above", thr=3.3,
        lowerFactor=0.0, upperKind="stepped", upperValue=None,
        abnLowerFactor=0.0, abnLowerDefault=0.0, abnUpperKind="max", abnUpperDefault=80.0,
    ),
    "MEM": dict(
        medGt=None, medLe=None, medLt=80.0, medDefault=20.0, eps=0.001, side="above", thr=1.4,
        lowerFactor=0.0, upperKind="stepped", upperValue=None,
        abnLowerFactor=0.0, abnLowerDefault=0.0, abnUpperKind="max", abnUpperDefault=80.0,
    ),
    "LOAD": dict(
        medGt=None, medLe=None, medLt=80.0, medDefault=20.0, eps=0.0001, side="above", thr=2.0,
        lowerFactor=0.0, upperKind="stepped", upperValue=None,
        abnLowerFactor=0.0, abnLowerDefault=0.0, abnUpperKind="max", abnUpperDefault=90.0,
    ),
    "FAIL": dict(
        medGt=None, medLe=None, medLt=50.0, medDefault=10.0, eps=0.001, side="above", thr=5e5,
        lowerFactor=0.0, upperKind="stepped", upperValue=None,
        abnLowerFactor=0.0, abnLowerDefault=0.0, abnUpperKind="max", abnUpperDefault=50.0,
    ),
}

# (share of the bound, points), first match wins
LOW_TIERS = [(0.6, 100), (0.8, 75), (0.9, 55), (1.0, 35)]
HIGH_TIERS = [(1.4, 100), (1.2, 75), (1.1, 55), (1.0, 35)]

ALARM_SCORE = 100
ABNORMAL_SCORE = 200

# share of each KPI in its resource type's score
WEIGHTS = {
    "AMF": {
        "5gcAmfMaxRegStatusUserNum": "0.0666666666666667",
        "5gcAmfNotUserReasonAuthSuccRate": "0.0666666666666667",
        "5gcAmfAttSucRateWithOutUser": "0.0666666666666667",
        "5gcAmfFinReqSuccRate": "0.0666666666666667",
        "5gcAmfPageReqNum": "0.0666666666666667",
        "5gcAmfN2SerReqSccRate": "0.0666666666666667",
        "5gcAmfSwit5gTo4gSuccRate": "0.0666666666666667",
        "5gcAmfSwit4gTo5gSuccRate": "0.0666666666666667",
        "5gcAmfNet4gTo5gReqSuccRate": "0.0666666666666667",
        "5gcAmfNet5gTo4gSuccRate": "0.0666666666666667",
        "5gcAmfXnInterSwitSuccRate1": "0.0666666666666667",
        "5gcAmfN2InterSwitSuccRate1": "0.0666666666666667",
        "5gcAmfInterSwitInSuccRate1": "0.0666666666666667",
        "5gcAmfInterSwitOutSuccRate1": "0.0666666666666667",
        "5gcAmfAvgSysLoad": "0.0666666666666667",
    },
    "SMF": {
        "5gcSmfAvgPduSessNum": "0.1000000000000000",
        "5gcSmfMaxPduSessNum": "0.1000000000000000",
        "5gcSmf4GAvgPduSessNum": "0.1000000000000000",
        "5gcSmf4GMaxPduSessNum": "0.1000000000000000",
        "5gcSmf45GAvgPduSessNum": "0.1000000000000000",
        "5gcSmf45GMaxPduSessNum": "0.1000000000000000",
        "5gcSmfIMSEstSucRate": "0.1000000000000000",
        "5gcSmfSessBuiSuccRate": "0.1000000000000000",
        "5gcSmfFallbackSuccRate": "0.1000000000000000",
        "5gcSmfAvgSystemLoad": "0.1000000000000000",
    },
    "UPF": {
        "5gcUpfPduSessSuccRate": "0.0555555555555556",
        "5gcUpfPduSessModiFailNum": "0.0555555555555556",
        "5gcUpfUsrCurrOnlSessNum": "0.0555555555555556",
        "5gcUpfN3SaveGtp13MessThou": "0.0555555555555556",
        "5gcUpfN3ReceGtpMaxKbMessRate": "0.0555555555555556",
        "5gcUpfN3SendGtpMessThou": "0.0555555555555556",
        "5gcUpfN3SendGtpMaxKbMessRate": "0.0555555555555556",
        "5gcUpfN6SendGtp13MessThou": "0.0555555555555556",
        "5gcUpfN6RecUsrPeakMaxKBRate": "0.0555555555555556",
        "5gcUpfN6SendGtp14MessThou": "0.0555555555555556",
        "5gcUpfN6SendUsrPeakMaxKBRate": "0.0555555555555556",
        "5gcUpfN9RecUsrPeakMaxKBRate": "0.0555555555555556",
        "5gcUpfN9SendUsrPeakMaxKBRate": "0.0555555555555556",
        "5gcUpf7560Num": "0.0555555555555556",
        "5gcUpfShaXinZhuFaSucceRate": "0.0555555555555556",
        "5gcUpfXiaXinZhuFaSucceRate": "0.0555555555555556",
        "5gcUpfSysAvgLoadCpu": "0.0555555555555556",
        "5gcUpfSysAvgLoadMe": "0.0555555555555556",
    },
    "UDM": {
        "5gcUdmSubUserNum": "0.2000000000000000",
        "5gcUdm3gppActiUserNum": "0.2000000000000000",
        "5gcUdmAmfSuccMessRate": "0.2000000000000000",
        "5gcUdmSmfSuccMessRate": "0.2000000000000000",
        "5gcUdmSignSuccMessRate": "0.2000000000000000",
    },
}

# KPIs the weight table marks as rates
RATE_FLAGGED = [
    "5gcAmfNotUserReasonAuthSuccRate", "5gcAmfFinReqSuccRate", "5gcAmfN2SerReqSccRate",
    "5gcAmfSwit5gTo4gSuccRate", "5gcAmfSwit4gTo5gSuccRate", "5gcAmfNet4gTo5gReqSuccRate",
    "5gcAmfNet5gTo4gSuccRate", "5gcAmfXnInterSwitSuccRate1", "5gcAmfN2InterSwitSuccRate1",
    "5gcAmfInterSwitInSuccRate1", "5gcAmfInterSwitOutSuccRate1", "5gcSmfIMSEstSucRate",
    "5gcSmfSessBuiSuccRate", "5gcSmfFallbackSuccRate", "5gcUpfPduSessSuccRate",
    "5gcUpfN3ReceGtpMaxKbMessRate", "5gcUpfN3SendGtpMaxKbMessRate", "5gcUpfN6SendUsrPeakMaxKBRate",
    "5gcUpfN6RecUsrPeakMaxKBRate", "5gcUpfN9RecUsrPeakMaxKBRate", "5gcUpfN9SendUsrPeakMaxKBRate",
    "5gcUpfShaXinZhuFaSucceRate", "5gcUpfXiaXinZhuFaSucceRate", "5gcUdmAmfSuccMessRate",
    "5gcUdmSmfSuccMessRate", "5gcUdmSignSuccMessRate",
]

# recurrent model settings, the same for every resource type
MODEL_DEFAULTS = dict(
    hidden_size=32, num_layers=2, nonlinearity="tanh", bias=True, batch_first=False, bidirectional=False,
    dropout=0.0, learning_rate=0.01, epochs=100, block=72,
)
# ---------------------------------------------------------------- end of fixed values

_TEXT, _NUM, _INT = pa.string(), pa.float64(), pa.int32()

KPI_RULE_FIELDS = {
    "kpiId": _TEXT, "kpiClass": _TEXT, "bandRule": _TEXT, "direction": _TEXT,
    "medGt": _NUM, "medLe": _NUM, "medLt": _NUM, "medDefault": _NUM, "eps": _NUM, "side": _TEXT, "thr": _NUM,
    "lowerFactor": _NUM, "upperKind": _TEXT, "upperValue": _NUM, "abnLowerFactor": _NUM,
    "abnLowerDefault": _NUM, "abnUpperKind": _TEXT, "abnUpperDefault": _NUM,
}


def local_table(spark: SparkSession, rows: Iterable[Mapping], fields: Mapping[str, pa.DataType]) -> DataFrame:
    """A driver-side table of known size (a local relation, not an RDD)."""
    return spark.createDataFrame(pa.Table.from_pylist(list(rows), schema=pa.schema(list(fields.items()))))


def kpi_rule_row(kpi: str, kpi_class: str, band_rule: str | None, direction: str | None) -> dict:
    return dict(
        kpiId=kpi, kpiClass=kpi_class, bandRule=band_rule, direction=direction, **BAND_RULES.get(band_rule, {})
    )


def kpi_rules(spark: SparkSession, enable: Sequence[str] = ()) -> DataFrame:
    """Class, band rule and scored side of every classified KPI.

    ``enable`` names KPIs to score although they are unscored by default.
    """
    rows = [
        kpi_rule_row(
            kpi,
            kpi_class,
            KPI_RULE.get(kpi, CLASS_RULE.get(kpi_class)),
            None if kpi in UNSCORED and kpi not in enable else CLASS_DIRECTION[kpi_class],
        )
        for kpi_class, kpis in CLASSES.items()
        for kpi in kpis
    ]
    return local_table(spark, rows, KPI_RULE_FIELDS)


def resource_rules(
    spark: SparkSession,
    device_sets: Mapping[str, Sequence[str]] = DEVICE_SETS,
    kpi_sets: Mapping[str, Sequence[str]] = KPI_SETS,
) -> DataFrame:
    """Device sets and KPIs of every resource type."""
    rows = [
        dict(resourceType=kind, deviceSets=list(device_sets[kind]), kpiIds=list(kpi_sets[kind]))
        for kind in device_sets
    ]
    fields = {"resourceType": _TEXT, "deviceSets": pa.list_(_TEXT), "kpiIds": pa.list_(_TEXT)}
    return local_table(spark, rows, fields)


def kpi_weights(spark: SparkSession) -> DataFrame:
    """The weight table; switches and ports carry no weights."""
    rows = [
        dict(resourceType=kind, kpiId=kpi, kpiName=None, abnScoreWeight=Decimal(weight), isRateKpi=int(kpi in RATE_FLAGGED))
        for kind, own in WEIGHTS.items()
        for kpi, weight in own.items()
    ]
    fields = {
        "resourceType": _TEXT, "kpiId": _TEXT, "kpiName": _TEXT,
        "abnScoreWeight": pa.decimal128(20, 16), "isRateKpi": _INT,
    }
    return local_table(spark, rows, fields).select(*schemas.WEIGHT.names)
