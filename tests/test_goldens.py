"""Hand-made edge rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from bandwatch import rules, schemas
from bandwatch.functions import times, values
from bandwatch.operators import bands, cleaning, scoring, windows
from bandwatch.plans.scoring import score
from tests.helpers import actual, at, forecasts, rows

RUN = dt.datetime(2024, 3, 2)
RATE, VOLUME, CPU, FAIL = (
    "5gcUpfPduSessSuccRate", "5gcUpf7560Num", "5gcUpfSysAvgLoadCpu", "5gcUpfPduSessModiFailNum"
)


def points(spark, v, low, high, direction):
    df = spark.createDataFrame([(v, low, high, direction)], "v double, lo double, up double, d string")
    return df.select(
        scoring.deviation_score(F.col("v"), F.col("lo"), F.col("up"), F.col("d")),
        scoring.in_range(F.col("v"), F.col("lo"), F.col("up")),
    ).first()


@pytest.mark.parametrize(
    "v,low,expected",
    [(9.5, 10.0, 35), (100.0, 90.0, 0), (60.0, 100.0, 75), (59.99, 100.0, 100), (80.0, 100.0, 55),
     (90.0, 100.0, 35), (100.0, 100.0, 0)],
)
def test_low_side_is_numeric(spark, v, low, expected):
    assert points(spark, v, low, 1e9, "low")[0] == expected


@pytest.mark.parametrize("v,expected", [(100.0, 0), (101.0, 35), (111.0, 55), (121.0, 75), (141.0, 100)])
def test_high_side(spark, v, expected):
    assert points(spark, v, 0.0, 100.0, "high")[0] == expected


def test_missing_actual_and_unscored_kpi(spark):
    assert tuple(points(spark, None, 10.0, 20.0, "low")) == (0, 1)
    assert tuple(points(spark, 500.0, 10.0, 20.0, None)) == (0, 0)


def test_invalid_readings_are_dropped(spark):
    df = spark.createDataFrame(
        [(1.0,), (0.0,), (float(2**63 - 1),), (-1.0,), (math.nan,), (None,)], "kpiValue double"
    )
    assert rows(cleaning.valid_readings(df), "kpiValue") == [(0.0,), (1.0,)]


def test_percent_cap_only_for_rates(spark):
    df = actual(spark, [("a", RATE, 0, 100.5), ("a", RATE, 1, 100.0), ("a", VOLUME, 0, 100.5)])
    kept = rows(cleaning.cap_percentages(df, rules.kpi_rules(spark)), "kpiId", "kpiValue")
    assert kept == [(VOLUME, 100.5), (RATE, 100.0)]


def band(spark, kpi, forecast_values, **kw):
    df = forecasts(spark, [(f"e{i}", kpi, 0, f) for i, f in enumerate(forecast_values)])
    out = bands.reband(df, rules.kpi_rules(spark), **kw)
    return {
        r.forecastValue: (r.forecastValueLower, r.forecastValueUpper, r.abnormal)
        for r in out.collect()
    }


def test_rebanding(spark):
    # no typical rate: centre 90, all abnormal, fallback bounds
    assert band(spark, RATE, [50.0, 50.0]) == {50.0: (70.0, 100.0, True)}
    assert band(spark, RATE, [90.0, 95.0, 60.0]) == {
        90.0: (81.0, 100.0, False), 95.0: (85.5, 100.0, False), 60.0: (81.0, 100.0, True),
    }
    assert band(spark, VOLUME, [1.0, 50000.0, 60000.0]) == {
        1.0: (50000.0, 60000.0, True), 50000.0: (35000.0, 500000.0, False), 60000.0: (42000.0, 600000.0, False),
    }
    # centre 0: a relative distance of 6e5
    out = band(spark, FAIL, [0.0, 0.0, 0.0, 600.0])
    assert out[600.0] == (0.0, 0.0, True) and out[0.0] == (0.0, 95.0, False)


def test_stepped_load_limit(spark):
    out = band(spark, CPU, [10.0, 20.0, 63.0, 64.0])
    assert [out[f][1] for f in (10.0, 20.0, 63.0, 64.0)] == [95.0, 30.0, 94.5, 95.0]


def test_port_kpis_have_no_band(spark):
    assert band(spark, "Dcswitchportincomingerrorpackets", [5.0]) == {}


def test_forecast_bands_and_limits(spark):
    df = forecasts(spark, [("a", RATE, 0, 120.0), ("a", CPU, 0, 50.0), ("a", FAIL, 0, -4.0), ("a", VOLUME, 0, -2.0),
                           ("a", "Dcswitchportincomingerrorpackets", 0, 1.0)])
    out = {r.kpiId: r for r in bands.forecast_bands(df, rules.kpi_rules(spark)).collect()}
    assert len(out) == 4
    got = {k: (r.forecastValue, r.forecastValueUpper, r.forecastValueLower) for k, r in out.items()}
    assert got[RATE] == (100.0, 100.0, 0.0)
    assert got[CPU] == (50.0, pytest.approx(60.5), 0.0)
    assert got[FAIL] == (0.0, pytest.approx(7.5), 0.0)
    assert got[VOLUME] == (0.0, 10200.0, 0.0)


def test_clamp_keeps_null_and_nan(spark):
    df = spark.createDataFrame([(None,), (math.nan,), (101.0,), (-1.0,)], "x double")
    out = [r[0] for r in df.select(values.clamp(F.col("x"), 0, 100)).collect()]
    assert out[0] is None and math.isnan(out[1]) and out[2:] == [100.0, 0.0]


def test_newest_forecast_wins(spark):
    base = forecasts(spark, [("a", RATE, 0, 80.0)])
    newer = base.withColumn("createTime", times.shift(F.col("createTime"), 60)).withColumn(
        "forecastValue", F.lit(70.0)
    )
    tied = base.withColumn("forecastValue", F.lit(75.0))
    assert rows(cleaning.latest_forecast(base.union(newer)), "forecastValue") == [(70.0,)]
    assert rows(cleaning.latest_forecast(base.union(tied)), "forecastValue") == [(75.0,)]


def test_elements_without_weights(spark):
    acts = actual(spark, [("sw", "Dcswitchcpuusage", 0, 99.0)], kind="SWITCH")
    fcs = forecasts(spark, [("sw", "Dcswitchcpuusage", 0, 10.0)])
    kpis, window = score(acts, fcs, rules.kpi_rules(spark), rules.kpi_weights(spark), RUN)
    row = window.first()
    assert row.abnScore is None and row.abnLevel is None and row.windowScore is None
    assert (row.isWindowAlarm, row.isWindowAbn, row.abnRate) == (0, 0, 0.0)
    elements = scoring.element_scores(scoring.weighted_scores(kpis, rules.kpi_weights(spark)), RUN)
    assert elements.first().unweighted
    # scored once enabled
    kpis, _ = score(acts, fcs, rules.kpi_rules(spark, enable=rules.UNSCORED), rules.kpi_weights(spark), RUN)
    assert kpis.first().abnScore == 35


def element(spark, scores):
    return spark.createDataFrame(
        [(at(s), "n", "e", "UPF", "HW", v) for s, v in scores],
        "minId timestamp_ntz, nodeCode string, resId string, resourceType string, vender string, abnScore int",
    )


def test_window_of_three_slots(spark):
    df = windows.window_score(element(spark, [(0, 40), (1, 40), (2, 40), (5, 7)]))
    df = df.withColumns(windows.flags(F.col("windowScore"))).orderBy("minId")
    got = [(r.windowScore, r.isWindowAlarm, r.isWindowAbn) for r in df.collect()]
    assert got == [(40, 0, 0), (80, 0, 0), (120, 1, 0), (7, 0, 0)]
    joined = windows.element_window_join(element(spark, [(0, 40), (1, 40), (2, 40), (5, 7)])).orderBy("minId")
    assert [r.windowScore for r in joined.collect()] == [40, 80, 120, 7]


def test_null_dimension_matches_in_the_window_only(spark):
    df = element(spark, [(0, 60), (1, 60)]).withColumn("vender", F.lit(None).cast("string"))
    assert [r.windowScore for r in windows.window_score(df).orderBy("minId").collect()] == [60, 120]
    assert [r.windowScore for r in windows.element_window_join(df).collect()] == [None, None]


def test_full_score(spark):
    """Two KPIs of one element, one far below its band."""
    acts = actual(spark, [("a", RATE, 0, 20.0), ("a", CPU, 0, 10.0), ("b", RATE, 0, 95.0)])
    fcs = forecasts(spark, [("a", RATE, 0, 95.0), ("a", CPU, 0, 12.0), ("b", RATE, 0, 96.0)])
    kpis, window = score(acts, fcs, rules.kpi_rules(spark), rules.kpi_weights(spark), RUN)
    assert kpis.schema.names == schemas.KPI_SCORE.names
    assert window.schema.names == schemas.ELEMENT_WINDOW.names
    got = {(r.resId, r.kpiId): (r.abnScore, r.abnLevel, r.ifRangeFcst) for r in kpis.collect()}
    assert got == {("a", RATE): (100, 4, 0), ("a", CPU): (0, 1, 1), ("b", RATE): (0, 1, 1)}
    # 100 / 18 rounded
    assert {r.resId: r.abnScore for r in window.collect()} == {"a": 6, "b": 0}


def test_history_tail(spark):
    def history(stamps):
        return spark.createDataFrame(
            [("e", i, s) for i, s in enumerate(stamps)], "resId string, position long, recordTime string"
        )

    good = "2024-01-01 00:00:00"
    assert cleaning.repair_tail(history([good, good, "x", "y"])).count() == 2
    assert cleaning.repair_tail(history([good, "x", good, "y"])).count() == 3
    assert cleaning.repair_tail(history(["x", "y"])).count() == 0


def test_strict_numbers_raise(spark):
    df = spark.createDataFrame([("1.5",), ("n/a",)], "t string")
    assert rows(cleaning.to_number(df, "t", "x"), "x", "rejected") == [(1.5, False), (None, True)]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        cleaning.to_number(df, "t", "x", strict=True).collect()


def test_rule_tables(spark):
    assert {k: len(v) for k, v in rules.CLASSES.items()} == {
        "MAX_BEST": 21, "MIN_BEST": 2, "SCALE_DECR": 22, "SCALE_INCR": 4
    }
    weights = rules.kpi_weights(spark).collect()
    assert len(weights) == 48
    assert {str(w.abnScoreWeight) for w in weights} == {
        "0.0666666666666667", "0.1000000000000000", "0.0555555555555556", "0.2000000000000000"
    }
    sides = {r.kpiId: r.direction for r in rules.kpi_rules(spark).collect()}
    assert list(sides.values()).count("low") == 43 and list(sides.values()).count("high") == 5


def test_time_helpers(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 31, 10, 7, 30),)], "ts timestamp_ntz")
    ts = F.col("ts")
    slots = df.select(*times.scoring_slots(ts).values()).first()
    assert list(slots) == [dt.datetime(2024, 3, 31, 9, m) for m in (40, 35, 30)]
    anchors = df.select(*[c.alias(n) for n, c in times.calendar_anchors(ts).items()]).first()
    assert anchors.lastMonth == dt.datetime(2024, 2, 29, 10, 7, 30)
    assert anchors.last2Month == dt.datetime(2024, 1, 31, 10, 7, 30)
    assert df.select(times.format_time(ts, 6)).first()[0] == "2024-03-31T10:07:30.000Z"


def test_record_id(spark):
    import hashlib

    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    got = df.select(values.record_id(F.col("x"), F.col("y"), F.col("z"))).first()[0]
    assert got == hashlib.md5(b"a--3").hexdigest()


def test_all_active_elements_without_k(spark):
    from bandwatch.operators import registry

    data = [(f"e{i}", RATE, 0, 1.0) for i in range(1600)]
    got = registry.active_elements(actual(spark, data), dt.datetime(2024, 3, 1, 1))
    assert got.count() == 1600
    assert registry.active_elements(actual(spark, data), dt.datetime(2024, 3, 1, 1), k=5).count() == 5
