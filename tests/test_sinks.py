"""Writers."""

import datetime as dt

from pyspark.sql import functions as F

from bandwatch import schemas
from bandwatch.session import work_dir
from bandwatch.sinks import tables
from bandwatch.sources import readings as src
from tests.helpers import actual, at, cells, forecasts, rows

KEY = schemas.KPI_SCORE_KEY


def test_upsert_replaces_and_repeats(spark):
    path, day = work_dir(spark, "u"), F.to_date("minId")
    first = actual(spark, [("a", "k", 0, 1.0), ("b", "k", 0, 2.0), ("a", "k", 300, 3.0)])
    change = actual(spark, [("a", "k", 0, 9.0)])
    tables.upsert(first, path, KEY, day)
    for _ in range(2):
        out = tables.upsert(change, path, KEY, day)
        assert rows(out, "resId", "kpiValue") == [("a", 3.0), ("a", 9.0), ("b", 2.0)]
    out = tables.upsert(change.limit(0), path, KEY, day)
    assert out.count() == 3


def test_upsert_of_nothing(spark):
    out = tables.upsert(actual(spark, []), work_dir(spark, "u"), KEY, F.to_date("minId"))
    assert out.count() == 0


def test_upsert_order_inside_a_batch(spark):
    batch = actual(spark, [("a", "k", 0, 5.0)]).withColumn("n", F.lit(2)).union(
        actual(spark, [("a", "k", 0, 8.0)]).withColumn("n", F.lit(1))
    )
    out = tables.upsert(batch, work_dir(spark, "u"), KEY, F.to_date("minId"), order=[F.col("n")])
    assert rows(out, "kpiValue") == [(5.0,)]


def test_ports_get_their_own_id(spark):
    one = actual(spark, [("a", "k", 0, 1.0)])
    ports = one.union(one.withColumn("itemPara", F.lit("p1"))).union(one.withColumn("itemPara", F.lit("p2")))
    assert tables.with_record_id(ports, KEY).select("_id").distinct().count() == 3


def test_day_partitions_are_pruned(spark):
    path = work_dir(spark, "days")
    data = forecasts(spark, [("a", "k", s, 1.0) for s in range(0, 288 * 20, 96)])
    stored = tables.append_by_day(data, path, "recordTime")
    day = dt.date(2024, 3, 15)
    scan = src.day_range(stored, day, 7)
    assert scan.select("dt").distinct().count() == 8
    assert "PartitionFilters: [isnotnull(dt" in scan._jdf.queryExecution().executedPlan().toString()
    slot = src.forecast_slot_scan(stored, F.lit(at(96)).cast("timestamp_ntz"))
    text = slot._jdf.queryExecution().executedPlan().toString()
    assert slot.count() == 1 and "PushedFilters: [IsNotNull(recordTime), EqualTo(recordTime" in text
    seen = spark.createDataFrame([("a", at(288 * 18))], "resId string, lastTime timestamp_ntz")
    late = src.days_after(stored, seen, dt.date(2024, 3, 15))
    assert late.select("dt").distinct().count() == 2
    unknown = src.days_after(stored, seen.where("resId = 'b'"), dt.date(2024, 3, 15))
    assert unknown.select("dt").distinct().count() == 6
    assert "PartitionFilters: [isnotnull(dt" in late._jdf.queryExecution().executedPlan().toString()


def test_scan_reads_only_its_columns(spark):
    path = work_dir(spark, "cols")
    actual(spark, [("a", "5gcUpf7560Num", 0, 1.0)]).withColumn("extra", F.lit("x")).drop("resourceType").write.parquet(
        path
    )
    from bandwatch import rules

    scan = src.history_scan(spark.read.parquet(path), rules.resource_rules(spark)).select("resId", "kpiValue")
    text = scan._jdf.queryExecution().executedPlan().toString()
    schema = text[text.index("ReadSchema"):]
    assert "extra" not in schema and "minId" not in schema


def test_audit(spark):
    table, offered = tables.audited_write(actual(spark, [("a", "k", i, 1.0) for i in range(5)]), work_dir(spark, "w"))
    assert offered == table.count() == 5


def test_history_versions(spark):
    root = work_dir(spark, "h")
    one = tables.write_history(cells(spark, [("a", "k", 0, 1.0)]), root, 1)
    two = tables.write_history(one.withColumn("kpiValue", F.col("kpiValue") + 1), root, 2)
    assert rows(one, "kpiValue") == [(1.0,)] and rows(two, "kpiValue") == [(2.0,)]


def test_schema_is_enforced(spark):
    shuffled = actual(spark, [("a", "k", 0, 1.0)]).select(*sorted(schemas.ACTUAL.names))
    shuffled = shuffled.withColumn("kpiValue", F.col("kpiValue").cast("string"))
    assert tables.enforce_schema(shuffled, schemas.ACTUAL).schema == schemas.ACTUAL


def test_work_dir_is_read_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert work_dir(spark, "x").startswith(root) and work_dir(spark, "x") != work_dir(spark, "x")


def test_result_tables(spark):
    from bandwatch import rules
    from bandwatch.plans.scoring import score

    data = [("a", "5gcUpfPduSessSuccRate", s, 90.0 + s) for s in range(4)]
    kpis, window = score(actual(spark, data), forecasts(spark, data), rules.kpi_rules(spark),
                         rules.kpi_weights(spark), dt.datetime(2024, 3, 2))
    for df, write in ((kpis, tables.write_scores), (window, tables.write_windows)):
        path = work_dir(spark, "r")
        for _ in range(2):
            stored = write(df, path)
        assert stored.count() == 4 and set(stored.columns) == {"_id", "hour", *df.columns}


def test_newer_forecast_replaces(spark):
    from bandwatch import rules
    from bandwatch.operators.bands import forecast_bands

    base = forecasts(spark, [("a", "5gcUpf7560Num", 0, 5.0), ("a", "5gcUpf7560Num", 300, 6.0)])
    old = forecast_bands(base.withColumns({"kpiStd": F.lit(0.0), "resourceType": F.lit("UPF")}), rules.kpi_rules(spark))
    new = old.where("forecastValue = 5").withColumns(
        {"forecastValue": F.lit(7.0), "createTime": F.expr("timestampadd(HOUR, 1, createTime)")}
    )
    path = work_dir(spark, "f")
    tables.write_forecasts(old.unionByName(new), path)
    assert rows(tables.write_forecasts(new, path), "forecastValue") == [(6.0,), (7.0,)]


def test_an_older_forecast_does_not_replace(spark):
    from bandwatch import rules
    from bandwatch.operators.bands import forecast_bands

    base = forecasts(spark, [("a", "5gcUpf7560Num", 0, 5.0)])
    old = forecast_bands(base.withColumns({"kpiStd": F.lit(0.0), "resourceType": F.lit("UPF")}), rules.kpi_rules(spark))
    new = old.withColumns({"forecastValue": F.lit(7.0), "createTime": F.expr("timestampadd(HOUR, 5, createTime)")})
    path = work_dir(spark, "f")
    for batch in (new, old, new, old):
        assert rows(tables.write_forecasts(batch, path), "forecastValue") == [(7.0,)]


def test_ports_are_scored_and_stored_apart(spark):
    from bandwatch import rules
    from bandwatch.plans.scoring import score

    data = [("a", "5gcUpfPduSessSuccRate", 0, 20.0)]
    ports = lambda df: df.withColumn("itemPara", F.lit("p1")).unionByName(df.withColumn("itemPara", F.lit("p2")))
    kpis, _ = score(ports(actual(spark, data)), ports(forecasts(spark, [(*data[0][:3], 95.0)])), rules.kpi_rules(spark),
                    rules.kpi_weights(spark), dt.datetime(2024, 3, 2))
    stored = tables.write_scores(kpis, work_dir(spark, "p"))
    assert rows(stored, "itemPara", "abnScore") == [("p1", 100.0), ("p2", 100.0)]
    assert stored.select("_id").distinct().count() == 2


def test_a_run_touches_one_partition_and_leaves_no_copies(spark):
    path = work_dir(spark, "u")
    write = lambda slots, v: tables.upsert(actual(spark, [("a", "k", s, v) for s in slots]), path, KEY, tables.hour("minId"), (), "hour")
    out = write(range(0, 48, 6), 1.0)
    before = dict(rows(out.select("hour", F.input_file_name().alias("f")), "hour", "f"))
    for v in (2.0, 3.0):
        after = dict(rows(write([6], v).select("hour", F.input_file_name().alias("f")), "hour", "f"))
    assert {h for h in before if before[h] != after[h]} == {"2024030100"} and len(before) == 4
    import glob

    assert not glob.glob(f"{spark.conf.get('spark.checkpoint.dir')}/upsert-*")


def test_values_without_a_fraction_keep_their_size(spark):
    from bandwatch.functions.values import decimal2, round2

    df = spark.createDataFrame([(2e17,), (-3e18,), (1e17 + 64,), (1.005,), (-2.5,), (None,)], "v double")
    got = [r.r for r in df.select(round2(F.col("v")).alias("r")).collect()]
    assert got == [2e17, -3e18, 1e17 + 64, 1.0, -2.5, None] or got == [2e17, -3e18, 1e17 + 64, 1.01, -2.5, None]
    assert df.select(decimal2(F.col("v")).cast("double")).first()[0] == 2e17


def test_files_are_chosen_by_what_they_hold(spark):
    from bandwatch.sources.filestats import add_stats, files_with_news, rows_after_by_files

    root = work_dir(spark, "f")
    for day, elements in ((0, "ab"), (1, "ab"), (2, "abc"), (3, "b")):
        table = tables.append_by_day(actual(spark, [(e, "k", 288 * day + s, 1.0) for e in elements for s in (1, 2)]), f"{root}/t", "recordTime")
        stats = add_stats(table, f"{root}/stats")
    assert stats.select("file").distinct().count() == len(table.inputFiles()) == 4
    assert add_stats(table, f"{root}/stats").count() == stats.count()
    seen = spark.createDataFrame([("a", at(288 + 1)), ("b", at(288 * 5)), ("c", at(288 * 2 + 2))], "resId string, lastTime timestamp_ntz")
    got, opened = rows_after_by_files(table, stats, seen)
    assert {(r.resId, r.recordTime) for r in got.collect()} == {("a", at(288 + 2)), ("a", at(288 * 2 + 1)), ("a", at(288 * 2 + 2))} and opened == 2
    assert len(files_with_news(stats, seen.where("resId <> 'c'"))) == 2 and len(files_with_news(stats, seen.where("resId = 'a'"))) == 4
    none, opened = rows_after_by_files(table, stats, seen.withColumn("lastTime", F.lit(at(9999)).cast("timestamp_ntz")))
    assert (none.count(), opened) == (0, 0)
