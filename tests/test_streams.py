"""Streams equal their batch twins on closed slots."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from bandwatch import rules
from bandwatch.catalog import streams
from bandwatch.operators.cleaning import latest_forecast
from bandwatch.operators.bands import reband
from bandwatch.plans.scoring import score
from bandwatch.session import work_dir
from bandwatch.sinks.log import TableLog
from bandwatch.sinks.tables import open_table
from bandwatch.streaming import jobs
from tests.helpers import actual, forecasts, rows

RUN = dt.datetime(2024, 3, 2)
KPI = "5gcUpfPduSessSuccRate"


def source(spark, folder):
    layout = spark.read.parquet(folder).schema
    return spark.readStream.schema(layout).parquet(folder)


def test_window_stream_equals_batch(spark):
    grid = [(f"e{i}", k, s, float(20 + (i * 37 + s * 11) % 80)) for i in range(5)
            for k in (KPI, "5gcUpfSysAvgLoadCpu") for s in range(20)]
    grid = [g for g in grid if (g[0], g[2]) != ("e1", 9)]
    acts = actual(spark, [(r, k, s, v * (0.5 if s % 3 else 1.0)) for r, k, s, v in grid])
    fcs = forecasts(spark, grid)
    kpi_rules, weights = rules.kpi_rules(spark), rules.kpi_weights(spark)
    _, window = score(acts, fcs, kpi_rules, weights, RUN)
    # readings inside their slots, plus one that moves the watermark past all of them
    root = work_dir(spark, "s")
    inside = acts.withColumn("ts", F.expr("timestampadd(SECOND, 30, recordTime)").cast("timestamp"))
    inside.unionByName(
        inside.limit(1).withColumn("ts", F.expr("timestampadd(HOUR, 5, ts)")).withColumn("resId", F.lit("later"))
    ).write.parquet(f"{root}/in")
    banded = reband(latest_forecast(fcs), kpi_rules)
    stream = jobs.score_stream(source(spark, f"{root}/in"), banded, kpi_rules, weights)
    table, _ = jobs.drain(spark, stream, f"{root}/out", f"{root}/state")
    columns = ["minId", "resId", "windowScore", "abnScore", "abnLevel", "isWindowAlarm", "isWindowAbn"]
    want = window.withColumn("windowScore", F.col("windowScore").cast("long"))
    assert rows(table, *columns) == rows(want, *columns)
    assert table.count() == 99


def test_dedup_stream(spark):
    root = work_dir(spark, "d")
    acts = actual(spark, [("a", KPI, s // 3, 1.0) for s in range(30)])
    acts.withColumn("ts", F.col("recordTime").cast("timestamp")).write.parquet(f"{root}/in")
    table, _ = jobs.drain(spark, jobs.dedup_stream(source(spark, f"{root}/in")), f"{root}/out", f"{root}/state")
    assert table.count() == 10


def test_repeated_batches_leave_one_row_per_key(spark):
    root = work_dir(spark, "k")
    write = jobs.upsert_batches(f"{root}/t", ["minId", "resId", "kpiId"], lambda df: F.to_date("minId"))
    batch = actual(spark, [("a", KPI, 0, 1.0), ("b", KPI, 0, 2.0)])
    for number in (0, 0, 1):
        write(batch, number)
    assert open_table(spark, f"{root}/t").count() == 2


def test_late_readings_are_set_aside_and_scored(spark):
    """Three arrivals: two slots' worth, a reading hours later, then one for the closed first slots."""
    root = work_dir(spark, "l")
    kpi_rules, weights = rules.kpi_rules(spark), rules.kpi_weights(spark)
    grid = [(r, KPI, s, 95.0) for r in ("a", "b") for s in range(8)]
    stored = forecasts(spark, [*grid, ("a", KPI, 60, 95.0)]).withColumn("dt", F.to_date("recordTime"))
    stored.write.partitionBy("dt").parquet(f"{root}/forecast")
    arrivals = [[("a", KPI, s, 40.0) for s in range(6)] + [("b", KPI, 3, 90.0)], [("a", KPI, 60, 95.0)], [("b", KPI, 2, 20.0), ("b", KPI, 3, 30.0)]]
    for rows_ in arrivals:
        actual(spark, rows_).withColumn("ts", F.col("recordTime").cast("timestamp")).write.mode("append").parquet(f"{root}/in")
        job = jobs.score_with_corrections(source(spark, f"{root}/in"), f"{root}/forecast", root, kpi_rules, weights)
        job.trigger(availableNow=True).start().awaitTermination()
    late = spark.read.option("recursiveFileLookup", "true").parquet(f"{root}/quarantine")
    assert rows(late, "resId", "kpiValue") == [("b", 20.0), ("b", 30.0)]
    best = actual(spark, [r for a in arrivals for r in a if r[2] < 60 and r != ("b", KPI, 3, 30.0)])
    _, window = score(best, forecasts(spark, grid), kpi_rules, weights, RUN)
    columns = ["minId", "resId", "windowScore", "abnScore", "isWindowAlarm"]
    got = open_table(spark, f"{root}/windows")
    assert rows(got, *columns) == rows(window.withColumn("windowScore", F.col("windowScore").cast("long")), *columns)


def test_window_state_gives_one_row_per_slot_and_forgets(spark):
    root = work_dir(spark, "w")
    layout = jobs.ELEMENT_SCORE

    def deliver(number, rows_):
        acts = actual(spark, [(r, KPI, s, v) for r, s, v in rows_])
        acts.select("minId", "nodeCode", "resId", "resourceType", "vender", F.col("kpiValue").alias("abnScore")).select(
            *[F.col(f.name).cast(f.dataType) for f in layout]).write.parquet(f"{root}/elements/b{number}")

    def go():
        job = jobs.rolling_windows(spark, root).writeStream.format("parquet").option("path", f"{root}/out").option(
            "checkpointLocation", f"{root}/state").trigger(availableNow=True).start()
        job.awaitTermination()
        return job.recentProgress

    deliver(0, [("a", s, 40.0) for s in range(4)] + [("b", 0, 10.0), ("b", 3, 10.0), ("c", 0, None)])
    go()
    deliver(1, [("a", 4, 50.0), ("a", 3, 99.0), ("d", 100, 1.0)])
    go()
    deliver(2, [("d", 101, 1.0)])
    held = [p.stateOperators[0].numRowsTotal for p in go() if p.stateOperators]
    out = {(r.resId, r.minId): r.windowScore for r in spark.read.parquet(f"{root}/out").collect()}
    sums = [v for (r, _), v in sorted(out.items(), key=lambda x: x[0][1]) if r == "a"]
    assert sums == [40.0, 80.0, 120.0, 120.0, 130.0]
    assert sorted(v for (r, _), v in out.items() if r == "b") == [10.0, 10.0] and [v for (r, _), v in out.items() if r == "c"] == [None]
    assert len(out) == 10 and held[-1] <= 4  # only the element that still reports, and its timer


def test_bands_are_not_broadcast(spark):
    """Few bands would fit, but many in a small file would look the same to a stream's plan."""
    acts = actual(spark, [("a", KPI, s, 50.0) for s in range(3)]).withColumn("ts", F.col("recordTime").cast("timestamp"))
    banded = reband(latest_forecast(forecasts(spark, [("a", KPI, s, 95.0) for s in range(3)])), rules.kpi_rules(spark))
    stored = work_dir(spark, "bands")
    banded.write.parquet(stored)
    scored = jobs.element_stream(jobs.slot_stream(acts), spark.read.parquet(stored), rules.kpi_rules(spark), rules.kpi_weights(spark))
    assert scored.count() == 3
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin [resId" in plan and "BroadcastHashJoin [resId" not in plan


def test_upserts_of_a_stateful_stream_write_a_file_a_day(spark, monkeypatch, tmp_path):
    """The batch is kept for its two deliveries, and its files do not multiply with shuffle partitions."""
    seen, roots = [], []
    real = jobs.upsert_batches

    def watched(path, *more):
        write = real(path, *more)
        roots.append(path)

        def run(batch, number):
            seen.append((number, batch.storageLevel.useDisk))
            write(batch, number)
            assert batch.sparkSession.conf.get("spark.sql.adaptive.enabled") == "false"

        return run

    monkeypatch.setattr(streams.jobs, "upsert_batches", watched)
    ids = range(400)
    pq.write_table(pa.table({
        "event_id": ids, "ts": pa.array([dt.datetime(2024, 1, 1) + dt.timedelta(hours=i % 72) for i in ids], pa.timestamp("us")),
        "user_id": [40 * i for i in ids], "event_type": ["view"] * 400, "value": [float(i) for i in ids], "props": [""] * 400}),
        tmp_path / "events.parquet")
    table = streams.stream_keyed_upsert(spark, str(tmp_path))
    assert table.count() == table.select("_id").distinct().count() == sum(i % 72 < 70 for i in range(400))
    files = [f["part"] for f in TableLog(spark, roots[0]).snapshot().files.values()]
    assert sorted(files) == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert len(seen) >= 2 and all(kept for _, kept in seen) and len(seen) == 2 * len({n for n, _ in seen})
