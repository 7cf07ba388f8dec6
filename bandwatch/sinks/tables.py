"""Writers: by day, keyed upsert, history versions, and the write audit."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bandwatch import schemas
from bandwatch.functions.values import record_id
from bandwatch.sinks.log import SNAPSHOT, Snapshot, TableLog, replace_parts, write_files


def enforce_schema(df: DataFrame, layout: T.StructType) -> DataFrame:
    """Declared columns in declared order and type; a value that does not fit fails the job."""
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in layout])


def with_record_id(df: DataFrame, key: Sequence[str], item: str | None = "itemPara") -> DataFrame:
    """Add ``_id`` from the key columns, and from the port where the row is about one."""
    columns = [F.col(c) for c in key]
    if item and item in df.columns and item not in key:
        return df.withColumn(
            "_id", F.when(F.col(item) != "-1", record_id(*columns, F.col(item))).otherwise(record_id(*columns))
        )
    return df.withColumn("_id", record_id(*columns))


def append_by_day(df: DataFrame, path: str, time: str, day: str = "dt") -> DataFrame:
    """Append into day partitions, any number of them.

    The rebalance hint merges small days into few files and splits a large day.
    """
    df.withColumn(day, F.to_date(time)).hint("rebalance", day).write.partitionBy(day).mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def latest_per_id(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """One row per ``_id``, the last by ``order``; combines before the shuffle."""
    rest = [c for c in df.columns if c != "_id"]
    return (
        df.groupBy("_id").agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_r")).select("_id", "_r.*")
    )


def upsert(df: DataFrame, path: str, key: Sequence[str], partition: Column, order: Sequence[Column] = (),
           partition_name: str = "part", **more) -> DataFrame:
    """``merge_into``, and the whole table after it."""
    spark = df.sparkSession
    state, layout = merge_into(df, path, key, partition, order, partition_name, **more)
    return TableLog(spark, path).read(layout, state)


def merge_into(df: DataFrame, path: str, key: Sequence[str], partition: Column, order: Sequence[Column] = (),
               partition_name: str = "part", writer: str | None = None, number: int | None = None, notes: dict | None = None,
               step: Callable[[str], None] = lambda name: None) -> tuple[Snapshot, T.StructType]:
    """Keyed write: a row replaces the stored row with the same key.

    The table is a ``sinks.log`` table: partitions that receive rows get new files, and one new log entry puts them in
    the place of the old ones. Stopped at any point, the table is as before or as after the write, and a repeated call
    completes it; readers never see it in between, and writers at the same time lose no rows.

    ``order`` decides between all rows of one key, stored or new, so an older row never replaces a newer one; of equal
    ones the new row stays. Without it new rows win, and among them the last by all columns. ``writer`` and ``number``
    name a write of a stream: one that is committed already is left out. ``step`` hears how far the write is.
    """
    spark = df.sparkSession
    inside = list(order) or [F.struct(*df.columns)]
    fresh = latest_per_id(with_record_id(df, key), inside).withColumn(partition_name, partition)
    layout = fresh.schema
    log = TableLog(spark, path)
    # written first, as files the table may take as they are: a batch is computed once, however often it has to be merged
    files = write_files(log, fresh, partition_name)
    step("staged")
    touched = {f["part"] for f in files}

    def merged(state: Snapshot) -> DataFrame | None:
        if not touched & state.parts():
            return None
        kept = log.read(layout, state, touched).withColumn("_new", F.lit(0))
        new = log.read(layout, Snapshot(files={f["file"]: f for f in files})).withColumn("_new", F.lit(1))
        last = F.struct(*order, "_new") if order else F.struct("_new")
        rest = [c for c in layout.names if c not in ("_id", partition_name)]
        return (
            kept.unionByName(new).groupBy(partition_name, "_id")
            .agg(F.max_by(F.struct(*rest), last).alias("_r")).select("_id", "_r.*", partition_name)
        )

    if not touched and writer is None:
        return log.snapshot(), layout
    state = replace_parts(log, files, merged, touched, partition_name, writer, number, notes, step)
    if state.version and state.version % SNAPSHOT == 0:
        log.vacuum()
    return state, layout


def open_table(spark: SparkSession, path: str, parts: Iterable[str] | None = None, part: str = "dt") -> DataFrame:
    """A stored table, written by ``upsert`` or as plain Parquet; with ``parts`` only these partitions of it."""
    log = TableLog(spark, path)
    if log.exists():
        state = log.snapshot()
        if not state.files:
            raise ValueError(f"no rows have been stored in {path}")
        layout = spark.read.parquet(f"{log.path}/{next(iter(state.files))}").schema
        return log.read(layout, state, parts)
    table = spark.read.parquet(path)
    return table if parts is None else table.where(F.col(part).cast("string").isin(sorted(parts)))


def write_forecasts(forecast: DataFrame, path: str) -> DataFrame:
    """Forecast table by day; a repeated or newer forecast of a slot replaces the older one."""
    return upsert(
        enforce_schema(forecast, schemas.FORECAST), path, schemas.FORECAST_KEY, F.to_date("recordTime"),
        [F.col("createTime")], "dt",
    )


def write_scores(scores: DataFrame, path: str) -> DataFrame:
    """KPI result table by hour, so that a run over one slot rewrites one hour."""
    return upsert(enforce_schema(scores, schemas.KPI_SCORE), path, schemas.KPI_SCORE_KEY, hour("minId"), (), "hour")


def write_windows(windows: DataFrame, path: str) -> DataFrame:
    """Element window table by hour."""
    return upsert(enforce_schema(windows, schemas.ELEMENT_WINDOW), path, schemas.WINDOW_KEY, hour("minId"), (), "hour")


def hour(time: str) -> Column:
    return F.date_format(time, "yyyyMMddHH")


def write_history(history: DataFrame, root: str, version: int) -> DataFrame:
    """Store a history under a new version, beside the one it was computed from."""
    path = f"{root}/version={version}"
    history.write.mode("overwrite").parquet(path)
    return history.sparkSession.read.parquet(path)


def audited_write(df: DataFrame, path: str, name: str = "write") -> tuple[DataFrame, int]:
    """Write and return what is stored together with the number of rows offered."""
    offered = Observation(name)
    df.observe(offered, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path), int(offered.get["rows"])


def as_json(df: DataFrame, name: str = "record") -> DataFrame:
    """Each row as a JSON document; nulls are kept."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias(name))
