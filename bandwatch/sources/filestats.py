"""What a table's files hold, kept beside it: first and last time of every element in every file.

A run that wants only rows newer than what it knows of each element asks this table first, and opens only files that hold
such rows. Day partitions cannot tell that: most elements of a day may be known already.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bandwatch.sources.readings import rows_after

LAYOUT = "file string, resId string, itemPara string, firstTime timestamp_ntz, lastIn timestamp_ntz, rows long"


def file_stats(table: DataFrame, time: str = "recordTime") -> DataFrame:
    """(file, resId, itemPara, firstTime, lastIn, rows) of a table read from files; one row for each element of a file."""
    return table.groupBy(F.input_file_name().alias("file"), "resId", "itemPara").agg(
        F.min(time).alias("firstTime"), F.max(time).alias("lastIn"), F.count(F.lit(1)).alias("rows"))


def stored_stats(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LAYOUT).option("recursiveFileLookup", "true").parquet(path)


def add_stats(table: DataFrame, path: str, time: str = "recordTime") -> DataFrame:
    """Add the statistics of files that have none yet, and return all of them.

    Files are known by name before any is opened, so only new ones are read.
    """
    spark = table.sparkSession
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
        spark.createDataFrame([], LAYOUT).write.parquet(path)
    known = {r.file for r in stored_stats(spark, path).select("file").distinct().collect()}
    new = [f for f in table.inputFiles() if f not in known]
    if new:
        file_stats(read_files(spark, new, table), time).coalesce(1).write.mode("append").parquet(path)
    return stored_stats(spark, path)


def read_files(spark: SparkSession, files: list[str], table: DataFrame) -> DataFrame:
    """Some files of a table in its columns, without those that its folders' names give."""
    inside = [f for f in table.schema if f.name in _stored(spark, files)]
    return spark.read.schema(type(table.schema)(inside)).parquet(*files)


def _stored(spark: SparkSession, files: list[str]) -> set[str]:
    return set(spark.read.parquet(files[0]).columns)


def files_with_news(stats: DataFrame, last_seen: DataFrame) -> list[str]:
    """Files that hold a row newer than its element's ``lastTime``, or a row of an unknown element. Their names reach the driver."""
    key = [c for c in ("resId", "itemPara") if c in last_seen.columns]
    met = stats.join(last_seen, key, "left").where(F.col("lastTime").isNull() | (F.col("lastIn") > F.col("lastTime")))
    return sorted(r.file for r in met.select("file").distinct().collect())


def rows_after_by_files(table: DataFrame, stats: DataFrame, last_seen: DataFrame) -> tuple[DataFrame, int]:
    """``rows_after`` over a stored table, and how many files it opens. ``stats`` must know all files of the table."""
    spark = table.sparkSession
    wanted = set(files_with_news(stats, last_seen))
    files = [f for f in table.inputFiles() if f in wanted]
    if not files:
        return rows_after(table.limit(0), last_seen), 0
    return rows_after(read_files(spark, files, table), last_seen), len(files)
