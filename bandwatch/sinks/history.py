"""Versions of the rolling history: complete ones carry a mark, readers take the newest that holds what its mark says."""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bandwatch.operators.cleaning import repair_tail
from bandwatch.sinks.audit import fingerprint


class HistoryStore:
    """Histories below one folder: ``version=N`` with the rows, ``_marks/N.json`` with their number and fingerprint."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Versions with a mark, the newest first."""
        marks = self._path(f"{self.root}/_marks")
        if not self._fs.exists(marks):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(marks)]
        return sorted((int(n[:-5]) for n in names if n.endswith(".json")), reverse=True)

    def path(self, version: int) -> str:
        return f"{self.root}/version={version}"

    def _mark(self, version: int) -> str:
        return f"{self.root}/_marks/{version}.json"

    def write(self, history: DataFrame, keep: int | None = 3) -> int:
        """Store a history as the next version; returns its number.

        The mark comes last and at once, so a stopped write is never read and its number is used again. Versions before
        the newest ``keep`` are deleted, their marks first; None keeps all.
        """
        version = max(self.versions(), default=0) + 1
        history.write.mode("overwrite").parquet(self.path(version))
        stored = fingerprint(self.spark.read.schema(history.schema).parquet(self.path(version))).first()
        text = json.dumps({"rows": stored["rows"], "sum": str(stored["sum"]), "layout": history.schema.json()})
        draft = self._path(f"{self._mark(version)}.draft")
        stream = self._fs.create(draft, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self._fs.rename(draft, self._path(self._mark(version)))
        self.retire(self.versions()[keep:] if keep is not None else ())
        return version

    def retire(self, versions: Iterable[int]) -> None:
        """Delete versions, their marks first."""
        for old in versions:
            self._fs.delete(self._path(self._mark(old)), False)
            self._fs.delete(self._path(self.path(old)), True)

    def _intact(self, version: int) -> DataFrame | None:
        """The rows of a version, or None where files are gone or unreadable or hold something else than was written."""
        stream = self._fs.open(self._path(self._mark(version)))
        try:
            mark = json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        try:
            rows = self.spark.read.schema(StructType.fromJson(json.loads(mark["layout"]))).parquet(self.path(version))
            found = fingerprint(rows).first()
        except PySparkException:
            return None
        return rows if (found["rows"], str(found["sum"])) == (mark["rows"], mark["sum"]) else None

    def read_version(self, version: int) -> DataFrame | None:
        """Rows of one version, None where it is gone or damaged."""
        rows = self._intact(version) if version in self.versions() else None
        return None if rows is None else repaired(rows)

    def read(self) -> tuple[int, DataFrame] | None:
        """Number and rows of the newest intact version, None where there is none.

        Checking a version reads it once. A history whose times are text has the tails of its elements repaired: rows
        after an element's last readable time are cut off, and elements without any vanish.
        """
        for version in self.versions():
            rows = self._intact(version)
            if rows is not None:
                return version, repaired(rows)
        return None


def repaired(history: DataFrame) -> DataFrame:
    """A history with its times as times; where they are text, ``position`` gives the order of an element's rows."""
    if dict(history.dtypes)["recordTime"] != "string":
        return history
    cut = repair_tail(history)
    return cut.withColumn("recordTime", F.try_to_timestamp(F.col("recordTime"), F.lit("yyyy-MM-dd HH:mm:ss")).cast("timestamp_ntz"))
