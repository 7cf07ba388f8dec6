"""Tables stored by slot and element, so that work on both starts without an exchange."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOT_ELEMENT = ["recordTime", "resId"]
BUCKETS = 64


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int = BUCKETS, keys: Sequence[str] = SLOT_ELEMENT,
                   order: Sequence[str] = (), day: str | None = None) -> DataFrame:
    """Store ``df`` as a catalogue table with its data below ``path``; returns the table.

    All rows of one key lie in one bucket, sorted by the keys and ``order``. Tables that are
    joined must have the same ``buckets`` (about 200 MB each, of a day where ``day`` is given,
    the name of the partition column made from ``recordTime``). Rows are placed by bucket
    first, so a bucket is one file of each day. A null key is a key like any other.
    """
    keys = list(keys)
    rows = df if day is None else df.withColumn(day, F.to_date("recordTime"))
    sort = [*keys, *order]
    writer = rows.repartition(buckets, *keys).write.format("parquet").option("path", path).bucketBy(buckets, *keys).sortBy(*sort)
    (writer if day is None else writer.partitionBy(day)).saveAsTable(table)
    return df.sparkSession.table(table)
