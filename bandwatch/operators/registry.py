"""Which elements exist and report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bandwatch.operators.skew import top_k_per_group
from bandwatch.schemas import ELEMENT_DIMS


def active_elements(actual: DataFrame, now: dt.datetime, hours: float = 3, k: int | None = None) -> DataFrame:
    """Elements with rows in the last hours; with ``k`` the ones with most rows per resource type, ties by id."""
    end = F.lit(now).cast("timestamp_ntz")
    start = F.lit(now - dt.timedelta(hours=hours)).cast("timestamp_ntz")
    counts = (
        actual.where(F.col("recordTime").between(start, end))
        .groupBy("resourceType", "resId")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    if k is None:
        return counts
    return top_k_per_group(counts, ["resourceType"], [F.desc("rows"), F.asc("resId")], k, ["resId"])


def element_registry(actual: DataFrame) -> DataFrame:
    """Distinct element descriptions."""
    return actual.select(*ELEMENT_DIMS).distinct()
