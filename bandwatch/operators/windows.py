"""Rolling element windows over three slots."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bandwatch.functions.times import epoch, shift
from bandwatch.rules import ABNORMAL_SCORE, ALARM_SCORE
from bandwatch.schemas import ELEMENT_DIMS, ELEMENT_WINDOW


def flags(score: Column) -> dict[str, Column]:
    return {
        "isWindowAlarm": F.when(score >= ALARM_SCORE, 1).otherwise(0),
        "isWindowAbn": F.when(score >= ABNORMAL_SCORE, 1).otherwise(0),
    }


def window_score(elements: DataFrame, step: int = 300) -> DataFrame:
    """Sum of an element's scores over its slot and the two before it.

    The window holds one row per slot of one element.
    """
    recent = (
        Window.partitionBy(*ELEMENT_DIMS).orderBy(epoch(F.col("minId"))).rangeBetween(-2 * step, 0)
    )
    return elements.withColumn("windowScore", F.sum("abnScore").over(recent))


def window_alarm(elements: DataFrame, run_time: dt.datetime, step: int = 300) -> DataFrame:
    """Window result table with alarm and abnormal flags."""
    return (
        window_score(elements, step)
        .withColumns({**flags(F.col("windowScore")), "createTime": F.lit(run_time).cast("timestamp_ntz")})
        .select(*ELEMENT_WINDOW.names)
    )


def prior_scores(elements: DataFrame, step: int = 300) -> DataFrame:
    """Score rows as seen from each of the two following slots."""
    later = F.array(shift(F.col("minId"), step), shift(F.col("minId"), 2 * step))
    return elements.select(F.explode(later).alias("forSlot"), "minId", *ELEMENT_DIMS, "abnScore")


def union_scores(elements: DataFrame, step: int = 300) -> DataFrame:
    """Current and prior score rows of every slot."""
    current = elements.select(F.col("minId").alias("forSlot"), "minId", *ELEMENT_DIMS, "abnScore")
    return current.unionByName(prior_scores(elements, step))


def element_window_join(elements: DataFrame, step: int = 300) -> DataFrame:
    """The window score as an explicit union, sum and join; null dimensions do not match."""
    sums = (
        union_scores(elements, step)
        .groupBy(F.col("forSlot").alias("minId"), *ELEMENT_DIMS)
        .agg(F.sum("abnScore").alias("windowScore"))
    )
    return elements.select("minId", *ELEMENT_DIMS, "abnScore").join(sums, ["minId", *ELEMENT_DIMS], "left")
