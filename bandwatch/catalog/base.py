"""Registration of queries and their presentation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bandwatch.functions.values import is_number, round_at

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def wrap(run: Run) -> Run:
        REGISTRY[name] = Query(lambda spark, sf_dir: present(run(spark, sf_dir)), sql)
        return run

    return wrap


def present(df: DataFrame) -> DataFrame:
    """Times as text and decimals as doubles, as the output tables store them."""
    out = []
    for field in df.schema:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.TimestampNTZType, T.TimestampType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(field.dataType, T.DateType):
            c = c.cast("string")
        elif isinstance(field.dataType, T.DecimalType):
            c = c.cast("double")
        out.append(c.alias(field.name))
    return df.select(*out)


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    """Round for comparison where engines add in different orders."""
    return df.withColumns({c: F.when(is_number(F.col(c)), round_at(F.col(c), 10.0**places)) for c in columns})
