"""Forecast bands, deviation scores and alarm windows for operational KPIs, on Spark.

Every operator takes DataFrames and rule tables and returns a DataFrame, so it
can be chained with ``DataFrame.transform``.
"""

from bandwatch.plans.forecasting import forecast
from bandwatch.plans.scoring import score
from bandwatch.session import configure, work_dir
from bandwatch.streaming.jobs import score_stream

__all__ = ["configure", "forecast", "score", "score_stream", "work_dir"]
