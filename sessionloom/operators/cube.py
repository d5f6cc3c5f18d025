"""Event counts over platform and event, with their totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import event_date
from .rollup import LEVEL, fan_out

LEVELS = [["pl", "en"], ["pl"], ["en"], []]


def event_cube(events: DataFrame) -> DataFrame:
    """Counted once at the finest level; only those few rows are copied to the totals."""
    finest = events.groupBy(event_date(F.col("access_time")).alias("dt"), "pl", "en").agg(F.count("*").alias("n"))
    return fan_out(finest, ["pl", "en"], LEVELS).groupBy("dt", "pl", "en", LEVEL).agg(
        F.sum("n").alias("event_count"))
