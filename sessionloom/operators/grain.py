"""Session grain: the one table that session, user, location and flow statistics share."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.dates import event_date
from ..schemas import LAUNCH, PRODUCT_VIEW, VIEW_EVENTS

GRAIN_KEY = ["dt", "pl", "country", "province", "city", "uid", "sid"]


def session_grain(events: DataFrame) -> DataFrame:
    """Events to one row per day, platform, place, user and session.

    Plain counts and bounds, so rows are combined on the map side and a hot
    session shrinks before it is shuffled. All later statistics only add up or
    compare these columns, hence raw events are shuffled once.
    """
    en = F.col("en")
    return (
        events.withColumn("dt", event_date(F.col("access_time")))
        .groupBy(*GRAIN_KEY)
        .agg(
            F.count("*").alias("n"),
            F.count_if(en == LAUNCH).alias("n_launch"),
            F.count_if(en.isin(VIEW_EVENTS)).alias("n_view"),
            F.count_if(en == PRODUCT_VIEW).alias("n_bp"),
            F.min("access_time").alias("min_ts"),
            F.max("access_time").alias("max_ts"),
        )
    )
