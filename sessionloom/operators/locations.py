"""Users, sessions and bounces per platform and place; the running flow per place."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .rollup import LEVEL, member_rollup

DEVICE_LEVELS = [
    base + place
    for base in ([], ["pl"])
    for place in (["country"], ["country", "province"], ["country", "province", "city"])
]
FLOW_LEVELS = [["country"], ["country", "province"], ["country", "province", "city"]]


def stats_device_location(grain: DataFrame) -> DataFrame:
    """A bounce is a session with exactly one event within the group it is counted in."""
    return member_rollup(grain, ["pl", "country", "province", "city"], DEVICE_LEVELS).select(
        "dt", "pl", "country", "province", "city", LEVEL,
        F.col("users").alias("active_users"),
        F.col("sessions").alias("session_count"),
        F.col("bounces").alias("bounce_sessions"),
    )


def location_flow(grain: DataFrame) -> DataFrame:
    """Launches, users, views, sessions and one-event sessions per day and place."""
    return member_rollup(grain, ["country", "province", "city"], FLOW_LEVELS).select(
        "dt", "country", "province", "city", LEVEL,
        F.col("n_launch").alias("nu"),
        F.col("users").alias("uv"),
        F.col("n_view").alias("pv"),
        F.col("sessions").alias("sn"),
        F.col("bounces").alias("on"),
    )
