"""Active users, launches and sessions per day and platform."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .rollup import LEVEL, member_rollup

LEVELS = [["pl"], []]


def stats_user(grain: DataFrame, views: str = "product") -> DataFrame:
    """``session_length`` is views per session, whole; ``views`` says which count:
    ``product`` (product views only, the established meaning) or ``all``."""
    per_session = {"product": "n_bp", "all": "n_view"}[views]
    return member_rollup(grain, ["pl"], LEVELS).select(
        "dt",
        "pl",
        LEVEL,
        F.col("users").alias("active_users"),
        F.col("n_launch").alias("new_install_users"),
        F.col("sessions").alias("session_count"),
        F.call_function("div", F.col(per_session), F.col("sessions")).alias("session_length"),
    )
