"""Session length and depth: per session, as a histogram and as ratios."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.packed import pack_fields
from ..functions.ratios import ratio2
from ..schemas import ALL
from .rollup import LEVEL

# --- fixed values: bucket names, packed names and inclusive bounds ------------
TIME_BUCKETS = {
    "time_1s_3s": ("1s_3s", 0, 3),
    "time_4s_6s": ("4s_6s", 4, 6),
    "time_7s_9s": ("7s_9s", 7, 9),
    "time_10s_30s": ("10s_30s", 10, 30),
    "time_30s_60s": ("30s_60s", 31, 60),
    "time_1m_3m": ("1m_3m", 61, 180),
    "time_3m_10m": ("3m_10m", 181, 600),
    "time_10m_30m": ("10m_30m", 601, 1800),
    "time_30m": ("30m", 1801, None),
}
STEP_BUCKETS = {
    "step_1_3": ("1_3", 1, 3),
    "step_4_6": ("4_6", 4, 6),
    "step_7_9": ("7_9", 7, 9),
    "step_10_30": ("10_30", 10, 30),
    "step_30_60": ("30_60", 31, 60),
    "step_60": ("60", 61, None),
}
# ------------------------------------------------------------------------------
BUCKETS = {**TIME_BUCKETS, **STEP_BUCKETS}


def session_metrics(grain: DataFrame) -> DataFrame:
    """Seconds and view steps per session, per platform and over all platforms."""
    return (
        grain.groupingSets([("dt", "sid"), ("dt", "pl", "sid")], "dt", "pl", "sid")
        .agg(
            F.grouping("pl").cast("int").alias(LEVEL),
            F.call_function("div", F.max("max_ts") - F.min("min_ts"), F.lit(1000)).alias("length_s"),
            F.sum("n_view").alias("steps"),
        )
        # a total and a platform that is called like its label stay apart by their level
        .select("dt", F.when(F.col(LEVEL) == 1, ALL).otherwise(F.col("pl")).alias("pl"), LEVEL, "sid",
                "length_s", "steps")
    )


def _within(value: str, low: int, high: int | None):
    c = F.col(value)
    return c >= low if high is None else c.between(low, high)


def session_histogram(metrics: DataFrame) -> DataFrame:
    """Sessions per length and depth bucket; a session without views is in no depth bucket."""
    return metrics.groupBy("dt", "pl", LEVEL).agg(
        F.count("*").alias("session_count"),
        *[F.count_if(_within("length_s", lo, hi)).alias(c) for c, (_, lo, hi) in TIME_BUCKETS.items()],
        *[F.count_if(_within("steps", lo, hi)).alias(c) for c, (_, lo, hi) in STEP_BUCKETS.items()],
    )


def histogram_ratios(histogram: DataFrame) -> DataFrame:
    return histogram.select(
        "dt", "pl", LEVEL, "session_count", *[ratio2(F.col(c), F.col("session_count")).alias(c) for c in BUCKETS]
    )


def histogram_packed(histogram: DataFrame) -> DataFrame:
    """The histogram as one ``name=count|…`` text per day and platform."""
    fields = {"session_count": F.col("session_count"), **{name: F.col(c) for c, (name, _, _) in BUCKETS.items()}}
    return histogram.select("dt", "pl", LEVEL, pack_fields(fields).alias("packed"))


def session_aggr_stat(grain: DataFrame) -> DataFrame:
    return histogram_ratios(session_histogram(session_metrics(grain)))
