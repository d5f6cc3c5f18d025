"""Raw log lines to typed events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.barrier import computed_once
from ..functions.dates import is_calendar_ms
from ..functions.ip import ip_to_long
from ..functions.text import (
    decode_all, has_null, is_encoded, last_value_map, not_blank, pair_keys, pair_values, query_pairs,
    query_text, split_trimmed,
)
from ..schemas import PARAM_COLUMNS, REGION_COLUMNS

# how far a request may put its event beyond the time the server logged
AHEAD_MS = 24 * 3600 * 1000


def with_pairs(df: DataFrame, query: str = "query") -> DataFrame:
    """Add the decoded ``keys`` and ``vals`` of a query text, and ``bad_escape``."""
    encoded = is_encoded(F.col(query))
    paired = df.select("*", query_pairs(F.col(query)).alias("_pairs"))
    decoded = paired.select(
        *df.columns,
        decode_all(pair_keys(F.col("_pairs")), encoded).alias("keys"),
        decode_all(pair_values(F.col("_pairs")), encoded).alias("vals"),
    )
    bad = encoded & (has_null(F.col("keys")) | has_null(F.col("vals")))
    return computed_once(decoded, keys=F.col("keys"), vals=F.col("vals"), bad_escape=bad)


def parse_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Split every usable line; nothing here shuffles, so it also runs on a stream.

    A line is usable if it is not blank and has four ``|`` fields. Result: the
    event columns (regions only where a parameter set them), ``line_ip_num`` for
    the region lookup, ``params`` and ``reason``: NULL for a good event, else why
    the event cannot be stored. A time outside 1970 to 9999 is ``bad_time``; one that a request sets
    more than ``AHEAD_MS`` beyond the logged time is ``ahead_time``, as it would close every open day.
    """
    extra = [c for c in lines.columns if c != value]
    fields = (
        lines.filter(not_blank(F.col(value)))
        .select(F.col(value).alias("line"), *extra, split_trimmed(F.col(value), "|").alias("f"))
        .filter(F.size("f") == 4)
    )
    queried = fields.select("line", *extra, "f", query_text(F.get("f", F.lit(3))).alias("query"))
    raw = computed_once(
        with_pairs(queried),
        line_ip=F.get("f", F.lit(0)),
        line_time=F.get("f", F.lit(1)),
        line_ip_num=ip_to_long(F.get("f", F.lit(0))),
        params=last_value_map(F.col("keys"), F.col("vals"), ~F.col("bad_escape")),
    )
    param = lambda name: F.element_at("params", F.lit(name))
    # a parameter named like a stored field replaces it; the lookup keeps the line's own ip
    events = raw.select(
        "line",
        *extra,
        F.coalesce(param("ip"), "line_ip").alias("ip"),
        F.coalesce(param("access_time"), "line_time").try_cast("bigint").alias("access_time"),
        F.col("line_time").try_cast("bigint").alias("logged"),
        param("access_time").isNotNull().alias("own_time"),
        *[param(c).alias(c) for c in REGION_COLUMNS + PARAM_COLUMNS],
        "line_ip_num",
        "params",
        "bad_escape",
    )
    reason = (
        F.when(F.col("bad_escape"), "bad_escape")
        .when(F.col("line_ip_num").isNull(), "bad_ip")
        .when(~is_calendar_ms(F.col("access_time")), "bad_time")
        .when(F.col("own_time") & ~is_calendar_ms(F.col("logged")), "bad_time")
        .when(F.col("own_time") & (F.col("access_time") > F.col("logged") + AHEAD_MS), "ahead_time")
        .when(F.col("uid").isNull(), "no_uid")
        .when(F.col("en").isNull(), "no_en")
    )
    return events.withColumn("reason", reason).drop("bad_escape", "logged", "own_time")


def good_events(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).drop("reason", "line")


def bad_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNotNull()).select("line", "reason")
