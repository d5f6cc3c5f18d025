"""Sessions and first visits recovered from bare events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .dedup import latest_per_key

SESSION_GAP_MS = 2 * 60 * 1000


def _slice(width: int) -> Column:
    """Number of the time slice of an event; rounds down before 1970 too."""
    ms = F.col("access_time")
    return F.call_function("div", ms - F.pmod(ms, F.lit(width)), F.lit(width))


def _time_slices(events: DataFrame, gap_ms: int, openers: list[str] | None) -> DataFrame:
    """One row per user and time slice no wider than the gap.

    Two events of one slice are never further apart than the gap, so only the
    first event of a slice can open a session. Slices are plain aggregates: they
    are combined before the shuffle, and the window that numbers them sees a user's
    slices, bounded by time, instead of a user's events.
    """
    width = min(gap_ms, SESSION_GAP_MS)
    opens = F.lit(True) if openers is None else F.coalesce(F.col("en").isin(openers), F.lit(False))
    return (
        events.groupBy("uid", _slice(width).alias("slice"))
        .agg(
            F.min("access_time").alias("first_ts"),
            F.max("access_time").alias("last_ts"),
            F.min(F.when(opens, F.col("access_time"))).alias("open_ts"),
            F.count("*").alias("n"),
        )
    )


def _numbered(slices: DataFrame, gap_ms: int) -> DataFrame:
    """Slices with the session number of their user."""
    by_user = Window.partitionBy("uid").orderBy("slice")
    before = F.lag("last_ts").over(by_user)
    starts = before.isNull() | (
        (F.col("first_ts") - before > gap_ms) & F.coalesce(F.col("open_ts") == F.col("first_ts"), F.lit(False))
    )
    return (
        slices.withColumn("starts", starts.cast("bigint"))
        .withColumn("session_no", F.sum("starts").over(by_user.rowsBetween(Window.unboundedPreceding, 0)))
    )


def sessionize(events: DataFrame, gap_ms: int = SESSION_GAP_MS, openers: list[str] | None = None) -> DataFrame:
    """Number each user's sessions: a new one starts after more than ``gap_ms`` without an event.

    With ``openers``, a pause only ends the session if one of these events follows
    it directly (a page load, say); other events carry the old session on. Of
    several events in the same millisecond any opener counts.
    """
    width = min(gap_ms, SESSION_GAP_MS)
    slices = _numbered(_time_slices(events, gap_ms, openers), gap_ms)
    numbers = slices.select(F.col("uid").alias("_uid"), F.col("slice").alias("_of"), "session_no")
    keyed = events.withColumn("_slice", _slice(width))
    same = F.col("uid").eqNullSafe(F.col("_uid")) & F.col("_slice").eqNullSafe(F.col("_of"))
    return keyed.join(numbers, same).drop("_slice", "_uid", "_of")


def session_summary(events: DataFrame, gap_ms: int = SESSION_GAP_MS, openers: list[str] | None = None) -> DataFrame:
    """Start, end and size of each session, from the slices alone."""
    return _summed(_numbered(_time_slices(events, gap_ms, openers), gap_ms))


def _summed(numbered: DataFrame) -> DataFrame:
    return numbered.groupBy("uid", "session_no").agg(
        F.min("first_ts").alias("start_ts"), F.max("last_ts").alias("end_ts"), F.sum("n").alias("n")
    )


INTERVAL = ["start_ts", "end_ts", "n"]


def sessions_with_open(events: DataFrame, open_sessions: DataFrame, until_ms: int, gap_ms: int = SESSION_GAP_MS,
                       openers: list[str] | None = None) -> DataFrame:
    """Sessions of a stretch of time that ends at ``until_ms``, from its events and the sessions left open before it.

    ``open_sessions`` (uid, start_ts, end_ts, n) goes into the window as one slice for each user, before all others.
    ``is_open`` marks the sessions that a later event may carry on: a user's last one, if its end is no further than the
    gap from ``until_ms``; with ``openers`` any last one, as a pause alone ends none then.
    """
    before = open_sessions.select(
        "uid", F.lit(-(1 << 62)).cast("bigint").alias("slice"), F.col("start_ts").alias("first_ts"),
        F.col("end_ts").alias("last_ts"), F.lit(None).cast("bigint").alias("open_ts"), "n")
    found = _summed(_numbered(_time_slices(events, gap_ms, openers).unionByName(before), gap_ms))
    last = F.col("session_no") == F.max("session_no").over(Window.partitionBy("uid"))
    goes_on = last if openers is not None else last & (F.col("end_ts") >= until_ms - gap_ms)
    return found.select("uid", *INTERVAL, goes_on.alias("is_open"))


def merged_intervals(intervals: DataFrame, key: list[str], gap_ms: int = SESSION_GAP_MS) -> DataFrame:
    """Stretches (``key``, start_ts, end_ts, n) put together where a pause is no longer than the gap, in any order of arrival."""
    by_key = Window.partitionBy(*key).orderBy("start_ts", "end_ts")
    reached = F.max("end_ts").over(by_key.rowsBetween(Window.unboundedPreceding, -1))
    starts = (reached.isNull() | (F.col("start_ts") - reached > gap_ms)).cast("bigint")
    numbered = intervals.withColumn("_starts", starts).withColumn(
        "_no", F.sum("_starts").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*key, "_no").agg(
        F.min("start_ts").alias("start_ts"), F.max("end_ts").alias("end_ts"), F.sum("n").alias("n")).drop("_no")


def first_visit(events: DataFrame) -> DataFrame:
    """The event with which a user appears for the first time."""
    return latest_per_key(events, ["uid"], F.asc("access_time"), F.asc("event_id"))
