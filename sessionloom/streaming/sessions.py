"""Sessions of a stream of events: given out once they are over, or kept right whatever comes late."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import ArrayType, StructField, StructType

from ..functions.dates import event_date
from ..operators.dedup import latest_per_key
from ..operators.parse import good_events, parse_lines
from ..operators.visits import INTERVAL, SESSION_GAP_MS, merged_intervals, session_summary
from ..schemas import table
from ..session import written_once
from ..sinks.daylog import DayLog
from .start import FLOW_EVERY, start_batches

# a user's stretches of one day, at most one for each gap of the day
STRETCHES = StructType([*table(uid="string").fields,
                        StructField("stretches", ArrayType(table(start_ts="bigint", end_ts="bigint", n="bigint")))])


def closed_sessions(events: DataFrame, gap_ms: int = SESSION_GAP_MS, watermark: str = "1 hour") -> DataFrame:
    """Start, end and size per user and session, as ``session_summary`` without the number.

    Like the batch operator, Spark's session window goes on when the pause equals
    the gap and ends when it is longer. Rows behind the watermark are lost; ``start_sessions`` keeps them.
    """
    timed = events.withColumn("ts", F.timestamp_millis("access_time")).withWatermark("ts", watermark)
    return (
        timed.groupBy("uid", F.session_window("ts", f"{gap_ms} milliseconds"))
        .agg(F.min("access_time").alias("start_ts"), F.max("access_time").alias("end_ts"), F.count("*").alias("n"))
        .drop("session_window")
    )


def session_log(spark: SparkSession, path: str, **kw) -> DayLog:
    """A row for each user and day: the user's stretches of that day, written anew when one of them changes."""
    return DayLog(spark, path, STRETCHES, lambda log: latest_per_key(log, ["dt", "uid"], F.desc("batch_id")), **kw)


def _stretches(rows: DataFrame) -> DataFrame:
    return rows.select("dt", "uid", F.explode("stretches").alias("s")).select("dt", "uid", "s.*")


def repair_sessions(log: DayLog, events: DataFrame, batch_id: int, gap_ms: int = SESSION_GAP_MS) -> None:
    """Merge the events of one batch into the stored stretches of their users and days; nothing else is read or written.

    A late event lengthens a stretch, joins two or begins one of its own. The state before the batch is read, so a batch
    that is replayed gives the same again.
    """
    dated = events.select("uid", "access_time", "en", event_date(F.col("access_time")).alias("dt"))
    one_day = dated.withColumn("uid", F.struct("dt", "uid"))
    new = written_once(session_summary(one_day, gap_ms).select("uid.dt", "uid.uid", *INTERVAL))
    days = [r.dt for r in new.select("dt").distinct().collect()]
    touched = new.select("dt", "uid").distinct()
    state = log.latest(log.read(days, batch_id - 1))
    same = (state["dt"] == touched["dt"]) & state["uid"].eqNullSafe(touched["uid"])
    merged = merged_intervals(new.unionByName(_stretches(state.join(touched, same, "left_semi"))), ["dt", "uid"], gap_ms)
    log.append(merged.groupBy("dt", "uid").agg(F.array_sort(F.collect_list(F.struct(*INTERVAL))).alias("stretches")), batch_id)


def stored_sessions(log: DayLog, gap_ms: int = SESSION_GAP_MS) -> DataFrame:
    """Sessions (uid, start_ts, end_ts, n) of all events so far: stretches of neighbouring days are put together."""
    return merged_intervals(_stretches(log.latest(log.read())).drop("dt"), ["uid"], gap_ms)


def start_sessions(lines: DataFrame, path: str, checkpoint: str, gap_ms: int = SESSION_GAP_MS,
                   every: str | None = FLOW_EVERY) -> StreamingQuery:
    """Keep the sessions of a stream of log lines up to date, however late a line comes."""
    log = session_log(lines.sparkSession, path)
    handle = partial(_handle, log, gap_ms)
    return start_batches(lines, handle, checkpoint, every)


def _handle(log: DayLog, gap_ms: int, lines: DataFrame, batch_id: int) -> None:
    repair_sessions(log, good_events(parse_lines(lines)), batch_id, gap_ms)
