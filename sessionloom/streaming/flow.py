"""Running flow per day and place: launches, users, views, sessions, one-event sessions.

One stateful aggregation holds a row per (day, place label, member), so the users
and sessions of a large country are spread over all state partitions and rows of
one member are combined before the shuffle. A micro-batch only touches the
members it contains. What it changes per place is a handful of numbers, written
to a log by day; the current table is the sum of the log.

Days close some time after the newest event, so the state holds a few days. Rows that come later are missing here until
``repair_flow`` builds their day anew from the event store, which takes every row.
"""

from __future__ import annotations

import datetime
import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.dims import LOCATION_KEY
from ..operators.grain import session_grain
from ..operators.locations import FLOW_LEVELS, location_flow
from ..operators.rollup import LEVEL, fan_out
from ..operators.upsert import latest_flow
from ..plans import facts
from ..plans.etl import located_events
from ..schemas import LAUNCH, VIEW_EVENTS, table
from ..session import written_once
from ..sinks.daylog import COMPACT_EVERY, DayLog
from ..sinks.folders import Folders
from ..sources.event_table import read_event_day
from .start import FLOW_EVERY, start_batches

# days after the newest event's for which a day stays open
OPEN_DAYS = 2
# folder of the live job's own dimension tables, which no other job writes
LIVE = "live"
LABEL = ["dt", *LOCATION_KEY, LEVEL]
FLOW_LOG = table(
    country="string", province="string", city="string", level="int", n="bigint", nu="bigint", pv="bigint",
    new_users="bigint", new_sessions="bigint", bounce_change="bigint",
)
FACT_LOG = table(
    date_dimension_id="bigint", location_dimension_id="bigint", level="int", nu="bigint", uv="bigint", pv="bigint",
    sn="bigint", on="bigint", created="string",
)
FACT_KEY = ["date_dimension_id", "location_dimension_id", LEVEL]
FACTS = "stats_location_flow"


def flow_state(events: DataFrame, watermark: str | None = None, day_starts_at: str = "0 hours") -> DataFrame:
    """Streaming aggregate in update mode: per day, place and member the totals so far.

    Each event leaves a mark on its user, its session and the place itself. Marks
    carry the time stamp of their micro-batch, which Spark fixes per batch and
    repeats on a replay; ``batch_ts`` is that stamp for the current batch.

    With a ``watermark`` days close that long after the newest event and leave the state; rows for closed days are
    missing here, but not in the event store. Without one every day stays open, at the price of state for all days.

    ``day_starts_at`` shifts the daily windows, which Spark aligns to UTC: for
    UTC+8 it is ``16 hours``.
    """
    stamp = F.unix_millis(F.current_timestamp())
    launch, view = (F.col("en") == LAUNCH), F.col("en").isin(VIEW_EVENTS)
    mark = lambda kind, member, a, v: F.struct(
        F.lit(kind).alias("kind"), member.cast("string").alias("member"),
        a.cast("bigint").alias("launches"), v.cast("bigint").alias("views"),
    )
    none = F.lit(0)
    marks = F.array(
        mark("place", F.lit(None), launch, view),
        mark("user", F.col("uid"), none, none),
        mark("session", F.col("sid"), none, none),
    )
    timed = events.withColumn("ts", F.timestamp_millis("access_time"))
    if watermark:
        timed = timed.withWatermark("ts", watermark)
    marked = timed.select("ts", *LOCATION_KEY, F.explode(marks).alias("m")).select("ts", *LOCATION_KEY, "m.*")
    labelled = fan_out(marked.withColumn("stamp", stamp), LOCATION_KEY, FLOW_LEVELS)
    totals = labelled.groupBy(
        F.window("ts", "1 day", startTime=day_starts_at).alias("day"), *LOCATION_KEY, LEVEL, "kind", "member"
    ).agg(
        F.count("*").alias("n"),
        F.sum("launches").alias("launches"),
        F.sum("views").alias("views"),
        F.min("stamp").alias("first_ts"),
        F.max("stamp").alias("last_ts"),
        F.sum(F.col("stamp").cast("decimal(20,0)")).alias("stamp_sum"),
    )
    return totals.select(
        F.to_date("day.start").alias("dt"), *LOCATION_KEY, LEVEL, "kind", "member", "n", "launches", "views",
        "first_ts", "last_ts", "stamp_sum", stamp.alias("batch_ts"),
    )


def flow_changes(state: DataFrame) -> DataFrame:
    """What one micro-batch changed per day and place.

    A member is new if all its marks are from this batch. It had one event before
    if exactly one mark is from elsewhere: then the odd mark is the smallest or
    largest stamp, and the sum of stamps proves that no other differs.
    """
    n, first, last, now = (F.col(c) for c in ("n", "first_ts", "last_ts", "batch_ts"))
    rest = (n - 1).cast("decimal(18,0)") * now.cast("decimal(19,0)")
    new = (first == now) & (last == now)
    had_one = (
        ((last == now) & (first < now) & (F.col("stamp_sum") == rest + first))
        | ((first == now) & (last > now) & (F.col("stamp_sum") == rest + last))
    )
    session = F.col("kind") == "session"
    bounce = F.when(new & (n == 1), 1).when(~new & had_one, -1).otherwise(0)
    place = F.col("kind") == "place"
    return state.groupBy(*LABEL).agg(
        F.max(F.when(place, n)).alias("n"),
        F.max(F.when(place, F.col("launches"))).alias("nu"),
        F.max(F.when(place, F.col("views"))).alias("pv"),
        F.count_if((F.col("kind") == "user") & new).alias("new_users"),
        F.count_if(session & new).alias("new_sessions"),
        F.sum(F.when(session, bounce).otherwise(0)).cast("bigint").alias("bounce_change"),
    )


def add_up(log: DataFrame) -> DataFrame:
    """State of the log: changes add up, running totals only grow."""
    return log.groupBy(*LABEL).agg(
        *[F.max(c).alias(c) for c in ("n", "nu", "pv")],
        *[F.sum(c).alias(c) for c in ("new_users", "new_sessions", "bounce_change")],
    )


def flow_log(spark: SparkSession, path: str, compact_every: int = COMPACT_EVERY) -> DayLog:
    return DayLog(spark, path, FLOW_LOG, add_up, compact_every)


def fact_log(spark: SparkSession, warehouse: str, compact_every: int = COMPACT_EVERY) -> DayLog:
    return DayLog(spark, f"{warehouse}/{FACTS}", FACT_LOG, lambda log: latest_flow(log, ["dt", *FACT_KEY]), compact_every)


def current_flow(spark: SparkSession, path: str) -> DataFrame:
    """The live table, equal to ``location_flow`` of all events seen."""
    return _named(add_up(flow_log(spark, path).read()))


def _named(totals: DataFrame) -> DataFrame:
    return totals.select(
        *LABEL, "nu", F.col("new_users").alias("uv"), "pv", F.col("new_sessions").alias("sn"),
        F.col("bounce_change").alias("on"),
    )


def flow_handler(path: str, warehouse: str | None = None, compact_every: int = COMPACT_EVERY
                 ) -> Callable[[DataFrame, int], None]:
    """Batch handler: log the changes, then upsert the facts of the places they touch."""

    def handle(state: DataFrame, batch_id: int) -> None:
        spark = state.sparkSession
        # the stateful plan runs once; everything after it reads the written log
        log = flow_log(spark, path, compact_every)
        days = log.append(flow_changes(state), batch_id)
        if warehouse and days:
            known = log.read(days, batch_id)
            touched = written_once(known.filter(F.col("batch_id") == batch_id).select(*LABEL).distinct())
            same = [known[c].eqNullSafe(touched[c]) for c in LABEL]
            rows = _named(add_up(known.join(touched, same, "left_semi")))
            fact_log(spark, warehouse, compact_every).append(_facts(spark, warehouse, rows), batch_id)

    return handle


def _facts(spark: SparkSession, warehouse: str, rows: DataFrame) -> DataFrame:
    """Fact rows of named flow rows, with dt; unseen places get ids first."""
    rows = written_once(rows)
    dims = facts.refresh_dimensions(spark, f"{warehouse}/{LIVE}", rows, None, rows)
    return facts.flow_fact(rows, dims).withColumn("dt", F.to_date("created"))


def current_flow_facts(spark: SparkSession, warehouse: str) -> DataFrame:
    """Latest fact row per date, place and level, ``created`` as first written."""
    log = fact_log(spark, warehouse)
    return log.latest(log.read()).drop("dt")


def repair_flow(spark: SparkSession, path: str, warehouse: str, open_days: int = OPEN_DAYS) -> list[dict]:
    """Build closed days anew from the event store where it holds loads that the last repair did not know.

    A closed day gets no more rows from the stream, so the rows that came too late are all in the store. The day's part of
    the log becomes what the batch operators make of the stored events, and so do its facts. ``_repairs`` notes for each day
    the loads, the events the stream had counted, those now counted, and the difference. ``open_days`` is the watermark
    of the stream in days; nothing is done to days that may still be open.
    """
    log, events = flow_log(spark, path), Folders(spark, f"{warehouse}/events")
    days = log.days()
    if not days:
        return []
    last_closed = max(days) - datetime.timedelta(days=open_days + 1)
    stored = {datetime.date.fromisoformat(n.removeprefix("dt=")) for n in events.names("", "dt=")}
    done = []
    for day in sorted(d for d in stored if d <= last_closed):
        loads = sorted(f"{w}/{x}" for w in events.names(f"dt={day}", "writer=") for x in events.names(f"dt={day}/{w}", "load="))
        note = json.loads(log.folders.read_text(f"_repairs/dt={day}") or "{}")
        if note.get("loads") == loads:
            continue
        finest = add_up(log.read([day])).filter(F.col(LEVEL) == 0)
        live = finest.agg(F.sum("n")).first()[0] or note.get("counted", 0)
        rows = written_once(read_event_day(spark, events.root, str(day)))
        flow = written_once(location_flow(session_grain(rows)))
        upto = max([0, *log._parts(f"dt={day}", "d"), *log._parts(f"dt={day}", "b")])
        log.rebase(day, upto, flow.select(
            "dt", *LOCATION_KEY, LEVEL, F.lit(None).cast("bigint").alias("n"), "nu", "pv", F.col("uv").alias("new_users"),
            F.col("sn").alias("new_sessions"), F.col("on").alias("bounce_change")))
        fact_log(spark, warehouse).rebase(day, upto, _facts(spark, warehouse, flow))
        counted = rows.count()
        note = {"day": str(day), "loads": loads, "live": live, "counted": counted, "dropped": max(counted - live, 0)}
        log.folders.write_text(f"_repairs/dt={day}", json.dumps(note))
        done.append(note)
    return done


def start_flow(lines: DataFrame, rules: DataFrame, path: str, checkpoint: str, warehouse: str | None = None,
               every: str | None = FLOW_EVERY, watermark: str | None = f"{OPEN_DAYS} days", day_starts_at: str = "0 hours",
               compact_every: int = COMPACT_EVERY) -> StreamingQuery:
    """Log lines of any stream to the live flow.

    Days close ``watermark`` after the newest event; see ``repair_flow`` for rows that come later. The number of state partitions is fixed by ``spark.sql.shuffle.partitions`` at
    the first start of a checkpoint, so set it for the size to come.
    """
    state = flow_state(located_events(lines, rules), watermark, day_starts_at)
    return start_batches(state, flow_handler(path, warehouse, compact_every), checkpoint, every, mode="update")
