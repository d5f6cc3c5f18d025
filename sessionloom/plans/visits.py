"""Sessions and first visits day by day: each run reads one day and what the days before left for it."""

from __future__ import annotations

import datetime
import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import checked_date, day_start, next_day
from ..operators.dedup import latest_per_key
from ..operators.visits import INTERVAL, SESSION_GAP_MS, sessions_with_open
from ..schemas import table
from ..session import written_once
from ..sinks.folders import Folders
from ..sinks.tables import replace_folder
from ..sources.event_table import read_event_day

OPEN = table(uid="string", start_ts="bigint", end_ts="bigint", n="bigint")
FIRST = table(uid="string", access_time="bigint", en="string", dt="date")
BUCKETS = 64


def day_end(spark: SparkSession, date: str) -> int:
    """First millisecond after a day, in the session time zone."""
    return spark.range(1).select(day_start(next_day(F.lit(checked_date(date))))).first()[0]


def open_before(spark: SparkSession, path: str, date: str) -> DataFrame:
    """What the newest run before a day left open; nothing at the first run."""
    names = [n for n in Folders(spark, path).names("", "dt=") if n < f"dt={checked_date(date)}"]
    return spark.read.schema(OPEN).parquet(f"{path}/{names[-1]}") if names else spark.createDataFrame([], OPEN)


def run_sessions(spark: SparkSession, date: str, warehouse: str, gap_ms: int = SESSION_GAP_MS,
                 openers: list[str] | None = None) -> None:
    """Store the sessions that were over by the end of a day, and those that may go on.

    ``sessions/dt=`` of all days and the last ``open_sessions/dt=`` are together the sessions of all events, also
    of those over midnight. Days run in order; a day run again replaces its folders, and the days after it run again.
    """
    events = read_event_day(spark, f"{warehouse}/events", date).select("uid", "access_time", "en")
    left = open_before(spark, f"{warehouse}/open_sessions", date)
    found = written_once(sessions_with_open(events, left, day_end(spark, date), gap_ms, openers))
    day = checked_date(date)
    replace_folder(found.filter("NOT is_open").select("uid", *INTERVAL), f"{warehouse}/sessions/dt={day}")
    replace_folder(found.filter("is_open").select("uid", *INTERVAL), f"{warehouse}/open_sessions/dt={day}")


def known_users(spark: SparkSession, path: str, buckets: int = BUCKETS) -> str:
    """Name of the table of all users met, in buckets of their id and by the day they were first seen.

    The catalog may forget it with the session; the files and this definition are all there is to it.
    """
    name = f"known_users_{hashlib.md5(path.encode()).hexdigest()[:12]}"
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in FIRST)
    if not spark.catalog.tableExists(name):
        Folders(spark, path).make()
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet PARTITIONED BY (dt) "
                  f"CLUSTERED BY (uid) INTO {buckets} BUCKETS LOCATION '{path}'")
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def new_users(day_events: DataFrame, known: DataFrame, date: datetime.date) -> DataFrame:
    """The first event of every user who was not seen before a day. ``known`` keeps its buckets: only the day is shuffled."""
    first = latest_per_key(day_events.select("uid", "access_time", "en"), ["uid"], F.asc("access_time"), F.asc_nulls_first("en"))
    before = known.filter((F.col("dt") < F.lit(date)) & F.col("uid").isNotNull()).select(F.col("uid").alias("known_uid"))
    return first.filter("uid IS NOT NULL").join(before, F.col("uid") == F.col("known_uid"), "left_anti").withColumn(
        "dt", F.lit(date))


def run_first_visits(spark: SparkSession, date: str, warehouse: str, buckets: int = BUCKETS) -> None:
    """Add the users first seen on a day to the known ones.

    Events without a user are nobody's first. Days run in order; a day run again replaces its users, and the days after it run again.
    """
    day = checked_date(date)
    name = known_users(spark, f"{warehouse}/known_users", buckets)
    found = written_once(new_users(read_event_day(spark, f"{warehouse}/events", date), spark.table(name), day))
    # also without new users what an earlier run stored has to go
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (dt = '{day}')")
    Folders(spark, f"{warehouse}/known_users").delete(f"dt={day}")
    found.repartition(buckets, "uid").select(*FIRST.names).write.option("partitionOverwriteMode", "dynamic").mode(
        "append").insertInto(name)


def first_visits(spark: SparkSession, warehouse: str, buckets: int = BUCKETS) -> DataFrame:
    """All users with the event they were first seen by."""
    return spark.table(known_users(spark, f"{warehouse}/known_users", buckets))
