"""The stored events of one day."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ..functions.dates import checked_date, day_start, next_day
from ..operators.dedup import dedup_events
from ..schemas import ANALYSIS_COLUMNS, EVENT_SCHEMA, table
from ..sinks.folders import Folders
from .logs import MissingInput

TABLE_SCHEMA = StructType([*EVENT_SCHEMA.fields, *table(dt="date", writer="string", load="string").fields])


def day_slice(events: DataFrame, date: str) -> DataFrame:
    """Events from the first millisecond of a day up to the next day."""
    day = F.lit(checked_date(date))
    return events.filter(
        (F.col("access_time") >= day_start(day)) & (F.col("access_time") < day_start(next_day(day)))
    )


def stored_day(spark: SparkSession, base: str, date: str) -> DataFrame:
    """All stored rows of one day, copies included. Only the folder of the day is listed.

    A store without the day gives no rows; a missing store, or a folder of another layout, raises.
    """
    folders, day = Folders(spark, base), f"dt={checked_date(date)}"
    if not folders.exists():
        raise MissingInput(f"no event table: {base}")
    if not folders.exists(day):
        held = [n for n in folders.names() if not n.startswith(("_", "."))]
        if held and not any(n.startswith("dt=") for n in held):
            raise MissingInput(f"no folders dt=/writer=/load= in {base}")
        return spark.createDataFrame([], TABLE_SCHEMA)
    held = [n for n in folders.names(day) if not n.startswith(("_", "."))]
    if held and not all(n.startswith("writer=") for n in held):
        raise MissingInput(f"no folders writer=/load= in {base}/{day}")
    if not held:
        return spark.createDataFrame([], TABLE_SCHEMA)
    return day_slice(spark.read.schema(TABLE_SCHEMA).option("basePath", base).parquet(f"{base}/{day}"), date)


def read_event_day(spark: SparkSession, base: str, date: str) -> DataFrame:
    """The analysis columns of one day, one row per (access_time, uid, en): the copy whose line came last.

    One scan and one shuffle, in which each task passes on one copy of a key.
    """
    return dedup_events(stored_day(spark, base, date).drop("dt", "writer", "load")).select(*ANALYSIS_COLUMNS)
