"""Daily load: log lines of one day to stored events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import checked_date
from ..operators.dedup import dedup_events
from ..operators.parse import bad_records, good_events, parse_lines
from ..operators.regions import RegionRules, resolve_regions
from ..schemas import EVENT_COLUMNS, SOURCE_COLUMNS
from ..session import written_once
from ..sinks.event_store import replace_load
from ..sources.ip_rules import read_ip_rules
from ..sources.logs import read_day_logs, read_landed_day


# name under which the daily load writes
WRITER = "etl"


def located(parsed: DataFrame, rules: DataFrame | RegionRules) -> DataFrame:
    """Good events of parsed lines with their regions."""
    return resolve_regions(good_events(parsed), rules, "line_ip_num").drop("line_ip_num")


def located_events(lines: DataFrame, rules: DataFrame | RegionRules) -> DataFrame:
    """Good events of some lines with their regions; batch and stream alike."""
    return located(parse_lines(lines), rules)


def stored_columns(events: DataFrame) -> DataFrame:
    """The columns of the event store; places that the lines came without are NULL."""
    given = [F.col(c) if c in events.columns else F.lit(None).cast("string" if c == "src_name" else "bigint").alias(c)
             for c in SOURCE_COLUMNS]
    return events.select(*EVENT_COLUMNS, "params", *given)


def run_etl(spark: SparkSession, date: str, log_prefix: str, rule_path: str, warehouse: str,
            landed: bool = False) -> None:
    """Parse, locate and store one day; lines that cannot be stored go to ``bad_records``.

    ``landed`` says that ``log_prefix`` is the folder of the landing stream. Loading a day again replaces what the load
    of that day stored, and nothing that other loads or streams did. One row per key is stored; rows stay where the key
    shuffle put them, so a day is written by many tasks, each into the one or two dates it holds.
    """
    # the costly part of a load; stored once, as both results come from it
    read = read_landed_day if landed else read_day_logs
    parsed = written_once(parse_lines(read(spark, log_prefix, date)))
    rules = read_ip_rules(spark, rule_path)
    events = dedup_events(stored_columns(located(parsed, rules)))
    replace_load(events, f"{warehouse}/events", WRITER, str(checked_date(date)))
    bad = bad_records(parsed)
    bad.write.mode("overwrite").parquet(f"{warehouse}/bad_records/load_day={date}")
