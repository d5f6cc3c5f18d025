"""Raw log files of one day."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.dates import checked_date


class MissingInput(FileNotFoundError):
    """The day has no input; a job must not go on as if it were empty."""


def day_log_path(prefix: str, day: dt.date) -> str:
    return f"{prefix.rstrip('/')}/{day:%Y/%m/%d}"


def file_position() -> list[Column]:
    """Place of a line among those of a file source, but for its number behind the block's start."""
    return [F.unix_millis("_metadata.file_modification_time").alias("src_time"),
            F.col("_metadata.file_path").alias("src_name"), F.col("_metadata.file_block_start").alias("src_pos")]


def line_number() -> Column:
    """A task reads a block from its start to its end, so numbers within a task follow the lines of a block."""
    return F.monotonically_increasing_id().alias("src_line")


def read_day_logs(spark: SparkSession, prefix: str, date: str) -> DataFrame:
    """Lines under ``prefix/yyyy/MM/dd``, hour folders included, with their place."""
    path = day_log_path(prefix, checked_date(date))
    try:
        lines = spark.read.option("recursiveFileLookup", "true").text(path)
        return lines.select("value", *file_position(), line_number())
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            raise MissingInput(f"no log files for {date}: {path}") from err
        raise


def read_landed_day(spark: SparkSession, root: str, date: str) -> DataFrame:
    """Lines of one ingest day from the landing sink, with their place; the folders of other days are pruned.

    A day that landed nothing raises: a load of it would replace what is stored by nothing.
    """
    day = checked_date(date)
    try:
        lines = spark.read.schema("value string, y string, m string, d string, h string").text(root)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            raise MissingInput(f"no landed logs: {root}") from err
        raise
    landed = lines.filter(
        (F.col("y") == f"{day:%Y}") & (F.col("m") == f"{day:%m}") & (F.col("d") == f"{day:%d}")
    )
    if landed.isEmpty():
        raise MissingInput(f"no landed logs for {date}: {root}")
    return landed.select("value", *file_position(), line_number())
