"""Upsert semantics: the last row of a key is the row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import MapType

from ..schemas import SOURCE_COLUMNS

EVENT_KEY = ["access_time", "uid", "en"]


def latest_per_key(df: DataFrame, key: Sequence[str], *order: Column) -> DataFrame:
    """Whole last row per key under ``order`` (written newest first).

    ``row_number() = 1`` lets the planner keep one row per key on the map side
    already, so a key with very many copies does not travel.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def newest_first(events: DataFrame) -> list[Column]:
    """The order of copies: where their lines came from, the last line first; then a hash of the row.

    That is the time of the file or message, the file's or partition's name, the offset in it and the line behind that
    offset. Rows without a source come last; the hash decides among rows of one place and repeats on every run.
    """
    rest = [f for f in events.schema.fields if f.name not in {*EVENT_KEY, *SOURCE_COLUMNS}]
    hashed = F.xxhash64(*[F.map_entries(f.name) if isinstance(f.dataType, MapType) else F.col(f.name) for f in rest])
    return [*[F.desc_nulls_last(c) for c in SOURCE_COLUMNS if c in events.columns], hashed.desc()]


def dedup_events(events: DataFrame) -> DataFrame:
    """One row per (access_time, uid, en): the one whose line came last."""
    return latest_per_key(events, EVENT_KEY, *newest_first(events))
