"""Dimension tables with surrogate ids, and facts that refer to them."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.dates import date_parts
from ..session import written_once

# --- fixed values: natural keys of the dimension tables ------------------------
DATE_KEY = ["year", "season", "month", "week", "day", "calendar", "type"]
PLATFORM_KEY = ["platform_name"]
LOCATION_KEY = ["country", "province", "city"]
DAY_TYPE = "day"
# ------------------------------------------------------------------------------


def date_dimension(days: DataFrame, day: str = "dt", date_type: str = DAY_TYPE) -> DataFrame:
    """Calendar rows for the distinct dates of a column."""
    d = F.col(day)
    return days.select(d).distinct().select(
        *[c.alias(name) for name, c in date_parts(d).items()],
        F.date_format(d, "yyyy-MM-dd").alias("calendar"),
        F.lit(date_type).alias("type"),
    )


def _same(left: DataFrame, right: DataFrame, key: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in key])


# places of a row within a partition, in a number that begins with the partition's
_ROW_BITS = 33


def assign_ids(keys: DataFrame, key: Sequence[str], start: int = 0) -> DataFrame:
    """Number distinct keys from ``start`` + 1 in key order, NULL first.

    The keys are sorted over range partitions and stored once, each with its partition and place there. An id is the
    place moved up by the sizes of the partitions before, which are one number each; no task sees all keys.
    """
    spark = keys.sparkSession
    order = [F.asc_nulls_first(c) for c in key]
    placed = written_once(keys.select(*key).orderBy(*order).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", _ROW_BITS)
    sizes = {r.part: r.n for r in placed.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()}
    before, rows = start, []
    for p in sorted(sizes):
        rows.append((p, before))
        before += sizes[p]
    offsets = spark.createDataFrame(rows, "_part bigint, _before bigint")
    row = F.col("_at") - F.shiftleft("_part", _ROW_BITS)
    numbered = placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    return numbered.select((F.col("_before") + row + 1).alias("id"), *key)


def new_dimension_rows(existing: DataFrame, wanted: DataFrame, key: Sequence[str], top: int) -> DataFrame:
    """Rows to append to ``existing`` so that every wanted key has an id; the largest id in use is ``top``.

    A rerun with the same keys gives no rows.
    """
    unseen = wanted.select(*key).distinct().join(existing, _same(wanted, existing, key), "left_anti")
    return assign_ids(unseen, key, top)


def with_dimension_id(facts: DataFrame, dim: DataFrame, on: dict[str, str | Column], name: str) -> DataFrame:
    """Add the id of the dimension row whose key equals the given fact columns, NULL equal to NULL.

    No hint: the optimizer broadcasts the dimension if its measured size allows,
    and sorts and merges otherwise.
    """
    d = dim.select(F.col("id").alias(name), *[F.col(k).alias("_d_" + k) for k in on])
    value = lambda v: F.col(v) if isinstance(v, str) else v
    same = reduce(lambda a, b: a & b, [value(v).eqNullSafe(F.col("_d_" + k)) for k, v in on.items()])
    return facts.join(d, same, "left").drop(*["_d_" + k for k in on])
