"""Keep an expensive column from being written out at every use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns the optimizer must not copy into later expressions and filters.

    A filter on a derived column is pushed below the projection with the whole
    expression written out at every use. It is not pushed below a generator, so
    the finished columns pass through a one-element ``explode``.
    """
    ready = df.withColumns(columns)
    kept = [c for c in df.columns if c not in columns]
    one = F.explode(F.array(F.struct(*columns)))
    return ready.select(*kept, one.alias("_one")).select(*kept, *[F.col("_one")[c].alias(c) for c in columns])
