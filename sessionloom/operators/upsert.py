"""Read view over a log of upserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def latest_flow(log: DataFrame, key: Sequence[str], version: str = "batch_id",
                kept: Sequence[str] = ("created",)) -> DataFrame:
    """Latest row per key, except that ``kept`` columns stay as first written.

    Aggregates combine on the map side, so a key rewritten in every batch does
    not pile up in one task.
    """
    values = [c for c in log.columns if c not in {*key, version, *kept}]
    newest = F.max_by(F.struct(*values), version).alias("_v")
    oldest = [F.min_by(c, version).alias(c) for c in kept]
    return log.groupBy(*key).agg(newest, *oldest).select(*key, "_v.*", *kept)
