"""Raw lines to files, by the hour they arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from .start import paced

LANDING_EVERY = "60 seconds"


def start_landing(lines: DataFrame, root: str, checkpoint: str, every: str | None = LANDING_EVERY) -> StreamingQuery:
    """Text files under ``y=/m=/d=/h=`` of the ingest time, one roll per trigger."""
    now = F.current_timestamp()
    parts = {"y": "yyyy", "m": "MM", "d": "dd", "h": "HH"}
    stamped = lines.select("value", *[F.date_format(now, p).alias(c) for c, p in parts.items()])
    writer = stamped.writeStream.format("text").option("path", root).partitionBy(*parts)
    return paced(writer, checkpoint, every).start()
