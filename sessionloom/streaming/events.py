"""Streaming load: lines to stored events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.parse import bad_records, parse_lines
from ..operators.regions import region_rules
from ..plans.etl import located_events, stored_columns
from ..sinks.event_store import replace_load, stream_writer
from ..sources.logs import line_number
from .start import FLOW_EVERY, paced, start_batches

EVENTS_EVERY = "60 seconds"


def start_event_load(lines: DataFrame, rules: DataFrame, path: str, checkpoint: str,
                     every: str | None = EVENTS_EVERY) -> StreamingQuery:
    """Add every good event to the event store, however late; each micro-batch is a load of its own.

    A batch that is replayed replaces what it stored. Copies are stored and resolved on reading, by the place of their
    lines, whichever job loaded them. Regions are looked up batch by batch, so rule sets of any size will do.
    """
    writer, known = stream_writer(lines.sparkSession, checkpoint), region_rules(rules)

    def load(batch: DataFrame, batch_id: int) -> None:
        numbered = batch.select("*", line_number())
        replace_load(stored_columns(located_events(numbered, known)), path, writer, f"{batch_id:012d}")

    return start_batches(lines, load, checkpoint, every)


def start_bad_records(lines: DataFrame, path: str, checkpoint: str, every: str | None = FLOW_EVERY) -> StreamingQuery:
    writer = bad_records(parse_lines(lines)).writeStream.format("parquet").option("path", path)
    return paced(writer, checkpoint, every).start()
