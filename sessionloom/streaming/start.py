"""Starting queries: cadence, checkpoint and simple outputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

FLOW_EVERY = "5 seconds"
WORDS_EVERY = "2 seconds"


def paced(writer: DataStreamWriter, checkpoint: str, every: str | None) -> DataStreamWriter:
    """Micro-batches at a fixed pace, or with ``every=None`` all that is there and then stop."""
    writer = writer.option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_batches(
    df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str,
    every: str | None = FLOW_EVERY, mode: str = "append",
) -> StreamingQuery:
    """Hand every micro-batch to ``handle``. After a failure the last batch comes again under
    the same number, so a handler must overwrite what it wrote for that number."""
    return paced(df.writeStream.outputMode(mode).foreachBatch(handle), checkpoint, every).start()


def start_console(df: DataFrame, checkpoint: str, every: str | None = WORDS_EVERY, mode: str = "update",
                  rows: int = 20) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).format("console").option("numRows", rows)
    return paced(writer, checkpoint, every).start()


def late_rows_dropped(query: StreamingQuery) -> int:
    """Rows behind the watermark, over the progress reports still kept."""
    return sum(
        op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"]
    )
