"""The event store: Parquet under ``dt=…/writer=…/load=…``.

A folder belongs to the load that wrote it. A load is named by its writer and an identity of its own: the day for the
daily job, the batch number for a stream, whose writer name lives in its checkpoint. Writing a load again replaces its
own folders on all dates and touches no other. Dates come first, so reading one lists the loads that hold it and nothing
else, however many loads there have been.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.dates import event_date
from ..session import delete_on_exit
from .folders import Folders

# dates of every load, one small file each
LOADS = "_loads"


def load_folder(date: str, writer: str, load: str) -> str:
    return f"{date}/writer={writer}/load={load}"


def replace_load(events: DataFrame, base: str, writer: str, load: str) -> list[str]:
    """Store the events of one load by their date instead of what the same load stored before; its dates.

    The rows are written aside and then moved, a folder for each date. Which dates a load has is noted before anything
    is moved, so that a run that breaks off is put right by the next one.
    """
    spark, folders = events.sparkSession, Folders(events.sparkSession, base)
    aside = f"_staged/{uuid.uuid4().hex}"
    delete_on_exit(spark, f"{base}/{aside}")
    dated = events.withColumn("dt", event_date(F.col("access_time")))
    dated.write.partitionBy("dt").parquet(f"{base}/{aside}")
    dates = folders.names(aside, "dt=")
    note = f"{LOADS}/writer={writer}/load={load}"
    known = sorted({*dates, *(folders.read_text(note) or "").split()})
    folders.write_text(note, "\n".join(known))
    for date in known:
        target = load_folder(date, writer, load)
        if date in dates:
            folders.move(f"{aside}/{date}", target)
        else:
            folders.delete(target)
    folders.write_text(note, "\n".join(dates))
    folders.delete(aside)
    return dates


def stream_writer(spark: SparkSession, checkpoint: str) -> str:
    """The name under which a stream writes, made once for a checkpoint. Batch numbers only repeat within one."""
    folders = Folders(spark, checkpoint)
    if (name := folders.read_text("writer")) is None:
        name = f"stream-{uuid.uuid4().hex[:16]}"
        folders.write_text("writer", name, replace=False)
    return name
