"""A log of upserts by day, written by the micro-batches of one stream.

``dt=…/part=d<N>`` holds what batch N changed on a day, ``dt=…/part=b<N>`` the day's state after batch N. A batch writes
into the days it touches, and only days that have gathered many batches are put together, so the work of a batch and
the files of a day do not grow with the history. A folder is written aside and moved, so it is there whole or not at
all; a batch that is replayed replaces its own folders.
"""

from __future__ import annotations

import datetime
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, StringType, StructField, StructType

from ..session import delete_on_exit
from .folders import Folders

COMPACT_EVERY = 50
DELTA, BASE = "d", "b"


class DayLog:
    """Rows of ``schema`` (without dt) by day; ``latest`` makes one state of rows with dt and ``batch_id``.

    One stream at a time may write. Reads see whole batches.
    """

    def __init__(self, spark: SparkSession, path: str, schema: StructType, latest: Callable[[DataFrame], DataFrame],
                 compact_every: int = COMPACT_EVERY):
        self.spark, self.path, self.schema, self.latest = spark, path, schema, latest
        self.compact_every = compact_every
        self.folders = Folders(spark, path)

    def _parts(self, date: str, kind: str) -> list[int]:
        return sorted(int(n[len("part=") + 1:]) for n in self.folders.names(date, f"part={kind}"))

    def days(self) -> list[datetime.date]:
        return [datetime.date.fromisoformat(n[len("dt="):]) for n in self.folders.names("", "dt=")]

    def read(self, days: Sequence[datetime.date] | None = None, upto: int | None = None) -> DataFrame:
        """Rows of the days (all days if None) with dt and ``batch_id``, as they were after batch ``upto``."""
        paths = []
        for day in self.days() if days is None else days:
            date = f"dt={day}"
            bases = [n for n in self._parts(date, BASE) if upto is None or n <= upto]
            begin = bases[-1] if bases else -1
            paths += [f"{self.path}/{date}/part={BASE}{begin}"] * bool(bases)
            paths += [f"{self.path}/{date}/part={DELTA}{n}" for n in self._parts(date, DELTA)
                      if n > begin and (upto is None or n <= upto)]
        wide = StructType([*self.schema.fields, StructField("dt", DateType()), StructField("part", StringType())])
        rows = self.spark.read.schema(wide).option("basePath", self.path).parquet(*paths) if paths else (
            self.spark.createDataFrame([], wide))
        return rows.withColumn("batch_id", F.substring("part", 2, 20).cast("bigint")).drop("part")

    def _write(self, rows: DataFrame, part: str) -> list[datetime.date]:
        aside = f"_staged/{uuid.uuid4().hex}"
        delete_on_exit(self.spark, f"{self.path}/{aside}")
        rows.select(*self.schema.names, "dt").write.partitionBy("dt").parquet(f"{self.path}/{aside}")
        dates = self.folders.names(aside, "dt=")
        for date in dates:
            self.folders.move(f"{aside}/{date}", f"{date}/part={part}")
        self.folders.delete(aside)
        return [datetime.date.fromisoformat(d[len("dt="):]) for d in dates]

    def append(self, rows: DataFrame, batch_id: int) -> list[datetime.date]:
        """Store what a batch changed; the days it touched. Puts days together that have gathered many batches."""
        days = self._write(rows, f"{DELTA}{batch_id}")
        for day in days:
            bases = self._parts(f"dt={day}", BASE)
            since = [n for n in self._parts(f"dt={day}", DELTA) if n > (bases[-1] if bases else -1)]
            if self.compact_every and len(since) >= self.compact_every:
                self.rebase(day, batch_id)
        return days

    def rebase(self, day: datetime.date, upto: int, rows: DataFrame | None = None) -> None:
        """Write the state of a day after batch ``upto``, or ``rows`` as that state, and drop what is older than the base before.

        The base before and what follows it stay, as a replayed batch reads the state it began with.
        """
        bases = self._parts(f"dt={day}", BASE)
        state = self.latest(self.read([day], upto)) if rows is None else rows
        if upto in bases and rows is None:
            return
        self._write(state, f"{BASE}{upto}")
        older = [n for n in bases if n < upto]
        if older:
            for kind, n in [(BASE, n) for n in older[:-1]] + [(DELTA, n) for n in self._parts(f"dt={day}", DELTA)
                                                              if n <= older[-1]]:
                self.folders.delete(f"dt={day}/part={kind}{n}")
