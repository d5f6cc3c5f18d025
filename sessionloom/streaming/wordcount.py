"""Word counts of a text stream, per micro-batch or running."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.wordcount import word_count
from ..schemas import table
from ..sinks.batchlog import append_batch, read_log
from .start import WORDS_EVERY, start_batches

WORD_LOG = table(word="string", n="bigint")


def start_word_count(lines: DataFrame, path: str, checkpoint: str, every: str | None = WORDS_EVERY) -> StreamingQuery:
    """Counts of each batch on its own, nothing carried over."""
    return start_batches(lines, lambda batch, i: append_batch(word_count(batch), path, i), checkpoint, every)


def start_running_word_count(lines: DataFrame, path: str, checkpoint: str,
                             every: str | None = WORDS_EVERY) -> StreamingQuery:
    """Counts since the start, changed words only."""
    return start_batches(word_count(lines), lambda batch, i: append_batch(batch, path, i), checkpoint, every, "update")


def batch_counts(spark: SparkSession, path: str) -> DataFrame:
    return read_log(spark, path, WORD_LOG)


def running_counts(spark: SparkSession, path: str) -> DataFrame:
    return batch_counts(spark, path).groupBy("word").agg(F.max("n").alias("n"))
