"""Words and how often they occur."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import words


def word_count(lines: DataFrame, text: str = "value") -> DataFrame:
    return lines.select(F.explode(words(F.col(text))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
