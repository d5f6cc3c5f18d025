"""The pipe separated file of address ranges and their regions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.text import split_trimmed
from ..operators.regions import check_rules

# --- fixed values: positions in a rule line -----------------------------------
START, END, COUNTRY, PROVINCE, CITY = 2, 3, 5, 6, 7
# ------------------------------------------------------------------------------


def rule_columns(lines: DataFrame, value: str = "value") -> DataFrame:
    f = split_trimmed(F.col(value), "|")
    at = lambda i: F.get(f, F.lit(i))
    return lines.select(
        at(START).try_cast("bigint").alias("start_ip"),
        at(END).try_cast("bigint").alias("end_ip"),
        at(COUNTRY).alias("country"),
        at(PROVINCE).alias("province"),
        at(CITY).alias("city"),
    )


def read_ip_rules(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """Typed rules; incomplete or overlapping ones raise instead of giving wrong regions."""
    rules = rule_columns(spark.read.text(path))
    if check:
        check_rules(rules)
    return rules
