"""Tables of a relational store, read in parallel ranges and written in batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(url: str, table: str, user: str | None = None, password: str | None = None,
                 driver: str | None = None, batch_size: int = 10_000) -> dict[str, str]:
    named = {"user": user, "password": password, "driver": driver}
    return {
        "url": url,
        "dbtable": table,
        "batchsize": str(batch_size),
        # each task commits once or rolls back
        "isolationLevel": "READ_COMMITTED",
        **{k: v for k, v in named.items() if v is not None},
    }


def range_options(column: str, low: int, high: int, partitions: int) -> dict[str, str]:
    return {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
    }


def read_table(spark: SparkSession, options: dict[str, str], ranges: dict[str, str] | None = None) -> DataFrame:
    return spark.read.format("jdbc").options(**options, **(ranges or {})).load()


def write_table(df: DataFrame, options: dict[str, str], mode: str = "append") -> None:
    df.write.format("jdbc").options(**options).mode(mode).save()
