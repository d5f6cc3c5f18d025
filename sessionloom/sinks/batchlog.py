"""A log of upserts written by micro-batches, with compaction.

``deltas/batch_id=N`` holds what batch N changed. ``base/upto=N`` holds the state
after batch N. A batch that is replayed overwrites its own folder, so nothing
counts twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from .tables import read_or_empty


def append_batch(df: DataFrame, path: str, batch_id: int, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/deltas/batch_id={batch_id}")


def _committed_bases(spark: SparkSession, path: str) -> list[int]:
    """Batch numbers of the finished compactions; the folder names only, not the data."""
    root = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/base")
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/base/upto=*/_SUCCESS"))
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)


def read_log(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of the newest base and of all batches after it, with ``batch_id``."""
    wide = StructType(list(schema.fields)).add("batch_id", "long")
    bases = _committed_bases(spark, path)
    upto = bases[-1] if bases else -1
    deltas = read_or_empty(spark, f"{path}/deltas", wide).filter(F.col("batch_id") > upto)
    if not bases:
        return deltas
    base = spark.read.schema(schema).parquet(f"{path}/base/upto={upto}")
    return base.withColumn("batch_id", F.lit(upto).cast("bigint")).unionByName(deltas)


def compact(
    spark: SparkSession,
    path: str,
    schema: StructType,
    upto: int,
    latest: Callable[[DataFrame], DataFrame],
    partition_by: list[str] | None = None,
) -> None:
    """Write the state after batch ``upto`` as a new base; old folders are left for clean-up by age.

    A base that is there already is left alone: a replayed batch would read what it overwrites.
    """
    if upto in _committed_bases(spark, path):
        return
    rows = latest(read_log(spark, path, schema).filter(F.col("batch_id") <= upto)).select(*schema.names)
    writer = rows.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{path}/base/upto={upto}")
