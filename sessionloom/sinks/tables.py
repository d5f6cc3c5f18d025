"""Parquet tables: dimensions and facts."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..operators.dims import new_dimension_rows
from ..session import written_once
from .folders import Folders

# seconds after which a writer that claimed numbers and stored none is taken for gone
CLAIM_AGE = 3600


class ClaimedByAnother(RuntimeError):
    """Another job is giving out the same ids."""


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" in str(err):
            return spark.createDataFrame([], schema)
        raise


def claim_ids(spark: SparkSession, path: str, top: int) -> None:
    """Reserve the ids after ``top`` for this writer. Creating the claim's file succeeds once only.

    A claim that is there already means that another writer began from the same table: it has added rows since, or is
    about to. Only a claim of a writer that stored nothing for ``CLAIM_AGE`` is taken over.
    """
    folders, name = Folders(spark, path), f"_claims/after={top}"
    for _ in range(2):
        try:
            folders.write_text(name, f"{time.time():.0f} {uuid.uuid4().hex}", replace=False)
            return
        except Py4JJavaError as err:
            if "AlreadyExists" not in str(err.java_exception.getClass().getName()):
                raise
        begun = float((folders.read_text(name) or "0").split()[0])
        if time.time() - begun < CLAIM_AGE or _top(spark, path) != top:
            break
        folders.delete(name)
    raise ClaimedByAnother(f"ids after {top} of {path} are taken; run again")


def _top(spark: SparkSession, path: str) -> int:
    table = read_or_empty(spark, path, StructType([StructField("id", LongType())]))
    return table.agg(F.coalesce(F.max("id"), F.lit(0))).first()[0]


def refresh_dimension(spark: SparkSession, path: str, wanted: DataFrame, key: list[str]) -> DataFrame:
    """Append ids for unseen keys, if there are any, and return the table.

    Two jobs may try at once: the one that claims the next ids stores its rows, the other raises and can run again.
    """
    schema = StructType([StructField("id", LongType()), *[wanted.schema[c] for c in key]])
    top = _top(spark, path)
    existing = read_or_empty(spark, path, schema).filter(F.col("id") <= top)
    new = written_once(new_dimension_rows(existing, wanted, key, top))
    if not new.isEmpty():
        claim_ids(spark, path, top)
        new.write.mode("append").parquet(path)
    return read_or_empty(spark, path, schema)


def replace_folder(rows: DataFrame, path: str) -> None:
    """Overwrite one folder, also by nothing."""
    rows.write.mode("overwrite").parquet(path)


def replace_day(fact: DataFrame, base: str, date_id: int) -> None:
    """Overwrite the folder of one date id. Also an empty result clears the day, other days stay."""
    replace_folder(fact.drop("date_dimension_id"), f"{base}/date_dimension_id={date_id}")


def read_fact(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.parquet(base)
