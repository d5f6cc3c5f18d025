"""Bounded samples of labelled texts to fit classifiers on."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import fold

# remainder of the hold-out rule: rows of this fold are never learned from
FOLDS, HELD_FOLD = 5, 0


def held_out(key) -> "F.Column":
    return fold(key) % FOLDS == HELD_FOLD


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int | dict[int, int], key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """Columns text and label (0 or 1) of about ``per_class`` training rows a class, at most twice as many.

    ``per_class`` may differ by label. Rows of the held-out fold, and labels that are neither 0 nor 1, are left out.
    Within a class ids are taken by a hash at the rate that gives ``per_class``. The label rows are few, so documents are
    not shuffled but for those picked: of rows that share an id one stays, the one with the least text, so that the
    sample is bounded whatever ids repeat.
    """
    usable = labels.select(F.col(key), F.col(label).cast("int").alias("label")).filter(
        F.col("label").isin(0, 1) & F.col(key).isNotNull() & ~held_out(F.col(key))).distinct()
    counts = {r.label: r["count"] for r in usable.groupBy("label").count().collect()}
    spark, chosen = docs.sparkSession, []
    for value, n in sorted(counts.items()):
        most = per_class[value] if isinstance(per_class, dict) else per_class
        below = int(min(1.0, most / n) * (1 << 31))
        mine = usable.filter((F.col("label") == value) & (F.pmod(F.xxhash64(key), F.lit(1 << 31)) < below))
        chosen += mine.limit(2 * most).collect()
    picked = spark.createDataFrame(chosen, usable.schema)
    rows = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("text")).join(F.broadcast(picked), key)
    return rows.groupBy(key, "label").agg(F.min("text").alias("text")).select("text", "label")
