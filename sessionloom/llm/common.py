"""Helpers the training-text operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import written_once

# most bytes of a table that may be broadcast
BROADCAST_BYTES = 32 << 20
# copies of a lookup table too large to broadcast, against keys that hold a third of all rows
SALTS = 32
# the six white-space characters that separate words
SPACES = " \t\n\x0b\f\r"
_SPACE_RUN = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def space_words(text: Column) -> Column:
    """Words between runs of ASCII white space; none for a missing text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, _SPACE_RUN))


def lower_ascii(text: Column) -> Column:
    """Only A to Z become small, so the result does not hang on Unicode tables."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def fold(column: Column) -> Column:
    """Remainder source of the fixed hold-out rules: CRC-32 of a key's text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")))


def row_bytes(df: DataFrame) -> int:
    """Generous bytes of a row of fixed-width columns."""
    return 24 + 24 * len(df.columns)


def small_enough(stored: DataFrame, bytes_per_row: int | None = None) -> bool:
    """Whether a stored table's counted rows stay under the broadcast bound."""
    most = BROADCAST_BYTES // (bytes_per_row or row_bytes(stored))
    return stored.limit(most + 1).count() <= most


def lookup_join(rows: DataFrame, lookup: DataFrame, keys: str | list[str], how: str = "left",
                bytes_per_row: int | None = None) -> DataFrame:
    """``rows`` with the columns of a stored ``lookup`` that has one row per non-null key.

    A lookup counted under the bound is broadcast. Beyond it, both sides are salted so that a hot key
    spreads over many tasks; the result is the same.
    """
    keys = [keys] if isinstance(keys, str) else keys
    if small_enough(lookup, bytes_per_row):
        return rows.join(F.broadcast(lookup), keys, how)
    salted = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)).cast("int"))
    return dealt.join(salted, [*keys, "_salt"], how).drop("_salt")


def hashes_of(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value worked out once, however often the body names it."""
    return F.transform(F.array(value), body)[0]


def window_hashes(hashes: Column, k: int) -> Column:
    """Hash of every ``k`` consecutive elements of an array of hashes; empty if there are fewer."""
    return let(hashes, lambda h: F.slice(
        F.transform(h, lambda x, i: F.xxhash64(x, *[F.get(h, i + d) for d in range(1, k)])),
        1, F.greatest(F.size(h) - (k - 1), F.lit(0))))


# rows that one step of ``repeated`` makes of one row
_FAN = 1 << 12


def repeated(rows: DataFrame, times: str) -> DataFrame:
    """Every row as often as its column ``times`` says, without the column.

    In two steps: a row first becomes one for each ``_FAN`` copies, and these are dealt out by number before the second
    step, so a row that stands for a third of a table is not written by one task. Rows of few copies stay where they are.
    """
    rows = written_once(rows)
    steps = F.ceil(F.col(times) / _FAN)
    few = rows.filter(F.col(times).between(1, _FAN)).withColumn("_copies", F.col(times))
    many = rows.filter(F.col(times) > _FAN).withColumn("_step", F.explode(F.sequence(F.lit(1).cast("long"), steps)))
    left = F.least(F.lit(_FAN).cast("long"), F.col(times) - (F.col("_step") - 1) * _FAN)
    dealt = many.withColumn("_copies", left).repartition("_step").drop("_step")
    both = few.unionByName(dealt)
    return both.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), "_copies"))).drop("_copy", "_copies", times)
