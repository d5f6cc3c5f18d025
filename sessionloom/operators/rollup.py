"""Distinct users and sessions over several roll-up levels at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schemas import ALL

SUMS = ["n_launch", "n_view", "n_bp"]


# which dimensions a row is rolled up over, as bits; part of every key, so that a data value that reads
# like the label of a total stays a group of its own
LEVEL = "level"


def _labels(dims: Sequence[str], level: Sequence[str]) -> Column:
    """Dimensions of a level, the others as ``all``; NULL stays NULL and never turns into the label."""
    bits = sum(1 << k for k, c in enumerate(reversed(dims)) if c not in level)
    return F.struct(*[(F.col(c) if c in level else F.lit(ALL)).cast("string").alias(c) for c in dims],
                    F.lit(bits).alias(LEVEL))


def fan_out(df: DataFrame, dims: Sequence[str], levels: Sequence[Sequence[str]]) -> DataFrame:
    """One copy of each row per level, dimensions outside the level labelled ``all``, with ``level``."""
    copies = F.array(*[_labels(dims, level) for level in levels])
    others = [c for c in df.columns if c not in dims]
    return df.select(*others, F.explode(copies).alias("_level")).select(*others, "_level.*")


def member_rollup(grain: DataFrame, dims: Sequence[str], levels: Sequence[Sequence[str]]) -> DataFrame:
    """Per (dt, level labels): users, sessions, one-event sessions and event sums.

    A row of ``grain`` speaks for one user and one session, so it is split into a
    user row and a session row (the session row carries the counts). Then:

    1. combine per place and member, so that a member shared by very many rows
       (for instance a missing session id) becomes a handful of rows;
    2. bring the rows of one member of one day together;
    3. a member seen in one place only, as most are, counts once on every level:
       it is left whole. Members of several places are copied to the levels and
       combined. This needs no shuffle, because the labels only refine
       (dt, kind, member);
    4. count members per label, and add the whole ones to every level at the very
       end, when only counts per place are left.

    NULL users or sessions group like any value and count as one member.
    """
    counts = ["n", *SUMS]
    zero = F.lit(0).cast("bigint")
    kinds = F.array(
        F.struct(F.lit("u").alias("kind"), F.col("uid").alias("member"), *[zero.alias(c) for c in counts]),
        F.struct(F.lit("s").alias("kind"), F.col("sid").alias("member"), *[F.col(c).alias(c) for c in counts]),
    )
    members = grain.select("dt", *dims, F.explode(kinds).alias("m")).select("dt", *dims, "m.*")
    sums = [F.sum(c).alias(c) for c in counts]
    placed = members.groupBy("dt", *dims, "kind", "member").agg(*sums)
    one_day = Window.partitionBy("dt", "kind", "member")
    together = placed.withColumn("whole", F.count("*").over(one_day) == 1)

    every = F.array(*[_labels(dims, level) for level in levels])
    itself = F.array(_labels(dims, dims))
    copies = F.explode(F.when(F.col("whole"), itself).otherwise(every)).alias("_level")
    labelled = together.select("dt", "kind", "member", "whole", *counts, copies).select(
        "dt", "kind", "member", "whole", *counts, "_level.*"
    )
    once = labelled.groupBy("dt", "kind", "member", "whole", *dims, LEVEL).agg(*sums)
    session = F.col("kind") == "s"
    counted = once.groupBy("dt", "whole", *dims, LEVEL).agg(
        F.count_if(F.col("kind") == "u").alias("users"),
        F.count_if(session).alias("sessions"),
        F.count_if(session & (F.col("n") == 1)).alias("bounces"),
        *[F.sum(c).alias(c) for c in SUMS],
    )
    kept = F.array(F.struct(*dims, LEVEL))
    final = F.explode(F.when(F.col("whole"), every).otherwise(kept)).alias("_level")
    totals = ["users", "sessions", "bounces", *SUMS]
    return counted.select("dt", *totals, final).select("dt", *totals, "_level.*").groupBy("dt", *dims, LEVEL).agg(
        *[F.sum(c).alias(c) for c in totals]
    )
