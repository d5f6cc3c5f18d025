"""Which region an address belongs to: a left range join against disjoint rules."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window, functions as F

from ..schemas import REGION_COLUMNS, UNKNOWN
from ..session import written_once

SLICE_BITS = 16
MAX_IP = (1 << 32) - 1
# most bytes of rule slices that are broadcast, and what a slice takes besides its texts
BROADCAST_BYTES, SLICE_BYTES = 64 << 20, 96
HOT_SHARE = 1_000
# copies of each slice that meet the rows of a stream, against hot addresses
SALTS = 16


def slice_rules(rules: DataFrame) -> DataFrame:
    """One row per rule and /16 slice it touches, so that the range join gets an equality key.

    Disjoint rules give at most (rules + 65,536) rows, however wide they are.
    """
    return rules.withColumn(
        "ip_slice",
        F.explode(F.sequence(F.shiftright("start_ip", SLICE_BITS), F.shiftright("end_ip", SLICE_BITS))),
    )


def slice_bytes(rules: DataFrame) -> int:
    """Generous bytes of all slices, by arithmetic on the rules."""
    touched = F.shiftright("end_ip", SLICE_BITS) - F.shiftright("start_ip", SLICE_BITS) + 1
    texts = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in REGION_COLUMNS), F.lit(SLICE_BYTES))
    return rules.agg(F.sum(touched * texts).alias("n")).first()["n"] or 0


def check_rules(rules: DataFrame) -> None:
    """Raise unless every rule is complete, within IPv4 and disjoint from the others.

    Two overlapping rules share a slice, so neighbours are compared per slice.
    """
    broken = rules.filter(
        F.col("start_ip").isNull() | F.col("end_ip").isNull()
        | (F.col("start_ip") < 0) | (F.col("start_ip") > F.col("end_ip")) | (F.col("end_ip") > MAX_IP)
    )
    if not broken.isEmpty():
        raise ValueError(f"unusable ip rule: {broken.first()}")
    order = Window.partitionBy("ip_slice").orderBy("start_ip", "end_ip")
    overlap = slice_rules(rules).withColumn("before", F.lag("end_ip").over(order)).filter("before >= start_ip")
    if not overlap.isEmpty():
        raise ValueError(f"overlapping ip rules at {overlap.first()}")


@dataclass
class RegionRules:
    """Rules ready for many look-ups: their slices and the bytes of these."""

    slices: DataFrame
    bytes: int


def _slices(rules: DataFrame) -> DataFrame:
    return slice_rules(rules).select(
        "ip_slice", "start_ip", "end_ip", *[F.col(c).alias("rule_" + c) for c in REGION_COLUMNS]
    )


def region_rules(rules: DataFrame) -> RegionRules:
    """Slices stored once, for the micro-batches of a stream."""
    return RegionRules(written_once(_slices(rules)), slice_bytes(rules))


def resolve_regions(
    events: DataFrame,
    rules: DataFrame | RegionRules,
    ip_num: str = "ip_num",
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Add country, province, city; columns already set in ``events`` win, misses are ``unknown``.

    The bytes of the slices are measured first. Up to ``broadcast_bytes`` they are broadcast and events are not shuffled
    at all. Beyond it distinct addresses are looked up (``_resolve_by_shuffle``), in a batch as in the micro-batches of a
    ``foreachBatch``; rows of a streaming plan, which can be read only once, meet salted copies of the slices. The answer is the same.
    """
    known = rules if isinstance(rules, RegionRules) else RegionRules(_slices(rules), slice_bytes(rules))
    if known.bytes <= broadcast_bytes:
        joined = _range_join(events, F.broadcast(known.slices), ip_num)
    elif events.isStreaming:
        joined = _resolve_salted(events, known.slices, ip_num)
    else:
        joined = _resolve_by_shuffle(events, known.slices, ip_num)
    given = set(events.columns)
    regions = [
        F.coalesce(*([F.col(c)] if c in given else []), F.col("rule_" + c), F.lit(UNKNOWN)).alias(c)
        for c in REGION_COLUMNS
    ]
    return joined.select(*[c for c in events.columns if c not in REGION_COLUMNS], *regions)


def _range_join(left: DataFrame, slices: DataFrame, ip_num: str, *more: str) -> DataFrame:
    ip = F.col(ip_num)
    same = (F.shiftright(ip, SLICE_BITS) == F.col("ip_slice")) & ip.between(F.col("start_ip"), F.col("end_ip"))
    for c in more:
        same &= F.col(c) == F.col("s" + c)
    return left.join(slices, same, "left").drop("ip_slice", "start_ip", "end_ip", *more, *["s" + c for c in more])


def _resolve_salted(events: DataFrame, slices: DataFrame, ip_num: str) -> DataFrame:
    """Join of a stream with all slices, dealt out by slice and salt, so that a hot address spreads over ``SALTS`` tasks."""
    salted = events.withColumn("_salt", F.pmod(F.xxhash64(*[c for c, kind in events.dtypes if not kind.startswith("map")]),
                                               F.lit(SALTS)).cast("int"))
    copies = slices.withColumn("s_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return _range_join(salted, copies, ip_num, "_salt")


def _resolve_by_shuffle(events: DataFrame, slices: DataFrame, ip_num: str) -> DataFrame:
    """Range join for rule sets too large to broadcast, safe for hot addresses.

    Distinct addresses are counted (combined before the shuffle) and only they
    meet the rules: a slice holds at most 65,536 of them. Addresses with more than
    1/1000 of all rows, fewer than 1000 by arithmetic, come back by broadcast, so
    their rows are not shuffled; the rest by an equality join in which no key is
    large. The counts and the located addresses are written once; ``events`` is
    read three times, so give a stored table where reading it is costly.
    """
    counted = written_once(events.groupBy(F.col(ip_num).alias("known_ip")).agg(F.count("*").alias("ip_rows")))
    total = counted.agg(F.sum("ip_rows").alias("n")).first()["n"] or 0
    located = written_once(
        _range_join(counted, slices, "known_ip")
        .withColumn("hot", F.col("ip_rows") * HOT_SHARE > F.lit(total))
        .drop("ip_rows")
    )
    hot = F.broadcast(located.filter("hot").drop("hot"))
    cold = located.filter("NOT hot").drop("hot")
    same = F.col(ip_num).eqNullSafe(F.col("known_ip"))
    from_hot = events.join(hot, same, "inner").drop("known_ip")
    rest = events.join(hot.select("known_ip"), same, "left_anti")
    from_cold = rest.join(cold, same, "inner").drop("known_ip")
    return from_hot.unionByName(from_cold)
