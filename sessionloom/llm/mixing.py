"""Mixing sources to target weights by nested hash thresholds.

Every row has a fixed place between 0 and 2**60, the head of its key's MD5. A source's budget is met by a
threshold: rows placed below it are taken. A smaller budget takes a subset of what a larger one takes. To find the
thresholds, sizes are summed per source and 4096 places, then only the place where a budget runs out is cut into
4096 again, until it holds a single value. Rows are never sorted; a level costs one pass over (source, place, size).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import written_once
from .common import lookup_join, space_words

PLACE_BITS, LEVEL_BITS = 60, 12


def place(key: Column) -> Column:
    """Place of a key on the hash line; keys are compared by their text, a missing one as empty text."""
    return F.conv(F.substring(F.md5(F.coalesce(key.cast("string"), F.lit(""))), 1, PLACE_BITS // 4), 16, 10).cast("long")


def word_size(text: Column) -> Column:
    return F.size(space_words(text)).cast("long")


def source_targets(sources: DataFrame, share: float, most: float, weights: tuple[int, ...]) -> DataFrame:
    """Targets of ``sources`` (source, source_size): weights by code point order, nulls last, repeating.

    Together they come to ``share`` of all sizes. A target stops at ``most`` times its source's size and the excess
    goes to the others by weight. The level at which that settles is found by the order in which sources fill up.
    The windows run over one row per source.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    ranked = sources.withColumn("weight", weight.cast("double")).withColumn("cap", most * F.col("source_size"))
    every = Window.partitionBy()
    filling = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    after = filling.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    # if the sources before this one are full, the level of the others; the first that stays below its cap decides
    level = (F.lit(share) * F.sum("source_size").over(every)
             - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    levels = ranked.withColumn("level", level)
    settled = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(
        (F.col("cap") / F.col("weight")).alias("full"), "level"))).over(every)["level"]
    return levels.withColumn("settled", settled).select("source", "source_size", F.coalesce(
        F.least("cap", F.col("settled") * F.col("weight")), F.col("cap")).alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Stored thresholds per source: source_key, source, source_size, target, rounds (whole passes), edge.

    ``sized`` has source_key (never null), place and size. Rows placed below the edge are taken once more than
    ``rounds``. At the edge lies one value; whether its rows are taken is what comes closer to the target.
    """
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    state = targets.withColumn("rounds", rounds.cast("long")).withColumn(
        "budget", F.col("target") - F.col("rounds") * F.col("source_size"))
    state = written_once(state.withColumn("prefix", F.lit(0).cast("long")).withColumn("before", F.lit(0).cast("long")))
    shift = PLACE_BITS
    while shift > 0:
        low = state.select("source_key", "prefix", "before", "budget")
        inside = lookup_join(sized, low, "source_key", "inner", 256).filter(
            F.expr(f"shiftright(place, {shift})") == F.col("prefix"))
        shift -= LEVEL_BITS
        buckets = inside.groupBy("source_key", F.expr(f"shiftright(place, {shift})").alias("bucket")).agg(
            F.first("before").alias("before"), F.first("budget").alias("budget"), F.sum("size").alias("sum"),
            F.min("place").alias("least"), F.max("place").alias("most"))
        order = Window.partitionBy("source_key").orderBy("bucket")
        upto = F.col("before") + F.sum("sum").over(order)
        edges = buckets.withColumn("upto", upto).filter(F.col("upto") > F.col("budget")).groupBy("source_key").agg(
            F.min(F.struct("bucket", "upto", "sum", "least", "most")).alias("e"))
        state = written_once(state.select("source_key", "source", "source_size", "target", "rounds", "budget").join(
            edges, "source_key", "left").select(
            "source_key", "source", "source_size", "target", "rounds", "budget", F.col("e.bucket").alias("prefix"),
            (F.col("e.upto") - F.col("e.sum")).alias("before"), "e.sum", "e.least", "e.most"))
        if not state.filter("least < most").limit(1).count():
            break
    take_edge = (F.col("before") + F.col("sum") - F.col("budget")) <= (F.col("budget") - F.col("before"))
    edge = F.when(F.col("least").isNotNull(), F.col("least") + take_edge.cast("long")).otherwise(0)
    return written_once(state.select("source_key", "source", "source_size", "target", "rounds", edge.alias("edge")))


def sized_rows(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """Stored key, source, source_key (never null), place and size of every row; no text."""
    return written_once(docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), source_key(F.col(source)).alias("source_key"),
        place(F.col(key)).alias("place"), word_size(F.col(text)).alias("size")))


def source_key(source: Column) -> Column:
    return F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source.cast("string")))


def mix_plan(sized: DataFrame, share: float = 1.5, most: float = 2.0, weights: tuple[int, ...] = (5, 2, 1)) -> DataFrame:
    """Thresholds for ``sized`` rows: budgets by ``weights`` over ``share`` of all sizes, at most ``most`` passes."""
    sources = sized.groupBy("source_key", "source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sources, share, most, weights)
    return thresholds(sized, targets.withColumn("source_key", source_key(F.col("source"))))


def copies() -> Column:
    """How often a row joined to its source's threshold is taken; columns place, rounds and edge."""
    return F.col("rounds") + (F.col("place") < F.col("edge")).cast("long")


def with_taken(sized: DataFrame, plan: DataFrame) -> DataFrame:
    """Every sized row with source_size, target, copies and taken (size times copies)."""
    rows = lookup_join(sized, plan.drop("source"), "source_key", "inner", 256)
    return rows.withColumn("copies", copies()).withColumn("taken", F.col("size") * F.col("copies"))


def mixed(docs: DataFrame, key: str = "doc_id", source: str = "source", text: str = "text", **shares) -> DataFrame:
    """``docs`` as often as the mix takes each row, with the pass as column ``epoch`` (1, 2, ...).

    A missing or empty text has size 0: it moves no budget, and is taken by the same threshold as others. A
    missing source is a source of its own, after all others. Rows that share a key share a place, so all or none
    of them are in a pass. An empty table mixes to an empty one; a column ``epoch`` of the input is replaced.
    """
    plan = mix_plan(sized_rows(docs, key, source, text), **shares)
    rows = docs.select(F.struct(*[c for c in docs.columns if c != "epoch"]).alias("row"),
                       source_key(F.col(source)).alias("source_key"), place(F.col(key)).alias("place"))
    edges = plan.select("source_key", "rounds", "edge")
    taken = lookup_join(rows, edges, "source_key", "inner", 256).filter(copies() > 0)
    return taken.select("row", F.explode(F.sequence(F.lit(1), copies().cast("int"))).alias("epoch")).select(
        "row.*", "epoch")
