"""Near-duplicates by SimHash: fingerprints linked at a Hamming distance, found through vantage-point trees.

The 64 bits are divided into blocks of 16. Two fingerprints that differ in at most four bits differ in at most one
bit of at least one block, so one tree per block, searched for neighbours within one bit of that block, finds every
pair. In a tree each level has a vantage point and divides the fingerprints by their Hamming distance to it into
rings; a path of rings is a shard. By the triangle inequality a neighbour within one bit lies in the same or an
adjoining ring at every level, and as one bit moves every distance by exactly one, all other shards are pruned.
A fingerprint is stored in its own shard and also sent to the shards beyond the boundary. Within a shard, points
are ordered by their distance to a local vantage point, and only rings that the triangle inequality leaves are
compared, by all 64 bits. A shard answers with a forest of links, never with all its pairs.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import written_once
from .common import lookup_join
from .components import components

SHINGLE, SEED, DISTANCE = 4, 42, 4
BLOCKS, BLOCK_BITS, BLOCK_RADIUS = 4, 16, 1
# vantage points of a tree's levels, as bits of a block: eight patterns that differ in half of the bits or more
VANTAGE = (0x0000, 0x00FF, 0x0F0F, 0x3333, 0x5555, 0x7FFF, 0x035F, 0x6C1A)
RING_BITS = 5
# rows and columns of the distance matrix a task holds at once, and points up to which a shard is solved by offsets
TILE, SPAN, SMALL = 256, 1 << 14, 12
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of a text's word shingles, repeats counted; zero without words."""
    from xxhash import xxh64_intdigest

    words = _WORD.findall((text or "").encode().translate(_LOWER))
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    begins = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    ends = begins + lengths - 1
    n = max(len(words) - shingle + 1, 1)
    last = ends[shingle - 1:] if len(words) >= shingle else ends[-1:]
    counts, view = np.zeros(64, np.int64), memoryview(line)
    for at in range(0, n, 1 << 16):
        hashes = np.fromiter(
            (xxh64_intdigest(view[a:b], SEED) for a, b in
             zip(begins[at:min(at + (1 << 16), n)].tolist(), last[at:at + (1 << 16)].tolist())), np.uint64)
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint_column(text: Column) -> Column:
    """Fingerprints as signed longs with the same 64 bits."""

    @F.arrow_udf("long")
    def marks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts))
            yield pa.array(found.view(np.int64))

    return marks(text)


def _ring_path(block: int, bits: Column) -> Column:
    """A shard: the tree's block and the ring, which is the distance to the vantage point, at every level."""
    path = F.lit(block).cast("long")
    for v in VANTAGE:
        path = F.shiftleft(path, RING_BITS).bitwiseOR(F.bit_count(bits.bitwiseXOR(F.lit(v))).cast("long"))
    return path


def _tree_shards(mark: Column, block: int) -> Column:
    bits = F.shiftrightunsigned(mark, block * BLOCK_BITS).bitwiseAND(0xFFFF).cast("int")
    raised = F.filter(F.transform(F.array(*[F.lit(1 << i) for i in range(BLOCK_BITS)]),
                                  lambda b: bits.bitwiseOR(b)), lambda x: x != bits)
    entry = lambda x, visits: F.struct(_ring_path(block, x).alias("shard"), F.lit(visits).alias("visits"))
    return F.concat(F.array(entry(bits, False)), F.transform(raised, lambda x: entry(x, True)))


def _shards(mark: Column) -> Column:
    """Shards of a fingerprint in all trees: its own, and those across a boundary with one bit more in the block.

    Of two neighbours that differ in a bit of the block one has it clear, and that one visits the other's shard.
    """
    return F.concat(*[_tree_shards(mark, block) for block in range(BLOCKS)])


def close_links(marks: np.ndarray, owned: np.ndarray, distance: int = DISTANCE) -> list[tuple[int, int]]:
    """A forest over fingerprints within ``distance``: links of each to the one that reached it.

    Points stand in rings by distance to the first one. The search goes out from one point after another; what it
    reaches leaves the waiting points, so a dense group of any size costs little more than a look at each.
    Visitors alone need no comparison with each other, as their own shards hold them.
    """
    if not owned.any() or len(marks) < 2:
        return []
    rings = np.bitwise_count(marks ^ marks[0]).astype(np.int64)
    order = np.argsort(rings, kind="stable")
    waiting, rings, own = marks[order], rings[order], owned[order]
    links = []
    while len(waiting) > 1:
        front, front_ring, front_own = waiting[:1], rings[:1], own[:1]
        waiting, rings, own = waiting[1:], rings[1:], own[1:]
        while len(front) and len(waiting):
            tile, tile_ring = front[:TILE], front_ring[:TILE]
            tile_own, front, front_ring, front_own = front_own[:TILE], front[TILE:], front_ring[TILE:], front_own[TILE:]
            low = np.searchsorted(rings, tile_ring.min() - distance)
            high = np.searchsorted(rings, tile_ring.max() + distance, side="right")
            reached = []
            for at in range(low, high, SPAN):
                span = slice(at, min(at + SPAN, high))
                hit = np.bitwise_count(tile[:, None] ^ waiting[None, span]) <= distance
                hit &= tile_own[:, None] | own[None, span]
                to = np.flatnonzero(hit.any(0))
                links += zip(tile[hit[:, to].argmax(0)].tolist(), waiting[at + to].tolist())
                reached.append(at + to)
            at = np.concatenate(reached) if reached else np.zeros(0, np.int64)
            if len(at):
                front = np.concatenate((front, waiting[at]))
                front_ring = np.concatenate((front_ring, rings[at]))
                front_own = np.concatenate((front_own, own[at]))
                keep = np.ones(len(waiting), bool)
                keep[at] = False
                waiting, rings, own = waiting[keep], rings[keep], own[keep]
    return links


def _small_links(shard: np.ndarray, marks: np.ndarray, owned: np.ndarray, distance: int):
    """Pairs of many small shards at once: every point meets those that follow it in its shard, by offset."""
    a, b = [marks[:0]], [marks[:0]]
    for step in range(1, len(marks)):
        at = np.flatnonzero((shard[step:] == shard[:-step]) & (owned[step:] | owned[:-step]))
        if not len(at) and not (shard[step:] == shard[:-step]).any():
            break
        at = at[np.bitwise_count(marks[at] ^ marks[at + step]) <= distance]
        a.append(marks[at])
        b.append(marks[at + step])
    return np.concatenate(a), np.concatenate(b)


def _shard_links(marks: np.ndarray, owned: np.ndarray, distance: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of one shard: by one matrix of its own points with all while it is small, else by the search.

    A shard with more than a few links for each point is left to the search as well, which returns a forest.
    """
    own = np.flatnonzero(owned)
    if len(own) * len(marks) <= TILE * SPAN:
        a, b = np.nonzero(np.bitwise_count(marks[own][:, None] ^ marks[None, :]) <= distance)
        a = own[a]
        pick = (a < b) | (~owned[b])
        if pick.sum() <= 4 * len(marks):
            return marks[a[pick]], marks[b[pick]]
    links = close_links(marks, owned, distance)
    return tuple(np.array(x, np.uint64) for x in zip(*links)) if links else (marks[:0], marks[:0])


def link_fingerprints(marks: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """Stored links (a, b) between distinct fingerprints of column ``mark``: all pairs' components, not all pairs."""
    dealt = marks.select("mark", F.explode(_shards(F.col("mark"))).alias("s")).select("s.shard", "s.visits", "mark")
    dealt = dealt.repartition("shard").sortWithinPartitions("shard")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def solve(shard: np.ndarray, mark: np.ndarray, owned: np.ndarray) -> pa.RecordBatch:
            begins = np.flatnonzero(np.concatenate(([True], shard[1:] != shard[:-1])))
            sizes = np.diff(np.append(begins, len(shard)))
            large = sizes > SMALL
            pick = np.repeat(~large, sizes)
            a, b = _small_links(shard[pick], mark[pick], owned[pick], distance)
            found = [(a, b)]
            for k in np.flatnonzero(large):
                part = slice(begins[k], begins[k] + sizes[k])
                found.append(_shard_links(mark[part], owned[part], distance))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([f[i] for f in found]).view(np.int64)) for i in (0, 1)], names=["a", "b"])

        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            shard = batch.column("shard").to_numpy()
            mark = batch.column("mark").to_numpy().view(np.uint64)
            owned = ~batch.column("visits").to_numpy(zero_copy_only=False)
            # the last shard of a batch may go on in the next one
            cut = int(np.searchsorted(shard, shard[-1]))
            held.append((shard[:cut], mark[:cut], owned[:cut]))
            if cut:
                yield solve(*(np.concatenate(x) for x in zip(*held)))
                held = []
            held.append((shard[cut:], mark[cut:], owned[cut:]))
        if sum(len(h[0]) for h in held):
            yield solve(*(np.concatenate(x) for x in zip(*held)))

    return dealt.mapInArrow(search, "a long, b long")


def _reached(marked: DataFrame, value: Column, distance: int) -> DataFrame:
    """Stored rows ``marked`` (mark and others) with the smallest ``value`` of each one's class as component.

    _shared is true; both are missing for a row that is alone in its class.
    """
    marks = written_once(marked.groupBy("mark").agg(F.min(value).alias("least"), F.count("*").alias("n")))
    roots = components(link_fingerprints(marks.select("mark"), distance))
    joined = marks.join(roots.withColumnRenamed("node", "mark"), "mark", "left").select(
        "mark", "least", "n", F.coalesce("root", "mark").alias("root"), F.col("root").isNotNull().alias("linked"))
    ids = joined.filter("linked").groupBy("root").agg(F.min("least").alias("component"))
    # only fingerprints of several rows or with links need a lookup; the rest are their own component
    shared = joined.filter("linked or n > 1").join(ids, "root", "left").select(
        "mark", F.coalesce("component", "least").alias("component"), F.lit(True).alias("_shared"))
    return lookup_join(marked, written_once(shared), "mark")


def clustered(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """Stored key, mark (fingerprint as long) and component (smallest key reachable) of every row of ``docs``.

    Texts without words have fingerprint zero and link like others. A missing key is larger than all others: it is
    a component's id only if no row of the component has one. Repeated rows are rows of the result too.
    """
    marked = written_once(docs.select(F.col(key).alias("key"), fingerprint_column(F.col(text)).alias("mark")))
    rows = _reached(marked, F.col("key"), distance)
    return rows.select("key", "mark", F.when(F.col("_shared"), F.col("component")).otherwise(F.col("key")).alias("component"))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", distance: int = DISTANCE) -> DataFrame:
    """One row of ``docs`` for each near-duplicate class: that with the smallest key, with all its columns.

    Rows are told apart by key and text: rows that share a key, or have none, are copies only if their texts are
    linked. Missing keys come last; rows of one class and key go by the hash of their texts.
    """
    hashed = F.xxhash64(F.coalesce(F.col(text), F.lit("")))
    marked = written_once(docs.select(
        F.col(key).alias("key"), fingerprint_column(F.col(text)).alias("mark"), hashed.alias("sum")))
    own = F.struct(F.col("key").isNull().alias("missing"), F.col("key").alias("key"), F.col("sum").alias("sum"))
    shared = _reached(marked, own, distance).filter("_shared")
    first = F.col("key").eqNullSafe(F.col("component.key")) & (F.col("sum") == F.col("component.sum"))
    gone = written_once(shared.filter(~first).select(F.col("key").alias("_key"), F.col("sum").alias("_sum")).distinct())
    left = docs.withColumn("_text_sum", hashed)
    left = left.join(gone, left[key].eqNullSafe(gone["_key"]) & (left["_text_sum"] == gone["_sum"]), "left_anti")
    # only a table that repeats a row's key and text needs a look for such rows
    repeated = marked.groupBy("key", "sum").count().filter("count > 1").limit(1).count()
    return (left.dropDuplicates([key, "_text_sum"]) if repeated else left).drop("_text_sum")


def hex_mark(mark: Column) -> Column:
    return F.lower(F.lpad(F.hex(mark), 16, "0"))
