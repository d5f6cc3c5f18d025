"""Hard negatives of anchor vectors: rows of another label that score close below a positive.

A vector is cut into segments of equal width. Each segment is summed up by its mean and by its deviation, the length of
what is left without the mean. The inner product of two segments lies within ``width * mean * mean`` plus or minus
``deviation * deviation`` (Cauchy and Schwarz), so sums over the segments bound a score from both sides. Pairs that
a bound cannot decide are looked at again with narrower segments; only those left after the narrowest are multiplied
out. All anchors meet all rows, in blocks of bounded size: one block of each, in one task.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..session import written_once

# every so many-th row is an anchor; the labels of every so many-th row are moved on by one of so many
ANCHOR_EVERY, MOVED_EVERY, LABELS = 100, 7, 10
SCALE = 256
POSITIVES, NEGATIVES = 5, 10
# percent of a positive's score between which a negative's lies
LEAST_PERCENT, MOST_PERCENT = 30, 90
# segments of a vector, coarse to fine
SEGMENTS = (1, 4, 16)
# rows of a block at most and, if every core has one, at least; anchors of a block, and rows looked at together
MOST_ROWS, LEAST_ROWS, BLOCK_ANCHORS, TILE = 1 << 16, 1 << 12, 1 << 10, 1 << 11
# room for rounding of the bounds, as a share of the vectors' lengths
ROUNDING = 1e-9
# sums below are exact as doubles
EXACT = 2.0 ** 53
_PAIR = "anchor_id long, positive_id long, positive_score long"
_FOUND = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"
# of a pair of blocks: the vectors' width and the numbers of both
_BLOCKS = ["width", "ka", "kb"]


def prepared(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Columns id, label, v (array of long) and width of the rows that take part, one for each id.

    Left out: a missing id, label or vector, and a missing or non-finite component. Labels of every ``MOVED_EVERY``-th
    id are moved on by one; components become ``floor(256 x)``. Of rows that share an id the least (label, vector) stays.
    """
    x = F.transform(F.col(vector), lambda c: c.cast("double"))
    finite = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    moved = F.when(F.col(id) % MOVED_EVERY == 0, (F.col(label) + 1) % LABELS).otherwise(F.col(label))
    usable = rows.filter(F.col(id).isNotNull() & F.col(label).isNotNull() & F.col(vector).isNotNull() & finite)
    one = usable.groupBy(F.col(id).cast("long").alias("id")).agg(F.min(F.struct(
        moved.cast("long").alias("label"), F.transform(x, lambda c: F.floor(c * SCALE).cast("long")).alias("v"))).alias("r"))
    return one.select("id", "r.*", F.size("r.v").alias("width"))


class Summary:
    """Means and deviations of the segments of vectors, for every number of segments."""

    def __init__(self, vectors: np.ndarray):
        n, width = vectors.shape
        self.parts = []
        self.length = np.sqrt((vectors ** 2).sum(1))
        for k in dict.fromkeys(min(s, max(width, 1)) for s in SEGMENTS):
            bounds = np.linspace(0, width, k + 1).astype(int)[:-1]
            sizes = np.diff(np.append(bounds, width))
            if not width:
                continue
            means = np.add.reduceat(vectors, bounds, axis=1) / sizes
            squares = np.add.reduceat((vectors - np.repeat(means, sizes, axis=1)) ** 2, bounds, axis=1)
            # the root of the width goes into the means, so a bound is two plain products
            self.parts.append((means * np.sqrt(sizes), np.sqrt(squares)))


def bounds(a: Summary, b: Summary, level: int, x: np.ndarray | None = None, y: np.ndarray | None = None):
    """Lowest and highest scores of all pairs of ``a`` and ``b``, or of the pairs ``x`` and ``y`` alone."""
    (am, ad), (bm, bd) = a.parts[level], b.parts[level]
    if x is None:
        middle, spread = am @ bm.T, ad @ bd.T
        spread += ROUNDING * np.outer(a.length, b.length) + ROUNDING
    else:
        middle, spread = np.einsum("ij,ij->i", am[x], bm[y]), np.einsum("ij,ij->i", ad[x], bd[y])
        spread += ROUNDING * a.length[x] * b.length[y] + ROUNDING
    return middle - spread, middle + spread


class Scorer:
    """Exact scores of pairs of a block of anchors and a tile of rows, and which pairs are worth it."""

    def __init__(self, anchors: np.ndarray):
        self.whole, self.vectors, self.summary = anchors, anchors.astype(float), Summary(anchors.astype(float))
        self.most = self.summary.length.max(initial=0)

    def tile(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, Summary]:
        as_float = rows.astype(float)
        return rows, as_float, Summary(as_float)

    def undecided(self, tile, wanted: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (anchor, row) of ``wanted`` whose score may lie within low and high of their anchor."""
        summary = tile[2]
        x, y = np.nonzero(wanted)
        for level in range(len(self.summary.parts)):
            if 4 * len(x) > wanted.size:
                least, most = (b[x, y] for b in bounds(self.summary, summary, level))
            else:
                least, most = bounds(self.summary, summary, level, x, y)
            near = (most >= low[x]) & (least <= high[x])
            x, y = x[near], y[near]
        return x, y

    def scores(self, tile, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Inner products; of integers as doubles as long as these are exact, else of 64-bit integers."""
        rows, as_float, summary = tile
        exact = self.most * summary.length.max(initial=0) < EXACT
        left, right = (self.vectors, as_float) if exact else (self.whole, rows)
        if 8 * len(x) > len(left) * len(right):
            return (left @ right.T)[x, y].astype(np.int64)
        out = np.empty(len(x), np.int64)
        for at in range(0, len(x), 1 << 16):
            part = slice(at, at + (1 << 16))
            out[part] = (left[x[part]] * right[y[part]]).sum(1)
        return out


def _best(group: np.ndarray, score: np.ndarray, id: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` of each group, by score (highest first), then id."""
    order = np.lexsort((id, -score, group))
    begins = np.append(True, np.diff(group[order]) != 0) if len(order) else np.zeros(0, bool)
    rank = np.arange(len(order)) - np.maximum.accumulate(np.where(begins, np.arange(len(order)), 0))
    return order[rank < most]


class Best:
    """The first ``most`` (score, id) of every slot so far, and the score a further one has to reach."""

    def __init__(self, slots: int, most: int):
        self.most = most
        self.group, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.least = np.full(slots, -np.inf)

    def add(self, group: np.ndarray, score: np.ndarray, id: np.ndarray) -> None:
        if not len(group):
            return
        group, score, id = (np.concatenate(p) for p in ((self.group, group), (self.score, score), (self.id, id)))
        kept = _best(group, score, id, self.most)
        self.group, self.score, self.id = group[kept], score[kept], id[kept]
        full = np.bincount(self.group, minlength=len(self.least)) == self.most
        worst = np.full(len(self.least), np.inf)
        np.minimum.at(worst, self.group, self.score)
        self.least = np.where(full, worst, -np.inf)


def _columns(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, labels and vectors of a block."""
    table = table.combine_chunks()
    vectors = table.column("v").combine_chunks()
    flat = vectors.flatten().to_numpy(zero_copy_only=False) if len(table) else np.zeros(0, np.int64)
    width = len(flat) // len(table) if len(table) else 0
    return table.column("id").to_numpy(), table.column("label").to_numpy(), flat.reshape(len(table), width)


def _tiles(scorer: Scorer, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
    for at in range(0, len(ids), TILE):
        part = slice(at, at + TILE)
        yield ids[part], labels[part], scorer.tile(vectors[part])


def positives_of(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """Of one pair of blocks: each anchor's first other rows of its label."""
    a_ids, a_labels, a_vectors = _columns(anchors)
    scorer, best = Scorer(a_vectors), Best(len(a_ids), POSITIVES)
    for ids, labels, tile in _tiles(scorer, *_columns(rows)):
        wanted = (a_labels[:, None] == labels) & (a_ids[:, None] != ids)
        x, y = scorer.undecided(tile, wanted, best.least, np.full(len(a_ids), np.inf))
        best.add(x, scorer.scores(tile, x, y), ids[y])
    return pa.table({"anchor_id": a_ids[best.group], "positive_id": best.id, "positive_score": best.score})


def negatives_of(anchors: pa.Table, rows: pa.Table) -> pa.Table:
    """Of one pair of blocks: for each anchor and positive the first rows of other labels within its range of scores."""
    a_ids, a_labels, a_vectors = _columns(anchors)
    positives = [[(p["positive_id"], p["positive_score"]) for p in ps] for ps in anchors.column("positives").to_pylist()]
    # an anchor's slots, one for each positive; a missing one has an empty range
    score = np.zeros((len(a_ids), POSITIVES), np.int64)
    low, high = np.full(score.shape, np.inf), np.full(score.shape, -np.inf)
    for k, ps in enumerate(positives):
        for j, (_, p) in enumerate(ps):
            # whole numbers first: a score times a hundred may pass 64 bits
            score[k, j], low[k, j], high[k, j] = p, -(-LEAST_PERCENT * p // 100), MOST_PERCENT * p // 100
    scorer, best = Scorer(a_vectors), Best(score.size, NEGATIVES)
    for ids, labels, tile in _tiles(scorer, *_columns(rows)):
        open_low = np.maximum(low, best.least.reshape(low.shape))
        x, y = scorer.undecided(tile, a_labels[:, None] != labels, open_low.min(1), high.max(1))
        found = scorer.scores(tile, x, y)
        slots, scores, negatives = [], [], []
        for j in range(POSITIVES):
            fits = (found >= open_low[x, j]) & (found <= high[x, j])
            slots.append(x[fits] * POSITIVES + j)
            scores.append(found[fits])
            negatives.append(ids[y[fits]])
        best.add(np.concatenate(slots), np.concatenate(scores), np.concatenate(negatives))
    at, j = best.group // POSITIVES, best.group % POSITIVES
    return pa.table({
        "anchor_id": a_ids[at], "positive_id": pa.array([positives[k][i][0] for k, i in zip(at.tolist(), j.tolist())], pa.int64()),
        "negative_id": best.id, "positive_score": score[at, j], "negative_score": best.score})


def _met(anchors: DataFrame, rows: DataFrame, sizes: tuple[int, int],
         work: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``work`` on every block of anchors with every block of rows; a block's size is bounded, so is a task's."""
    a, b = sizes
    block = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("ka", block(a)).withColumn("kb", every(b))
    right = rows.withColumn("kb", block(b)).withColumn("ka", every(a))

    def pair(x: pa.Table, y: pa.Table) -> pa.Table:
        if len(x) and len(y):
            return work(x, y)
        return pa.table({f.split()[0]: pa.array([], pa.int64()) for f in schema.split(", ")})

    return left.groupBy(*_BLOCKS).cogroup(right.groupBy(*_BLOCKS)).applyInArrow(pair, schema)


def _first(found: DataFrame, group: list[str], score: str, id: str, most: int) -> DataFrame:
    """The first ``most`` rows of each group with their rank; tasks hand on as many at most."""
    order = Window.partitionBy(*group).orderBy(F.desc(score), id)
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= most)


def hard_negatives(rows: DataFrame, id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score of mined negatives.

    Anchors are the rows whose id is divisible by ``ANCHOR_EVERY``; ``prepared`` says which rows take part and how. An
    anchor's positives are its ``POSITIVES`` other rows of the same label with the highest integer inner products (ties:
    smaller id). A positive's negatives are the ``NEGATIVES`` rows of other labels that score highest within 30 to 90
    percent of it, ends included; a positive of negative score has none. All rows are compared, none is left out.

    Vectors of unequal width have no score, so they never meet; empty ones score zero. Inner products must fit 64 bits.
    Repeated ids count once. An empty table, one without anchors or with one label gives no rows. Other columns, whatever
    their names, are not looked at.
    """
    spark = rows.sparkSession
    usable = written_once(prepared(rows, id, vector, label))
    anchors = written_once(usable.filter(F.col("id") % ANCHOR_EVERY == 0))
    n, n_anchors = usable.count(), anchors.count()
    per_block = min(max(n // spark.sparkContext.defaultParallelism, LEAST_ROWS), MOST_ROWS)
    sizes = max(1, -(-n_anchors // BLOCK_ANCHORS)), max(1, -(-n // per_block))
    positives = written_once(_first(_met(anchors, usable, sizes, positives_of, _PAIR), ["anchor_id"], "positive_score",
                                    "positive_id", POSITIVES))
    # at most ``POSITIVES`` for each anchor
    lists = positives.groupBy(F.col("anchor_id").alias("id")).agg(
        F.collect_list(F.struct("positive_id", "positive_score")).alias("positives"))
    found = _met(anchors.join(lists, "id"), usable, sizes, negatives_of, _FOUND)
    ranked = _first(found, ["anchor_id", "positive_id"], "negative_score", "negative_id", NEGATIVES)
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
