"""A hashed maximum-entropy language model with class-factored softmax.

A token's probability is the product of choices on its way through classes, each a softmax over weights summed from
hashed features of the words before it: the last, the last two together, and the one before the last alone (a skip);
the tree below goes without the pair. Without any, it is the token's share of the training counts. The most frequent training tokens have two choices, a class
and the token within it. All others share one more class, which a tree divides further: as deep as the
number of distinct training tokens asks for. A leaf is a single token, or, for tokens too rare to be known to every task,
a bucket by their hash of some ``BUCKET`` tokens; there are as many buckets as those need, and within one a token
has its add-one share of the training counts, so the model covers every text.

Training makes one pass over all training texts in rounds. In a round every task follows the gradient over its texts
from the common weights, and the changes are averaged per weight row by how often each task met it. The number of weight
rows doubles with every fourfold of training tokens from ``GROWTH`` on, and so do the texts of a task, so that what tasks
send grows with the input.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..session import written_once
from .common import fold, repeated

FOLDS, HELD_FOLD = 7, 2
# a text's end; words hold no blank, so no word equals it
END = " "
CLASSES, PER_CLASS = 32, 64
# most tokens sent to every task, by training count; the rest is counted by a join
KNOWN = 1 << 17
# most branches of a node of the tree below the shared class, and rare tokens that share a leaf of it on average
FAN, BUCKET = 32, 64
# hash rows of each layer, up to so many training tokens
CLASS_ROWS, WORD_ROWS, TREE_ROWS, GROWTH = 1 << 12, 1 << 14, 1 << 15, 1 << 27
ROUNDS, BATCH, RATE = 2, 8192, 0.15
# features by which branches of the tree are chosen: the last word and the skip
TREE_FEATURES = [0, 2]
LARGEST, SHORT = 60.0, 20
# counts that a task holds before it adds them up
HELD = 1 << 19
# texts that a task learns from together, and most texts and bytes that are encoded together if these are more
LEARNT, TEXTS, PORTION = 64, 512, 4 << 20
# tokens that a training task should see at least, if there are that many for each core
TASK_TOKENS = 2_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def held_out(key: Column) -> Column:
    return fold(key) % FOLDS == HELD_FOLD


def portions(texts: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """Slices of texts and where they begin: one stretch of ``LEARNT`` texts or, while these are short, several."""
    sizes = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy().astype(np.int64))
    at = 0
    while at < len(texts):
        fit = np.searchsorted(sizes, PORTION + (sizes[at - 1] if at else 0), "right") - at
        count = max(min(int(fit), TEXTS) // LEARNT, 1) * LEARNT
        yield at, texts.slice(at, count)
        at += count


def split(texts: pa.Array | list[str | None]) -> pa.LargeListArray:
    """Words of every text in small ASCII letters, then an empty string for its end. Splits at just the six white-space characters."""
    if not isinstance(texts, pa.Array):
        texts = pa.array(texts, pa.large_string())
    texts = pc.ascii_trim_whitespace(texts.cast(pa.large_string()).fill_null(""))
    # a blank at the end of a text leaves an empty string behind it, and an empty text is one
    none, blank = pa.scalar("", texts.type), pa.scalar(" ", texts.type)
    texts = pc.if_else(pc.equal(texts, none), none, pc.binary_join_element_wise(texts, none, blank))
    # a new array by now: Arrow's ascii_lower garbles slices of others
    return pc.ascii_split_whitespace(pc.ascii_lower(texts))


def with_end(tokens: pa.Array) -> pa.Array:
    return pc.if_else(pc.equal(tokens, pa.scalar("", tokens.type)), pa.scalar(END, tokens.type), tokens)


def tokens_of(text: str | None) -> list[bytes]:
    """Words as UTF-8, then the end."""
    return [t.encode() for t in with_end(split([text]).flatten()).to_pylist()]


@dataclass
class Vocabulary:
    """What every task knows: counts of frequent tokens, totals, which tokens have classes, and the tree of the others.

    ``buckets`` holds the add-one mass of each bucket of the tokens that are not in ``counts``.
    """

    counts: dict[str, int]
    total: int
    distinct: int
    buckets: np.ndarray | None = None

    def __post_init__(self):
        order = sorted(self.counts, key=lambda t: (-self.counts[t], t))
        self.tokens = pa.array(["" if t == END else t for t in order], pa.large_string())
        self.logs = np.log10(np.array([self.counts[t] for t in order] + [0], float) + 1)
        self.classed = min(CLASSES * PER_CLASS, len(order))
        inside = sum(self.counts[t] for t in order[:self.classed])
        self.rest_total = self.total - inside
        # weight rows double with every fourfold of tokens
        self.growth = ((self.total // GROWTH).bit_length() + 1) // 2
        if self.buckets is None:
            beyond = self.total - sum(self.counts.values()) + self.distinct - len(order)
            self.buckets = np.array([beyond + 1.0])
        self.bucket_bits = len(self.buckets).bit_length() - 1
        self.bucket_logs = np.log10(self.buckets)
        self.single = len(order) - self.classed
        self._tree(np.concatenate([np.array([self.counts[t] for t in order[self.classed:]], float) + 1, self.buckets]))
        start = np.array([self.counts[t] for t in order[:self.classed]], float)
        per = np.zeros(CLASSES * PER_CLASS)
        per[:self.classed] = start
        # neighbours in the order of frequency share a class
        words = np.log((per + 0.1).reshape(CLASSES, PER_CLASS))
        words[:, :] -= np.log(np.exp(words).sum(1, keepdims=True))
        mass = np.append(per.reshape(CLASSES, PER_CLASS).sum(1), self.rest_total) + 0.5
        self.class_bias = np.log(mass / mass.sum()).astype(np.float32)
        self.word_bias = words.astype(np.float32)
        if self.classed < CLASSES * PER_CLASS:
            self.word_bias.reshape(-1)[self.classed:] = -30.0
            self.class_bias[-(-self.classed // PER_CLASS):CLASSES] = -30.0

    def _tree(self, mass: np.ndarray) -> None:
        """Numbers of the nodes of every level, leaves first, and the share of each branch in its node."""
        self.levels, shares, nodes = [], [], 0
        # as few levels as ``FAN`` allows, and then as few branches as these need
        deep = next(k for k in range(64) if FAN ** k >= len(mass))
        self.fan = next(k for k in range(1, FAN + 1) if k ** deep >= len(mass))
        while len(mass) > 1:
            mass = np.append(mass, np.zeros(-len(mass) % self.fan)).reshape(-1, self.fan)
            above = mass.sum(1)
            shares.append(np.where(mass > 0, np.log(np.maximum(mass, 0.1) / above[:, None]), -30.0))
            self.levels.append(nodes)
            nodes += len(mass)
            mass = above
        self.tree_bias = np.concatenate([np.zeros((0, self.fan)), *shares]).astype(np.float32)

    def leaves(self, ids: np.ndarray) -> np.ndarray:
        """Leaves of tokens without a class."""
        return np.where(ids < 0, self.single - 1 - ids, ids - self.classed)


def token_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Stored counts (token, c) of all training tokens; tasks hand on what they hold whenever it is many tokens."""
    train = docs.filter(~held_out(F.col(key))).select(F.coalesce(F.col(text), F.lit("")).alias("text"))

    def added(held: list[pa.Table]) -> pa.Table:
        return pa.concat_tables(held).group_by("token", use_threads=False).aggregate([("n", "sum")]).rename_columns(["token", "n"])

    def given(counts: pa.Table) -> Iterator[pa.RecordBatch]:
        for part in counts.to_batches(max_chunksize=HELD):
            tokens = with_end(part.column("token")).cast(pa.string())
            yield pa.RecordBatch.from_arrays([tokens, part.column("n")], names=["token", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, texts in portions(batch.column("text")):
                found = split(texts).flatten().value_counts()
                held.append(pa.table({"token": found.field("values"), "n": found.field("counts")}))
                size += len(found)
                if size > 2 * HELD:
                    held = [added(held)]
                    size = len(held[0])
                    if size > HELD:
                        yield from given(held[0])
                        held, size = [], 0
        if held:
            yield from given(added(held))

    return written_once(train.mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("c")))


def vocabulary(counts: DataFrame) -> tuple[Vocabulary, int]:
    """Totals, and the tokens above the count that at most ``KNOWN`` tokens reach; that count."""
    total, distinct = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    # counts by eighths of a doubling: some hundreds of rows at any size
    level = F.floor(F.log2("c") * 8).cast("int")
    sizes = counts.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.min("c").alias("least")).collect()
    kept, least = 0, (1 << 62)
    for row in sorted(sizes, key=lambda r: -r.level):
        if kept + row.n > KNOWN:
            break
        kept, least = kept + row.n, row.least
    known = {r.token: r.c for r in counts.filter(F.col("c") >= least).collect()} if kept else {}
    bits = ((distinct - kept) // BUCKET).bit_length()
    buckets = np.ones(1 << bits)
    bucket = F.shiftrightunsigned(F.xxhash64("token"), 64 - bits) if bits else F.lit(0).cast("long")
    sums = counts.filter(F.col("c") < least).groupBy(bucket.alias("bucket")).agg(F.sum(F.col("c") + 1).alias("mass")).toArrow()
    buckets[sums.column("bucket").to_numpy()] += sums.column("mass").to_numpy()
    return Vocabulary(known, int(total), int(distinct), buckets), least


class Room(dict):
    """Arrays that are filled anew in every batch; getting fresh memory for each costs more than the sums."""

    def rows(self, name: str, count: int, width: int) -> np.ndarray:
        held = self.get((name, width))
        if held is None or len(held) < count:
            held = self[name, width] = np.empty((max(count, BATCH), width), np.float32)
        return held[:count]

    def __reduce__(self):
        return Room, ()


def _taken(values: np.ndarray, at: np.ndarray, out: np.ndarray) -> np.ndarray:
    """``values[at]``, written to ``out``; all numbers are in range, and only an unchecked mode writes there directly."""
    return values.take(at, axis=0, out=out, mode="clip")


class Model:
    def __init__(self, vocabulary: Vocabulary, *rows: np.ndarray):
        self.v = vocabulary
        shapes = (CLASS_ROWS, CLASSES + 1), (WORD_ROWS, PER_CLASS), (TREE_ROWS, vocabulary.fan)
        self.rows = rows or tuple(np.zeros((n << vocabulary.growth, width), np.float32) for n, width in shapes)
        self.class_rows, self.word_rows, self.tree_rows = self.rows
        self.room = Room()

    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray, pa.DictionaryArray, np.ndarray]:
        """Ids of all tokens of all texts, features, the tokens that are not known, and each text's number of tokens.

        The id of a token that is not known is -1 less its bucket.
        """
        import xxhash

        lists = split(texts)
        sizes = lists.value_lengths().to_numpy().astype(np.int64)
        flat = lists.flatten()
        ids = pc.index_in(flat, self.v.tokens).fill_null(-1).to_numpy().astype(np.int64)
        # words before: unknown ones by their hash in a pair and else by their last letters, a text's beginning by a sign of its own
        names = ids.astype(np.uint64) + np.uint64(2)
        marks = names.copy()
        unknown = np.flatnonzero(ids < 0)
        rare = flat.take(pa.array(unknown)).dictionary_encode()
        rare = pa.DictionaryArray.from_arrays(rare.indices, with_end(rare.dictionary))
        if len(unknown):
            tokens = rare.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
            which = rare.indices.to_numpy()
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, tokens, repeat(42)), np.uint64, len(tokens))[which]
            names[unknown] = hashes
            tails = np.fromiter((int.from_bytes(t[-3:], "little") for t in tokens), np.uint64, len(tokens))
            marks[unknown] = tails[which] + np.uint64(1 << 20)
            bits = self.v.bucket_bits
            ids[unknown] = -1 - (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else -1
        ends = np.cumsum(sizes)
        begins = ends - sizes
        second = begins[sizes > 1] + 1

        def last(x: np.ndarray) -> np.ndarray:
            out = np.empty_like(x)
            out[1:] = x[:-1]
            out[begins] = 1
            return out

        def before(x: np.ndarray) -> np.ndarray:
            out = np.empty_like(x)
            out[2:] = x[:-2]
            out[begins], out[second] = 0, 1
            return out

        features = np.stack([
            (last(marks) * _MIX) ^ np.uint64(1), ((last(names) * _MIX + before(names)) * _MIX) ^ np.uint64(2),
            (before(marks) * _MIX) ^ np.uint64(3)])
        features *= _MIX
        # lines of one feature each, seen from the side
        return ids, features.T, rare, sizes

    def targets(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        classed = (ids >= 0) & (ids < self.v.classed)
        return np.where(classed, ids // PER_CLASS, CLASSES), np.where(classed, ids % PER_CLASS, -1)

    def _layer(self, layer: int, lines: np.ndarray, bias: np.ndarray,
               which: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the weights, a line for each feature, and logits, which stay until the next call; bias by ``which``."""
        rows = self.rows[layer]
        at = (lines >> np.uint64(65 - len(rows).bit_length())).astype(np.int64, order="C")
        logits, more = (self.room.rows(x, at.shape[1], rows.shape[1]) for x in ("logits", "more"))
        _taken(rows, at[0], logits)
        for line in at[1:]:
            logits += _taken(rows, line, more)
        logits += bias if which is None else _taken(bias, which, more)
        return at, logits

    def layers(self, ids: np.ndarray, features: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Of every layer: its number, the tokens that make a choice there, its rows, logits, and the outcomes.

        On the tree every token makes a choice on each level.
        """
        kind, inner = self.targets(ids)
        lines = features.T
        yield 0, np.arange(len(ids)), *self._layer(0, lines, self.v.class_bias), kind
        classed = np.flatnonzero(kind < CLASSES)
        if len(classed):
            cls = kind[classed]
            low = (lines.take(classed, axis=1) + cls.astype(np.uint64)) * _MIX
            yield 1, classed, *self._layer(1, low, self.v.word_bias, cls), inner[classed]
        rest = np.flatnonzero(kind == CLASSES)
        if len(rest):
            leaves, before = self.v.leaves(ids[rest]), lines[TREE_FEATURES].take(rest, axis=1)
            for begin in self.v.levels:
                # a level at a time, whose logits stay in the processor's cache
                leaves, branches = np.divmod(leaves, self.v.fan)
                nodes = leaves + begin
                low = (before + nodes.astype(np.uint64)) * _MIX
                yield 2, rest, *self._layer(2, low, self.v.tree_bias, nodes), branches

    def log_probabilities(self, ids: np.ndarray, features: np.ndarray) -> np.ndarray:
        """Natural logarithms; for tokens that are not known, that of their bucket."""
        out = np.zeros(len(ids))
        for at in range(0, len(ids), BATCH):
            part = out[at:at + BATCH]
            for _, tokens, _, logits, outcomes in self.layers(ids[at:at + BATCH], features[at:at + BATCH]):
                part[tokens] += _picked(logits, outcomes)
        return out


def _bound(logits: np.ndarray) -> None:
    if logits.max() > LARGEST:
        np.minimum(logits, LARGEST, out=logits)


def _picked(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log probability of one outcome in each row. Works in place; logits are bounded so that none overflows."""
    _bound(logits)
    chosen = logits[np.arange(len(at)), at].astype(float)
    return chosen - np.log(_sums(np.exp(logits, out=logits)))


def _sums(values: np.ndarray) -> np.ndarray:
    return values @ np.ones(values.shape[1], np.float32) + np.float32(1e-30)


def _errors(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Gradient of the log loss: probabilities, less one at the outcome. Works in place."""
    _bound(logits)
    np.exp(logits, out=logits)
    logits /= _sums(logits)[:, None]
    logits[np.arange(len(at)), at] -= 1
    return logits


def _row_sums(values: np.ndarray, rows: np.ndarray, begins: np.ndarray, times: np.ndarray, room: Room) -> np.ndarray:
    """Sums of ``values[rows]`` over stretches, longest first: short ones side by side, long ones each by itself."""
    sums, more = (room.rows(x, len(begins), values.shape[1]) for x in ("sums", "summand"))
    _taken(values, rows[begins], sums)
    # stretches of more than k rows come first
    longer = len(times) - np.cumsum(np.bincount(np.minimum(times, SHORT + 1), minlength=SHORT + 2))
    for k in range(1, SHORT):
        n = longer[k]
        if not n:
            break
        sums[:n] += _taken(values, rows[begins[:n] + k], more[:n])
    for k in range(longer[SHORT]):
        sums[k] += values.take(rows[begins[k] + SHORT:begins[k] + times[k]], axis=0).sum(0)
    return sums


def _order(numbers: np.ndarray, below: int) -> np.ndarray:
    """Stable order of numbers under ``below``, 16 bits at a time: these sort by radix."""
    order = np.argsort(numbers.astype(np.uint16), kind="stable")
    for shift in range(16, (below - 1).bit_length(), 16):
        order = order[np.argsort((numbers[order] >> shift).astype(np.uint16), kind="stable")]
    return order


class Trainer:
    """Follows the gradient over batches of tokens; every row has a step size of its own."""

    def __init__(self, model: Model):
        self.model = model
        self.state = [(rows, np.zeros(len(rows), np.float32), np.zeros(len(rows), np.float32)) for rows in model.rows]

    def _step(self, layer: int, at: np.ndarray, gradient: np.ndarray) -> None:
        rows, squares, met = self.state[layer]
        flat = at.astype(np.uint32).ravel()
        order = _order(flat, len(rows))
        flat = flat[order]
        begins = np.append(0, np.flatnonzero(flat[1:] != flat[:-1]) + 1)
        times = np.diff(np.append(begins, len(flat)))
        longest = _order(len(flat) - times, len(flat))
        begins, times = begins[longest], times[longest]
        names = flat[begins].astype(np.int64)
        room = self.model.room
        sums = _row_sums(gradient, order % at.shape[1], begins, times, room)
        met[names] += times
        squares[names] += np.einsum("ij,ij->i", sums, sums)
        sums *= (RATE / np.sqrt(squares[names] + 1))[:, None]
        new = _taken(rows, names, room.rows("summand", len(names), rows.shape[1]))
        new -= sums
        # a row as one value: copied in one piece
        whole = np.dtype((np.void, rows.itemsize * rows.shape[1]))
        rows.view(whole)[names, 0] = new.view(whole)[:, 0]

    def learn(self, ids: np.ndarray, features: np.ndarray) -> None:
        for at in range(0, len(ids), BATCH):
            for layer, _, rows, logits, outcomes in self.model.layers(ids[at:at + BATCH], features[at:at + BATCH]):
                self._step(layer, rows, _errors(logits, outcomes))


# weight rows that travel together
_GROUP = 512
_PART = "part int, salt int, sums binary, met binary"


def _train_round(train: DataFrame, model: Model) -> Model:
    """The model after every task's pass over its rows of ``train`` (text), averaged row by row."""
    sent = train.sparkSession.sparkContext.broadcast(model)
    layers = model.rows
    groups = [(k, a) for k, rows in enumerate(layers) for a in range(0, len(rows), _GROUP)]

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        base = sent.value
        mine = Model(base.v, *[rows.copy() for rows in base.rows])
        trainer, any_rows = Trainer(mine), False
        for batch in batches:
            for _, texts in portions(batch.column("text")):
                ids, features, _, sizes = mine.encode(texts)
                cuts = np.append(0, np.cumsum(sizes))
                cuts = [*cuts[:-1:LEARNT].tolist(), len(ids)]
                for a, b in zip(cuts, cuts[1:]):
                    trainer.learn(ids[a:b], features[a:b])
                any_rows = True
        if not any_rows:
            return
        salt = TaskContext.get().partitionId() % 64
        for part, (layer, a) in enumerate(groups):
            rows, _, met = trainer.state[layer]
            met = met[a:a + _GROUP]
            if not met.any():
                continue
            change = (rows[a:a + _GROUP] - base.rows[layer][a:a + _GROUP]) * met[:, None]
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "salt": pa.array([salt], pa.int32()),
                "sums": [change.astype(np.float32).tobytes()], "met": [met.tobytes()]})

    def add(table: pa.Table) -> pa.Table:
        total = [sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in table.column(c)) for c in ("sums", "met")]
        return pa.table({"part": table.column("part").slice(0, 1), "salt": table.column("salt").slice(0, 1),
                         "sums": [total[0].astype(np.float32).tobytes()], "met": [total[1].astype(np.float32).tobytes()]})

    # a task sends changes of a fixed size, so small input partitions are read together
    tasks = max(train.sparkSession.sparkContext.defaultParallelism, model.v.total // ROUNDS // (TASK_TOKENS << model.v.growth))
    changes = train.coalesce(tasks).mapInArrow(learn, _PART)
    merged = changes.groupBy("part", "salt").applyInArrow(add, _PART).groupBy("part").applyInArrow(add, _PART)
    new = [rows.copy() for rows in layers]
    for row in merged.collect():
        layer, a = groups[row.part]
        met = np.frombuffer(row.met, np.float32)
        sums = np.frombuffer(row.sums, np.float32).reshape(len(met), -1)
        new[layer][a:a + _GROUP] += sums / np.maximum(met, 1)[:, None]
    sent.unpersist()
    return Model(model.v, *new)


def trained(docs: DataFrame, vocabulary: Vocabulary, key: str, text: str) -> Model:
    """Weights after one pass over all training texts, in rounds of equal shares of the keys."""
    model = Model(vocabulary)
    train = docs.filter(~held_out(F.col(key)))
    for k in range(ROUNDS):
        share = F.pmod(F.xxhash64(F.lit("round"), key), F.lit(ROUNDS)) == k
        model = _train_round(train.filter(share).select(F.coalesce(F.col(text), F.lit("")).alias("text")), model)
    return model


def scored(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Scores of every row of ``docs``, learnt from the rows outside the held-out fold.

    Columns: ``key``, held_out, n_tokens, n_known (tokens met in training), train_tokens, base_score (add-one unigram)
    and score (the model), both log10 of the whole text's probability. A missing text is an empty one: its end alone
    is scored. Rows that repeat a key each get a row. Without training rows nothing is known and base_score is 0.
    Other columns are not looked at.
    """
    spark = docs.sparkSession
    counts = token_counts(docs, key, text)
    known, least = vocabulary(counts)
    model = trained(docs, known, key, text) if known.total else Model(known)
    sent = spark.sparkContext.broadcast(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        v = model.v
        for batch in batches:
            for at, texts in portions(batch.column("text")):
                ids, features, rare, sizes = model.encode(texts)
                logs = model.log_probabilities(ids, features) / np.log(10)
                # in a bucket: add-one share of its training counts, which follow from the join
                logs -= np.where(ids < 0, v.bucket_logs[np.maximum(-1 - ids, 0)], 0)
                base = v.logs[np.maximum(ids, -1)]
                begins = np.cumsum(sizes) - sizes
                # tokens that are not known, once for each text
                owners = np.repeat(np.arange(len(sizes)), sizes)[ids < 0]
                kinds = max(len(rare.dictionary), 1)
                missing, times = np.unique(owners * kinds + rare.indices.to_numpy(), return_counts=True)
                offsets = np.searchsorted(missing, np.arange(len(sizes) + 1) * kinds)
                tokens = rare.dictionary.take(pa.array(missing % kinds)).cast(pa.string())
                rest = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(
                    [tokens, pa.array(times, pa.int64())], names=["token", "n"]))
                yield pa.RecordBatch.from_pydict({
                    "n_tokens": sizes, "known": np.add.reduceat(ids >= 0, begins, dtype=np.int64),
                    "logs": np.add.reduceat(base, begins), "score": np.add.reduceat(logs, begins),
                    "id": batch.column("id").slice(at, len(texts)), "mark": batch.column("mark").slice(at, len(texts)),
                    "rest": rest})

    id_type = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("id"), F.xxhash64(text).alias("mark"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    found = written_once(rows.mapInArrow(
        score, f"n_tokens long, known long, logs double, score double, id {id_type}, mark long, "
               "rest array<struct<token:string,n:long>>"))
    # tokens beyond the frequent ones meet their counts by a join; no token among them is frequent
    rest = found.select("id", "mark", F.explode("rest").alias("r")).select("id", "mark", "r.token", "r.n")
    met = rest.join(counts.filter(F.col("c") < least), "token").select(
        "id", "mark", F.lit(0).cast("long").alias("copies"), F.lit(None).cast("long").alias("n_tokens"),
        F.lit(None).cast("long").alias("known"), F.lit(None).cast("double").alias("logs"),
        F.lit(None).cast("double").alias("score"), "n", (F.col("n") * F.log10(F.col("c") + 1.0)).alias("more"))
    own = found.select("id", "mark", F.lit(1).cast("long").alias("copies"), "n_tokens", "known", "logs", "score",
                       F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("more"))
    total = own.union(met).groupBy("id", "mark").agg(
        F.sum("copies").alias("copies"), *[F.max(c).alias(c) for c in ("n_tokens", "known", "logs", "score")],
        F.sum("n").alias("n"), F.sum("more").alias("more"))
    # rows with the same key and text have been added up together
    more = F.col("more") / F.col("copies")
    scale = float(np.log10(known.total + known.distinct + 1))
    return repeated(total.select(
        F.col("id").alias(key), held_out(F.col("id")).alias("held_out"), "n_tokens",
        (F.col("known") + (F.col("n") / F.col("copies")).cast("long")).alias("n_known"),
        F.lit(known.total).cast("long").alias("train_tokens"),
        (F.col("logs") + more - F.col("n_tokens") * scale).alias("base_score"), (F.col("score") + more).alias("score"),
        "copies"), "copies")
