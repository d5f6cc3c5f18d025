"""Toxicity by a support vector machine over a subsequence string kernel with Nyström landmarks.

Two strings are alike if they share letters in the same order, gaps allowed: every common subsequence of three
characters counts, weaker the more it is stretched. An insult with inserted, dropped or replaced characters stays
close to the insult. Landmarks are strings that mark labelled texts; a sentence's coordinates are its best likeness to
each landmark, whitened by the landmarks' own kernel matrix (Nyström), and a linear machine is trained on sentences.
Labels are given for documents, so in a toxic one the sentences that look bad carry the label, or the worst if none does,
chosen anew in each round. A document is as toxic as its worst sentence.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .labelled import held_out, labelled_sample

# labelled rows that are learned from: toxic ones, and others for each of them; the more others, the rarer an insult may be
PER_CLASS, OTHERS = 1500, 4
# characters of a window, of a subsequence, what each character of its stretch costs, and the kernel's power
WINDOW, GRAM, DECAY, POWER = 10, 3, 0.7, 3
# characters of a short window, for words that begin alike, and the sign for a word's beginning
STEM, BEGIN = 5, "^"
# most landmarks, candidate strings that compete for them, and strings expected to pass for candidates by chance
LANDMARKS, CANDIDATES, BY_CHANCE = 256, 4000, 0.1
# further landmarks can only speak against toxicity: usual beginnings of words, and those of clean words like a toxic landmark
USUAL, CONTRASTS = 16, 64
# share of toxic ones that the texts with a landmark have at least, and how much it loses by the others
PURE, PURITY = 0.75, 4
# likeness below which a string is like none
FAR = 0.5
# likeness to a toxic landmark from which a sentence of a toxic text counts as bad at first
LIKE = 0.5
ROUNDS, STEPS, RIDGE, SLACK = 3, 100, 1e-2, 1e-4
# words a task remembers, and characters it looks at together
MEMORY, GROUP_CHARS = 1_500_000, 1 << 20
_SENTENCE = re.compile(r"[.!?\n]+(?=\s|$)|\n+")
_SPOTS = np.array(list(combinations(range(WINDOW), GRAM)))
_WEIGHT = (DECAY ** (_SPOTS[:, -1] - _SPOTS[:, 0] + 1)).astype(np.float32)


def bare(word: str) -> str:
    """A word in lower case without marks inside."""
    word = word.lower()
    return word if word.isalnum() else "".join(filter(str.isalnum, word))


def spelt(words: list[str]) -> list[str]:
    """Words spelt letter by letter, joined."""
    found, letters = [], []
    for word in [*words, ".."]:
        if len(letter := bare(word)) == 1:
            letters.append(letter)
            continue
        if len(letters) >= GRAM:
            found.append("".join(letters))
        letters = []
    return found


def units(sentence: str) -> list[str]:
    """Strings to look at: bare words and spelt ones, with a sign for their beginning."""
    words = sentence.split()
    return [BEGIN + w for w in [*map(bare, words), *spelt(words)] if len(w) >= GRAM]


def windows(unit: str) -> list[str]:
    """Every piece of ``STEM`` characters, and pieces of ``WINDOW`` characters that overlap by all but two."""
    out = [unit[s:s + STEM] for s in range(max(len(unit) - STEM, 0) + 1)]
    if len(unit) > STEM:
        out += [unit[s:s + WINDOW] for s in range(0, max(len(unit) - WINDOW, 0) + 1, 2)]
        out.append(unit[-WINDOW:])
    return out


def sentences(text: str) -> list[str]:
    return [s for s in _SENTENCE.split(text) if s and not s.isspace()]


def _numbers(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def hash_of(text: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(text) >> 1


def _letters(strings: list[str]) -> np.ndarray:
    return _numbers("".join(s[:WINDOW].ljust(WINDOW, "\0") for s in strings)).reshape(-1, WINDOW)


def _windows_of(bares: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of the ``windows`` of many units, and the unit of each; zeros behind a window's end."""
    text = _numbers("".join(b + "\0" for b in bares) + "\0" * WINDOW)
    sizes = np.fromiter(map(len, bares), np.int64, len(bares))
    begins = np.cumsum(sizes + 1) - sizes - 1

    def cut(width: int, chosen: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        times = np.maximum(sizes[chosen] - width, 0) // step + 1
        owner = np.repeat(chosen, times)
        at = (np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)) * step
        return owner, at, np.full(len(owner), width)

    every, longer = np.arange(len(bares)), np.flatnonzero(sizes > STEM)
    last = longer, np.maximum(sizes[longer] - WINDOW, 0), np.full(len(longer), WINDOW)
    owner, at, width = (np.concatenate(p) for p in zip(cut(STEM, every, 1), cut(WINDOW, longer, 2), last))
    spots = np.arange(WINDOW)
    out = text[(begins[owner] + at)[:, None] + spots]
    out[spots >= np.minimum(width, sizes[owner] - at)[:, None]] = 0
    return out, owner


def _features(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code and weight of every subsequence of three characters; weight zero beyond a string's end."""
    parts = letters.astype(np.int64)[:, _SPOTS]
    codes = (parts[..., 0] << 42) | (parts[..., 1] << 21) | parts[..., 2]
    return codes, np.where(parts[..., -1] > 0, _WEIGHT, np.float32(0))


def _norms(codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Square root of each string's kernel with itself: subsequences that occur twice count together."""
    order = np.argsort(codes, axis=1)
    codes, weights = np.take_along_axis(codes, order, 1), np.take_along_axis(weights, order, 1)
    out = (weights.astype(np.float64) ** 2).sum(1)
    twice = np.flatnonzero((codes[:, 1:] == codes[:, :-1]).any(1))
    if len(twice):
        flat, w = codes[twice], weights[twice].astype(np.float64)
        begins = np.ones(flat.shape, bool)
        begins[:, 1:] = flat[:, 1:] != flat[:, :-1]
        at = np.flatnonzero(begins.ravel())
        sums = np.add.reduceat(w.ravel(), at) ** 2
        out[twice] = np.bincount(at // flat.shape[1], sums, len(twice))
    return np.sqrt(out).astype(np.float32)


# multipliers of a hash of a window
_HASH = np.random.default_rng(8).integers(1 << 62, 1 << 63, WINDOW, np.uint64) * np.uint64(2) + np.uint64(1)
# the least norm of a string of so many characters: that of its weights
_LEAST_NORM = np.sqrt(np.array([(_WEIGHT[_SPOTS[:, -1] < n] ** 2).sum() for n in range(WINDOW + 1)]) + 1e-18).astype(np.float32)


class Landmarks:
    """Normalised kernel values of strings with a fixed list of landmark strings."""

    def __init__(self, names: list[str]):
        self.names = names
        letters = _letters(names)
        codes, weights = _features(letters)
        # small numbers for the landmarks' letters; 0 stands for every other one
        self.alphabet = np.unique(letters[letters > 0])
        self.base = len(self.alphabet) + 1
        triples = self._triples(letters)
        known, at = np.unique(triples, return_inverse=True)
        at = at.reshape(triples.shape)
        table = np.zeros((len(known) + 1, len(names)), np.float32)
        for k in range(len(names)):
            np.add.at(table[:, k], at[k], weights[k])
        self.table = table / np.maximum(_norms(codes, weights), 1e-9)
        self.spot = np.full(self.base ** 3, len(known), np.int32)
        self.spot[known] = np.arange(len(known))
        self.spot[0] = len(known)
        self.most = self.table.max(1)[self.spot]

    def _triples(self, letters: np.ndarray) -> np.ndarray:
        small = np.searchsorted(self.alphabet, letters)
        small = np.where(self.alphabet[np.minimum(small, len(self.alphabet) - 1)] == letters, small + 1, 0)
        a, b, c = (small[:, _SPOTS[:, k]] for k in range(GRAM))
        # a letter that no landmark has makes its triples unlike all of theirs
        return np.where((a > 0) & (b > 0) & (c > 0), (a * self.base + b) * self.base + c, 0)

    def near(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which windows may be like a landmark, and their likeness to each."""
        places, values = [np.zeros(0, np.int64)], [np.zeros((0, len(self.names)), np.float32)]
        for at in range(0, len(letters), 4000):
            part = letters[at:at + 4000]
            triples = self._triples(part)
            # no landmark can exceed the sum of the largest entries, and a norm is at least that of the weights
            hot = np.flatnonzero(self.most[triples] @ _WEIGHT >= FAR * _LEAST_NORM[(part > 0).sum(1)])
            if len(hot):
                codes, weights = _features(part[hot])
                norms = np.maximum(_norms(codes, weights), 1e-9)
                sums = np.einsum("ns,nsm->nm", weights, self.table[self.spot[triples[hot]]])
                places.append(at + hot)
                like = (sums / norms[:, None]) ** POWER
                like[like < FAR ** POWER] = 0
                values.append(like)
        return np.concatenate(places), np.concatenate(values)

    def likeness(self, strings: list[str]) -> np.ndarray:
        out = np.zeros((len(strings), len(self.names)), np.float32)
        if strings:
            at, values = self.near(_letters(strings))
            out[at] = values
        return out


class Reader:
    """Coordinates of sentences; remembers which words are near a landmark.

    With ``marking`` only sentences with a word near one of so many first landmarks are read; the others do not come out.
    """

    def __init__(self, names: list[str], marking: int | None = None):
        self.landmarks = Landmarks(names)
        self.marking = len(names) if marking is None else marking
        self._forget()

    def _forget(self) -> None:
        # words by what they are, bare words behind them, and words of one bare character
        self.far: set[str] = set()
        self.near: dict[str, np.ndarray] = {}
        self.marks: set[str] = set()
        self.known: dict[str, np.ndarray] = {}
        self.single: set[str] = set()
        # hashes of windows that are like no landmark
        self.far_windows = np.zeros(0, np.uint64)

    def _learn(self, words: set[str]) -> None:
        """Sort words not met before into near and far by the best likeness of their windows."""
        new = words.difference(self.far, self.near)
        bares = {w: bare(w) for w in new}
        self.far |= new
        self.single.update(w for w, b in bares.items() if len(b) == 1)
        units = [b for b in set(bares.values()) if len(b) >= GRAM and b not in self.known]
        if units:
            letters, owner = _windows_of([BEGIN + b for b in units])
            marks, which, back = np.unique(letters.astype(np.uint64) @ _HASH, return_index=True, return_inverse=True)
            met = np.minimum(np.searchsorted(self.far_windows, marks), max(len(self.far_windows) - 1, 0))
            new_marks = np.flatnonzero(self.far_windows[met] != marks) if len(self.far_windows) else np.arange(len(marks))
            at, values = self.landmarks.near(letters[which[new_marks]])
            hot = values.max(1, initial=0) >= FAR ** POWER
            at, values = new_marks[at[hot]], values[hot]
            found = np.full(len(marks), -1)
            found[at] = np.arange(len(at))
            self.far_windows = np.sort(np.concatenate((self.far_windows, marks[new_marks][found[new_marks] < 0])))
            found = found[back.reshape(-1)]
            best: dict[str, np.ndarray] = {}
            for k in np.flatnonzero(found >= 0).tolist():
                unit, v = units[owner[k]], values[found[k]]
                best[unit] = np.maximum(best[unit], v) if unit in best else v
            self.known.update(best)
        for w, b in bares.items():
            if b in self.known:
                self.near[w] = v = self.known[b]
                self.far.discard(w)
                if v[:self.marking].any():
                    self.marks.add(w)

    def _spells(self, words: list[str]) -> bool:
        """Whether so many words of one character follow each other that ``spelt`` may join them."""
        if self.single.isdisjoint(words):
            return False
        at = [k for k, w in enumerate(words) if w in self.single]
        return any(b - a == GRAM - 1 for a, b in zip(at, at[GRAM - 1:]))

    def texts(self, texts: list[str]) -> Iterator[list[np.ndarray]]:
        """For every text, the coordinates of its sentences that are near a landmark; the others are all zero.

        Only texts that hold a near word or may spell one are cut into sentences. What is looked up are the words of
        the sentences, which lack the marks of their end, and the joins of each sentence; so these are learnt as well.
        """
        begin = 0
        while begin < len(texts):
            end, chars = begin, 0
            while end < len(texts) and (end == begin or chars + len(texts[end]) <= GROUP_CHARS):
                chars += len(texts[end])
                end += 1
            yield from self._group(texts[begin:end])
            begin = end

    def _group(self, texts: list[str]) -> Iterator[list[np.ndarray]]:
        part = [t.split() for t in texts]
        if len(self.far) > MEMORY:
            self._forget()
        self._learn(set().union(*part))
        cut = []
        for text, words in zip(texts, part):
            spells = self._spells(words)
            lines = map(str.split, sentences(text)) if spells or not self.marks.isdisjoint(words) else ()
            cut.append([[*line, *(spelt(line) if spells else ())] for line in lines])
        self._learn({w for lines in cut for line in lines for w in line})
        limited = self.marking < len(self.landmarks.names)
        for lines in cut:
            read = [line for line in lines if not self.marks.isdisjoint(line)] if limited else lines
            found = ([self.near[w] for w in line if w in self.near] for line in read)
            yield [np.max(hot, axis=0) for hot in found if hot]


@dataclass
class Model:
    names: list[str]
    # so many of the names, the first ones, mark toxic texts
    marking: int
    weights: np.ndarray
    bias: float
    slope: float
    offset: float
    fallback: float

    def score(self, found: list[np.ndarray]) -> float:
        if not self.names:
            return self.fallback
        margin = max([self.bias, *(float(v @ self.weights) + self.bias for v in found)])
        return float(1 / (1 + np.exp(-np.clip(self.slope * margin + self.offset, -50, 50))))


def choose_landmarks(sample: DataFrame) -> tuple[list[str], list[str]]:
    """Strings that mark toxic texts: beginnings of words, by in how many toxic and how few other texts they are. And usual ones.

    A candidate is in so many different toxic texts, and so few others, that hardly one string would be by chance, given the
    share of toxic texts. They are told apart by their longest sentence, so near copies count once. Of the candidates, counted over the bounded sample, one
    after another is chosen by what it marks that earlier ones do not, until every toxic text with a candidate has one.
    """
    rows = sample.withColumn("row", F.monotonically_increasing_id())

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for text, label, row in zip(*(batch.column(c).to_pylist() for c in ("text", "label", "row"))):
                lines = sentences(text)
                found = {u[:n] for s in lines for u in units(s) for n in range(4, WINDOW + 1) if len(u) >= n}
                longest = hash_of(max(lines, key=len, default=""))
                for column, value in zip(out, (found, [label] * len(found), [row] * len(found), [longest] * len(found))):
                    column.extend(value)
            yield pa.RecordBatch.from_arrays([
                pa.array(out[0], pa.string()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.int64()),
                pa.array(out[3], pa.int64())], names=["string", "label", "row", "longest"])

    held = rows.mapInArrow(starts, "string string, label int, row long, longest long")
    toxic = F.col("label") == 1
    found = held.groupBy("string").agg(
        F.sum("label").alias("toxic"), (F.count("*") - F.sum("label")).alias("other"),
        F.size(F.collect_set(F.when(toxic, F.col("longest")))).alias("contexts"),
        F.collect_list(F.when(toxic, F.col("row"))).alias("rows"))
    n, n_toxic = sample.agg(F.count("*"), F.sum("label")).first()
    share = F.lit(n_toxic / n)
    strings = held.filter(toxic).select("string").distinct().count()
    # by Chernoff's bound so many toxic ones among the texts with a string have at most this logarithm as probability
    purity = F.col("contexts") / (F.col("contexts") + F.col("other"))
    surprise = F.col("contexts") * F.log(purity / share) + F.when(
        F.col("other") > 0, F.col("other") * F.log((1 - purity) / (1 - share))).otherwise(0)
    best = found.withColumns({"purity": purity, "surprise": surprise}).filter(
        (F.col("purity") > F.greatest(share, F.lit(PURE))) & (F.col("surprise") >= float(np.log(max(strings, 1) / BY_CHANCE)))).orderBy(
        F.desc("surprise"), "string").limit(CANDIDATES).collect()
    others = [r.string for r in found.withColumn("purity", purity).filter(F.col("purity") < PURE).orderBy(
        F.desc("other"), "string").select("string").limit(CANDIDATES).collect()]
    names = [r.string for r in best]
    texts = sorted({row for r in best for row in r.rows})
    at = {row: k for k, row in enumerate(texts)}
    marks = np.zeros((len(best), len(texts)), np.float32)
    for k, r in enumerate(best):
        marks[k, [at[row] for row in r.rows]] = r.purity ** PURITY
    # a text counts half as much for each landmark that marks it already
    longer = 1 + 0.05 * np.array([len(n) for n in names])
    open_share, usable, chosen = np.ones(len(texts), np.float32), np.ones(len(best), bool), []
    while usable.any() and len(chosen) < LANDMARKS:
        gain = np.where(usable, marks @ open_share, 0)
        k = int(np.argmax(gain * longer))
        if gain[k] < 0.5:
            break
        chosen.append(names[k])
        open_share[marks[k] > 0] /= 2
        usable &= [not (n.startswith(names[k]) or names[k].startswith(n)) for n in names]
    # what a clean text says of a word can only be told from an insult by strings of its own that are like one
    alike = Landmarks(chosen).likeness(others).max(1) if chosen else np.zeros(len(others))
    nearest = [others[k] for k in np.argsort(-alike, kind="stable")[:CONTRASTS] if alike[k] > 0]
    return chosen, list(dict.fromkeys(nearest + others[:USUAL]))


def _machine(x: np.ndarray, y: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, float]:
    """Linear support vector machine of squared hinge losses over rows met ``times`` often; classes weigh the same.

    Newton's method over the rows within the margin, so the minimum is exact; the bias is not held small.
    """
    cost = times * np.where(y > 0, 0.5 / max(times[y > 0].sum(), 1), 0.5 / max(times[y < 0].sum(), 1))
    x = np.column_stack((x, np.ones(len(x)))).astype(np.float64)
    held = np.append(np.full(x.shape[1] - 1, SLACK), 1e-9)
    theta = np.zeros(x.shape[1])

    def loss(theta: np.ndarray) -> float:
        return float((cost * np.maximum(1 - y * (x @ theta), 0) ** 2).sum() + 0.5 * held @ theta ** 2)

    for _ in range(STEPS):
        short = np.maximum(1 - y * (x @ theta), 0)
        inside = x[short > 0]
        weight = 2 * cost[short > 0]
        gradient = held * theta - (2 * cost * short * y) @ x
        step = np.linalg.solve((inside * weight[:, None]).T @ inside + np.diag(held + 1e-12), gradient)
        rate, before = 1.0, loss(theta)
        while loss(theta - rate * step) > before and rate > 1e-8:
            rate /= 2
        theta = theta - rate * step
        if np.abs(rate * step).max() < 1e-9:
            break
    return theta[:-1], float(theta[-1])


def _calibrated(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the logistic curve that fits labels to margins best, by Newton's method.

    The targets are a little short of 0 and 1, so the curve stays finite where margins tell the classes apart.
    """
    x = np.column_stack((margins, np.ones(len(margins))))
    n = np.array([(labels == 0).sum(), (labels == 1).sum()], float)
    target = np.where(labels == 1, (n[1] + 1) / (n[1] + 2), 1 / (n[0] + 2))
    weight = np.full(len(labels), 1 / len(labels))
    theta = np.zeros(2)

    def loss(theta: np.ndarray) -> float:
        z = x @ theta
        return float((weight * (np.logaddexp(0, z) - target * z)).sum() + 1e-6 * theta @ theta)

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -50, 50)))
        gradient = x.T @ (weight * (p - target)) + 2e-6 * theta
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + 2e-6 * np.eye(2), gradient)
        rate = 1.0
        while loss(theta - rate * step) > loss(theta) and rate > 1e-6:
            rate /= 2
        theta = theta - rate * step
        if np.abs(rate * step).max() < 1e-8:
            break
    return float(theta[0]), float(theta[1])


def distinct_sentences(found: list[np.ndarray], m: int) -> np.ndarray:
    """All sentences of a text as distinct coordinates, with their number in a last column; one of zeros if there are none."""
    if not found:
        return np.append(np.zeros((1, m), np.float32), np.ones((1, 1), np.float32), axis=1)
    rows, times = np.unique(np.stack(found).astype(np.float32), axis=0, return_counts=True)
    return np.column_stack((rows, times)).astype(np.float32)


def fit(sample: DataFrame) -> Model:
    """Learn from every sentence of a bounded sample of texts (text, label).

    Without both classes every text gets the share of label 1.
    """
    sample = sample.persist()
    counts = {r.label: r["count"] for r in sample.groupBy("label").count().collect()}
    total = sum(counts.values())
    chosen, usual = choose_landmarks(sample) if len(counts) == 2 else ([], [])
    names = chosen + usual
    if not chosen:
        return Model([], 0, np.zeros(0), 0.0, 1.0, 0.0, counts.get(1, 0) / total if total else 0.0)
    m = len(names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = Reader(names, len(chosen))
        for batch in batches:
            # as in scoring, sentences that are like no toxic landmark stand back behind an empty one
            blobs = [distinct_sentences(found, m).tobytes() for found in reader.texts(batch.column("text").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary()), batch.column("label")], names=["found", "label"])

    rows = sorted((bytes(r.found), r.label) for r in sample.mapInArrow(read, "found binary, label int").collect())
    sample.unpersist()
    labels = np.array([label for _, label in rows], float)
    blocks = [np.frombuffer(f, np.float32).reshape(-1, m + 1) for f, _ in rows]
    ends = np.cumsum([len(b) for b in blocks])
    begins, held = np.append(0, ends[:-1]), np.concatenate(blocks)
    # sentences of equal coordinates are one row
    shapes, at = np.unique(held[:, :m], axis=0, return_inverse=True)
    at = at.reshape(-1)
    clean = np.repeat(labels == 0, np.diff(np.append(0, ends)))
    times = np.bincount(at, held[:, m] * clean, len(shapes))
    # clean sentences that are like no toxic landmark weigh no more together than those that are like one
    far = ~shapes[:, :len(chosen)].any(1)
    times[far] *= min(1, max(times[~far].sum(), 1) / max(times[far].sum(), 1))
    own = Landmarks(names).likeness(names).astype(np.float64)
    values, vectors = np.linalg.eigh((own + own.T) / 2 + RIDGE * np.eye(m))
    whiten = vectors / np.sqrt(np.maximum(values, RIDGE)) @ vectors.T
    mapped = shapes @ whiten
    others = np.flatnonzero(times > 0)
    toxic = [at[a:b] for a, b, label in zip(begins, ends, labels) if label == 1]
    # first the sentences that are like a toxic landmark, then those that look bad; of a text without one its worst
    score, least = shapes[:, :len(chosen)].max(1, initial=0), LIKE
    for _ in range(ROUNDS):
        worst, often = np.unique(np.concatenate(
            [bad if len(bad := t[score[t] >= least]) else t[[np.argmax(score[t])]] for t in toxic]), return_counts=True)
        x = np.concatenate([mapped[worst], mapped[others], np.zeros((1, m))])
        y = np.where(np.arange(len(x)) < len(worst), 1.0, -1.0)
        w, b = _machine(x, y, np.concatenate([often, times[others], [1]]))
        weights = whiten @ w
        # so a sentence that is like usual words alone cannot look worse than an empty one
        weights[len(chosen):] = np.minimum(weights[len(chosen):], 0)
        score, least = shapes @ weights, -b
    margins = np.maximum(b, np.maximum.reduceat(score[at], begins) + b)
    slope, offset = _calibrated(margins, labels)
    return Model(names, len(chosen), weights, b, max(slope, 1e-3), offset, 0.0)


def _scores(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str, per_class: int):
    """A column function that scores texts by the model learnt from ``docs`` and ``labels``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(labelled_sample(docs, labels, label, {0: OTHERS * per_class, 1: per_class}, key, text)))

    @F.arrow_udf("double")
    def worst(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        reader = Reader(model.value.names, model.value.marking) if model.value.names else None
        for texts in batches:
            found = reader.texts(texts.to_pylist()) if reader else ([] for _ in texts)
            yield pa.array([round(model.value.score(f), 6) for f in found], pa.float64())

    return worst


def kept(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
         per_class: int = PER_CLASS, threshold: float = 0.5) -> DataFrame:
    """Rows of ``docs`` that score below the threshold, with all their columns."""
    worst = _scores(docs, labels, key, text, label, per_class)
    return docs.filter(worst(F.coalesce(F.col(text), F.lit(""))) < threshold)


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
           per_class: int = PER_CLASS, threshold: float = 0.5) -> DataFrame:
    """Columns ``key``, held_out, score (0 to 1, higher: label 1 likelier) and predicted of every row of ``docs``.

    A missing text is an empty one: no sentence, so it has the lowest score there is. Rows are scored one by one, so
    repeated rows have equal scores; further columns are not looked at. An empty table gives no rows; without labels of
    both classes every score is the share of label 1 among those there are (0 without any).
    """
    worst = _scores(docs, labels, key, text, label, per_class)
    rows = docs.select(F.col(key), held_out(F.col(key)).alias("held_out"),
                       worst(F.coalesce(F.col(text), F.lit(""))).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
