"""Quality by nearest labelled neighbours in a latent-semantic space.

Terms describe how a text is written, not what about: runs of character classes in threes, stuttering words, and
length. A bounded sample of labelled rows gives term weights, a truncated singular value decomposition, and the
labelled vectors, which are broadcast. Every document is projected and compared with every labelled vector by exact
cosine products, in blocks; its nearest neighbours vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .labelled import held_out, labelled_sample

# labelled rows a class that are learned from, hashed terms, latent dimensions, voters, documents in a block
PER_CLASS, TERMS, DIMENSIONS, NEIGHBOURS, BLOCK = 1500, 2048, 48, 25, 256
THRESHOLD = 0.3
STUTTER_COUNT = 1000
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def _byte_classes() -> np.ndarray:
    """Class of every UTF-8 byte; continuation bytes go with the byte before them."""
    kinds = np.full(256, 15, np.uint8)
    for k, group in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789",
                               b" \t\r\x0b\x0c", b"\n", b".", b",;:", b"!", b"?", b"|", b"#*$%&<>@^~", b"-_/\\", b"'\"()")):
        kinds[list(group)] = k
    kinds[0xC0:] = 13
    kinds[0x80:0xC0] = 255
    return kinds


_CLASSES = _byte_classes()


def terms(text: str) -> np.ndarray:
    """Counts of a text's hashed terms."""
    raw = text.encode()
    kinds = _CLASSES[np.frombuffer(raw, np.uint8)]
    kinds = kinds[kinds != 255]
    counts = np.zeros(TERMS, np.float32)
    if len(kinds):
        begins = np.flatnonzero(np.concatenate(([True], kinds[1:] != kinds[:-1])))
        lengths = np.minimum(np.diff(np.append(begins, len(kinds))), 4)
        runs = kinds[begins].astype(np.uint64) * np.uint64(5) + lengths.astype(np.uint64)
        padded = np.concatenate((np.zeros(2, np.uint64), runs))
        triples = (padded[2:] << np.uint64(20)) | (padded[1:-1] << np.uint64(10)) | padded[:-2]
        codes = ((triples + np.uint64(1)) * _MULTIPLIER) >> np.uint64(53)
        counts += np.bincount(codes.astype(np.int64), minlength=TERMS)[:TERMS]
    words = raw.split()
    # the share of stuttering words is a term by tenths, as strong as many others together
    stutter = sum(a == b for a, b in zip(words, words[1:]))
    if 10 * stutter >= len(words) > 1:
        counts[10 * stutter // len(words)] += STUTTER_COUNT
    # a term of its own for every doubling of the length, so that no text is without terms
    counts[16 + len(words).bit_length()] += 1
    return counts


@dataclass
class Model:
    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    fallback: float

    def project(self, counts: np.ndarray) -> np.ndarray:
        weighted = np.log1p(counts) * self.idf
        weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-9)
        latent = weighted @ self.axes
        return latent / np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-9)

    def votes(self, counts: np.ndarray) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(counts), self.fallback)
        likeness = self.project(counts) @ self.vectors.T
        k = min(NEIGHBOURS, likeness.shape[1])
        near = np.argpartition(-likeness, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(likeness, near, 1), 0) ** 4
        total = weight.sum(1)
        vote = (weight * self.labels[near]).sum(1) / np.maximum(total, 1e-9)
        return np.where(total > 1e-9, vote, self.fallback)


def fit(sample: DataFrame) -> Model:
    """Learn from a bounded sample (text, label). Without both classes every text gets the share of label 1."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs = [terms(t.as_py()).tobytes() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([pa.array(blobs, pa.binary()), batch.column("label")], names=["terms", "label"])

    rows = sorted((bytes(r.terms), r.label) for r in sample.mapInArrow(count, "terms binary, label int").collect())
    labels = np.array([r[1] for r in rows], np.float32)
    if len(set(labels.tolist())) < 2:
        return Model(np.ones(TERMS), np.zeros((TERMS, 1)), np.zeros((0, 1)), labels[:0],
                     float(labels.mean()) if len(labels) else 0.5)
    counts = np.stack([np.frombuffer(r[0], np.float32) for r in rows])
    idf = np.log((1 + len(rows)) / (1 + (counts > 0).sum(0))).astype(np.float32) + 1
    weighted = np.log1p(counts) * idf
    weighted /= np.maximum(np.linalg.norm(weighted, axis=1, keepdims=True), 1e-9)
    _, vectors = np.linalg.eigh((weighted.T @ weighted).astype(np.float64))
    axes = vectors[:, ::-1][:, :DIMENSIONS].astype(np.float32)
    model = Model(idf, axes, np.zeros((0, 1)), labels[:0], float(labels.mean()))
    return Model(idf, axes, model.project(counts), labels, model.fallback)


def scored(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
           per_class: int = PER_CLASS) -> DataFrame:
    """Columns ``key``, held_out, score (0 to 1, higher: label 1 likelier) and predicted of every row of ``docs``.

    A missing text is an empty one, which has a score like any other. Rows are scored one by one, so repeated rows
    have equal scores; further columns are not looked at. An empty table gives no rows, and without labels of both
    classes every score is the share of label 1 among those there are (0.5 without any).
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(labelled_sample(docs, labels, label, per_class, key, text)))

    @F.arrow_udf("double")
    def vote(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            found = []
            for at in range(0, len(texts), BLOCK):
                block = texts.slice(at, BLOCK)
                found.append(model.value.votes(np.stack([terms(t.as_py()) for t in block])))
            yield pa.array(np.round(np.concatenate(found or [np.zeros(0)]), 6).astype(np.float64))

    rows = docs.select(F.col(key), held_out(F.col(key)).alias("held_out"),
                       vote(F.coalesce(F.col(text), F.lit(""))).alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
