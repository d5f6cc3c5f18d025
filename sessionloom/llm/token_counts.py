"""Token counts: how many tokens a public tokenizer gives each text, without keeping the tokens."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, SparkSession, functions as F

# one request to the tokenizer, and one piece of a long text, in characters
BATCH_CHARS = 1 << 20
# units remembered by a task, and the longest one worth remembering
MEMORY_UNITS = 300_000
MEMORY_CHARS = 48
# the model writes a blank as this character; a text may also hold it
BLANK = "▁"
_UNIT = re.compile(f"[ {BLANK}]*[^ {BLANK}]+|[ {BLANK}]+")
_SAFE = re.compile(f"(?<=[^ {BLANK}])[ {BLANK}]")


def pieces_of(text: str, most: int = BATCH_CHARS) -> Iterator[str]:
    """A long text cut before blanks, where no token can reach across."""
    begin = 0
    while len(text) - begin > most:
        cut = _SAFE.search(text, begin + most)
        if cut is None:
            break
        yield text[begin:cut.start()]
        begin = cut.start()
    yield text[begin:] if begin else text


class PieceCounter:
    """Counts pieces of a sentencepiece model by blank-delimited units.

    No piece of such a model holds a blank behind another character (checked on loading), so merges never
    cross from a word into the blanks before the next one. A text's count is the sum over its units, and
    a unit met before needs no second encoding. The model puts one blank before every text: a unit's own
    first blank is cut off and comes back that way.
    """

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        if any(BLANK in p.lstrip(BLANK) for p in pieces):
            raise ValueError("the model has pieces across words: texts cannot be split at blanks")
        if len(self.model.encode("a  b")) <= len(self.model.encode("a b")):
            raise ValueError("the model drops repeated blanks: texts cannot be split at blanks")
        # a last blank by itself, which the model would not see in an empty text
        self.last = len(self.model.encode("a ")) - len(self.model.encode("a"))
        self.seen: dict[str, int] = {" ": self.last, BLANK: self.last}

    def _sums(self, group: list[list[str]]) -> list[int]:
        if len(self.seen) > MEMORY_UNITS:
            self.seen = {" ": self.last, BLANK: self.last}
        new = list({u for units in group for u in units}.difference(self.seen))
        self.seen.update(zip(new, map(len, self.model.encode([u[1:] for u in new], num_threads=1))))
        sums = [sum(map(self.seen.__getitem__, units)) for units in group]
        for unit in new:
            if len(unit) > MEMORY_CHARS:
                del self.seen[unit]
        return sums

    def counts(self, texts: Iterable[str | None]) -> list[int]:
        """A missing text counts as an empty one: zero tokens."""
        totals: list[int] = []
        group: list[list[str]] = []
        owners: list[int] = []
        chars = 0

        def finish() -> None:
            for owner, n in zip(owners, self._sums(group)):
                totals[owner] += n
            group.clear()
            owners.clear()

        for text in texts:
            totals.append(0)
            for k, piece in enumerate(pieces_of(text or "")):
                units = _UNIT.findall(piece)
                if not units:
                    continue
                if k == 0:
                    units[0] = " " + units[0]
                group.append(units)
                owners.append(len(totals) - 1)
                chars += len(piece)
                if chars >= BATCH_CHARS:
                    finish()
                    chars = 0
        finish()
        return totals


def piece_count(spark: SparkSession, model_path: str, text: Column) -> Column:
    """Tokens of ``text`` as the sentencepiece model at ``model_path`` encodes it, as a long column.

    No begin, end or added tokens; strings that look like special tokens are plain text. Missing and empty
    texts have zero tokens. Texts of any length are cut into pieces at blanks, requests are balanced by
    characters, and only numbers come back from the Arrow function. The model file (under a megabyte) is
    read on the driver and broadcast, so executors need no copy of it.
    """
    with open(model_path, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())

    @F.arrow_udf("long")
    def count(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = PieceCounter(model.value)
        for texts in batches:
            yield pa.array(counter.counts(x.as_py() for x in texts), pa.int64())

    return count(text)
