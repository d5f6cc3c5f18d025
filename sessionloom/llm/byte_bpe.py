"""Byte-level BPE: texts to token ids of a public rank file, and ids back to the bytes they stand for.

The merges run in the tiktoken library. Its pattern splits a text into matches that are merged one by one, so a long
text is cut first, at places where a match ends whatever follows: before white space, or between a letter and a mark.
No match of the pattern reaches across, so the ids of the pieces are the ids of the text.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession, functions as F

# characters of a piece of a long text, and ids decoded at once
PIECE_CHARS, PIECE_IDS = 1 << 16, 1 << 18
# a longer run of white space is merged by itself: the pattern's look-ahead keeps a stack that grows with it
LONG_BLANK = 1 << 15
# most bytes of a rank file, which is broadcast
RANK_BYTES = 16 << 20
ID_BYTES = 4

# --- fixed values: Unicode white space, and letters and marks of every Unicode version -------------
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
WIDE_LETTERS = r"\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3"
LETTERS = r"A-Za-z\u03b1-\u03c9\u0410-\u044f\u0621-\u063a\u0904-\u0939" + WIDE_LETTERS
MARKS = r"!-@\[-`{-~\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f"
# --------------------------------------------------------------------------------------------------
_SAFE = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])|(?<=[{LETTERS}])(?=[{MARKS}])|(?<=[{MARKS}])(?=[{WIDE_LETTERS}])")
_BLANK = re.compile(f"[{WHITE}]{{{LONG_BLANK},}}")


def pieces_of(text: str, most: int = PIECE_CHARS) -> Iterator[str]:
    """A text cut at the first safe place behind every ``most`` characters; whole if there is none."""
    begin = 0
    while len(text) - begin > most:
        cut = _SAFE.search(text, begin + most)
        if cut is None:
            break
        yield text[begin:cut.start()]
        begin = cut.start()
    yield text[begin:] if begin else text


class Codec:
    """Encoder and decoder of one rank file (lines of a base64 token and its id) and one pattern."""

    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        merges = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines())}
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

    def _ids(self, piece: str) -> Iterator[list[int]]:
        """Ids of a piece; a very long run of white space is a match of its own, but for a last blank before a word."""
        begin = 0
        for run in _BLANK.finditer(piece) if len(piece) >= LONG_BLANK else ():
            yield self.library.encode_ordinary(piece[begin:run.start()])
            begin = run.end() if run.end() == len(piece) else run.end() - 1
            yield self.library._encode_single_piece(piece[run.start():begin])
        yield self.library.encode_ordinary(piece[begin:] if begin else piece)

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian 32-bit numbers; none for a missing text. Strings of special tokens are plain text."""
        return b"".join(np.array(ids, "<u4").tobytes() for piece in pieces_of(text or "") for ids in self._ids(piece))

    def decode(self, ids: bytes | None) -> bytes | None:
        """The raw bytes of the tokens; None if these are not whole ids of the rank file."""
        if ids is None or len(ids) % ID_BYTES:
            return None
        numbers = np.frombuffer(ids, "<u4")
        try:
            return b"".join(self.library.decode_bytes(numbers[at:at + PIECE_IDS].tolist())
                            for at in range(0, len(numbers), PIECE_IDS))
        except KeyError:
            return None


class ByteBpe:
    """Column functions of a rank file at a path the driver can read; tasks get its bytes by broadcast.

    ``encode``: text to BINARY, the ids as little-endian unsigned 32-bit numbers, four bytes a token. A missing or empty
    text has none. Texts of any length are cut at safe places and never shortened; only a single match (a word of a
    million letters, say) stays whole.
    ``decode``: such a BINARY back to the raw bytes, which are those of the text. NULL for NULL, for a length that is no
    multiple of four and for an id that the file lacks. Bytes stay bytes: ids cut anywhere need not be valid UTF-8.
    ``coded``: both, as a struct of ids and bytes, in one pass: a task then runs one Python worker and not two.
    ``count``: number of ids.

    Rows are worked on one by one, so repeated rows get equal results, an empty table gives no rows, and other columns
    and their names do not matter.
    """

    def __init__(self, spark: SparkSession, rank_path: str, pattern: str):
        with open(rank_path, "rb") as file:
            ranks = file.read(RANK_BYTES + 1)
        if len(ranks) > RANK_BYTES:
            raise ValueError(f"rank file of more than {RANK_BYTES} bytes: {rank_path}")
        sent = spark.sparkContext.broadcast((ranks, pattern))

        @F.arrow_udf("binary")
        def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = Codec(*sent.value)
            for texts in batches:
                yield pa.array((codec.encode(t.as_py()) for t in texts), pa.binary(), size=len(texts))

        @F.arrow_udf("binary")
        def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = Codec(*sent.value)
            for ids in batches:
                yield pa.array((codec.decode(i.as_py()) for i in ids), pa.binary(), size=len(ids))

        @F.arrow_udf("struct<ids:binary,bytes:binary>")
        def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            codec = Codec(*sent.value)
            for texts in batches:
                ids = pa.array((codec.encode(t.as_py()) for t in texts), pa.binary(), size=len(texts))
                back = pa.array((codec.decode(i.as_py()) for i in ids), pa.binary(), size=len(ids))
                yield pa.StructArray.from_arrays([ids, back], names=["ids", "bytes"])

        self._encode, self._decode, self._coded = encode, decode, coded

    def encode(self, text: Column) -> Column:
        return self._encode(text)

    def decode(self, ids: Column) -> Column:
        return self._decode(ids)

    def coded(self, text: Column) -> Column:
        return self._coded(text)

    @staticmethod
    def count(ids: Column) -> Column:
        return F.call_function("div", F.octet_length(ids), F.lit(ID_BYTES)).cast("long")
