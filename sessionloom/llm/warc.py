"""WARC archives compressed record by record with a Zstandard dictionary built from the records.

An archive begins with a skippable frame that holds the dictionary, followed by one Zstandard frame per
record, so that any record can be read by itself and a reader needs nothing but the file.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from typing import BinaryIO
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import shared_dir, written_once
from .common import lookup_join

# number of the skippable frame that holds a dictionary
DICTIONARY_FRAME = 0x184D2A5D
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# records, and bytes of each, that a dictionary is built from, and its size
SAMPLE_RECORDS, SAMPLE_BYTES, DICTIONARY_BYTES = 512, 16 << 10, 64 << 10
LEVEL = 6
READ_BYTES = 1 << 20
_END = b"\r\n"
_CONTROL = re.compile(r"[\x00-\x20\x7f]+")

WRITTEN = "file string, records long"
READ = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
        "refers_to long, payload binary, intact boolean")


def record_uri(page_id: int | None, digest: str) -> str:
    """The same page and payload get the same record id in every run."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}/{digest}')}>"


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode("ascii")


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None,
           revisit: bool, date: str) -> bytes:
    """Bytes of one record; a revisit keeps the HTTP header with the full length, but no payload."""
    uri = quote(_CONTROL.sub("%20", url), safe="%/:?#[]@!$&'()*+,;=~-._") if url else f"urn:page:{page_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    body = http.encode() + (b"" if revisit else payload)
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": record_uri(page_id, digest),
        "WARC-Date": date,
        "WARC-Target-URI": uri,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{digest_of(body)}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(body)),
    }
    if page_id is not None:
        fields["X-Page-ID"] = str(page_id)
    if revisit:
        fields["WARC-Profile"] = REVISIT_PROFILE
        fields["WARC-Refers-To"] = record_uri(refers_to, digest)
        if refers_to is not None:
            fields["X-Refers-To-Page-ID"] = str(refers_to)
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n"
    return head.encode() + body + _END + _END


def info_record(date: str, name: str) -> bytes:
    body = b"format: WARC File Format 1.1\r\nsoftware: sessionloom\r\n"
    head = (f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>\r\n"
            f"WARC-Date: {date}\r\nWARC-Filename: {name}\r\nContent-Type: application/warc-fields\r\n"
            f"Content-Length: {len(body)}\r\n\r\n")
    return head.encode() + body + _END + _END


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(_END + _END)
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    body = rest[:int(fields["Content-Length"])]
    if len(body) != int(fields["Content-Length"]) or rest[len(body):] != _END + _END:
        raise ValueError("a record's length differs from its header")
    return fields, body


def frames(file: BinaryIO) -> Iterator[bytes]:
    """Records of an archive, one after another, by the dictionary in its first frame."""
    import zstandard

    magic, length = struct.unpack("<II", file.read(8))
    if magic != DICTIONARY_FRAME:
        raise ValueError("the archive does not begin with a dictionary")
    dictionary = file.read(length)
    reader = zstandard.ZstdDecompressor(
        dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
    data = file.read(READ_BYTES)
    while data:
        frame, out = reader.decompressobj(), []
        while True:
            out.append(frame.decompress(data))
            if frame.eof:
                data = frame.unused_data or file.read(READ_BYTES)
                break
            data = file.read(READ_BYTES)
            if not data:
                raise ValueError("the archive ends within a record")
        yield b"".join(out)


def build_dictionary(payloads: list[bytes]) -> bytes:
    """A dictionary of the sampled payloads; none if they are too few or too small for one."""
    import zstandard

    samples = [record(0, "http://host.example/", p[:SAMPLE_BYTES], digest_of(p), None, False, "") for p in payloads]
    if len(samples) < 8:
        return b""
    try:
        return zstandard.train_dictionary(min(DICTIONARY_BYTES, sum(map(len, samples)) // 8), samples).as_bytes()
    except zstandard.ZstdError:
        return b""


def _filesystem(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (
        fs.LocalFileSystem(), folder)


def with_roles(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) with digest and, for equal payloads, the largest page id.

    A digest held by one page id only needs no partner, so the lookup holds repeated payloads alone.
    Pages without an id come after all others; if several rows tie for the largest id, each is a response.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    keyed = pages.select("page_id", "url", "html", F.sha1(payload).alias("sha1"))
    owners = written_once(
        keyed.groupBy("sha1").agg(F.max("page_id").alias("owner"), F.count("*").alias("n"))
        .filter("n > 1").select("sha1", "owner"))
    roles = lookup_join(keyed, owners, "sha1", bytes_per_row=128)
    return roles.withColumn("revisit", F.col("owner").isNotNull() & ~F.col("owner").eqNullSafe(F.col("page_id")))


def write_archives(pages: DataFrame, folder: str, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html); one row per archive: file, records.

    Every task writes an archive of its own under a name of its own, and only files of tasks that succeeded
    are in the returned table: an attempt that was lost leaves a file nobody lists. Rows without html have an
    empty payload; rows of an empty table give no archive. Further columns are ignored.
    The dictionary comes from about ``SAMPLE_RECORDS`` records, taken by the hashes of their keys, and at most twice
    as many, whatever the table's size; it changes the compression only.
    """
    spark = pages.sparkSession
    held = pages.filter(F.col("html").isNotNull())
    below = int(min(1.0, SAMPLE_RECORDS / max(held.count(), 1)) * (1 << 31))
    sample = (held.filter(F.pmod(F.xxhash64("page_id", "url"), F.lit(1 << 31)) < below)
              .select(F.substring("html", 1, SAMPLE_BYTES).alias("html")).limit(2 * SAMPLE_RECORDS).collect())
    dictionary = spark.sparkContext.broadcast(build_dictionary([r.html.encode() for r in sample]))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        store, base = _filesystem(folder)
        name, out, n = f"{uuid.uuid4().hex}.warc.zst", None, 0
        trained = zstandard.ZstdCompressionDict(dictionary.value) if dictionary.value else None
        writer = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_content_size=True)
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "html", "sha1", "owner", "revisit"))):
                page_id, url, html, sha1, owner, revisit = (x.as_py() for x in row)
                if out is None:
                    out = store.open_output_stream(f"{base}/{name}")
                    out.write(struct.pack("<II", DICTIONARY_FRAME, len(dictionary.value)) + dictionary.value)
                    out.write(writer.compress(info_record(date, name)))
                digest = base64.b32encode(bytes.fromhex(sha1)).decode("ascii")
                out.write(writer.compress(record(
                    page_id, url, (html or "").encode(), digest, owner if revisit else None, revisit, date)))
                n += 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "records": [n]})

    return written_once(with_roles(pages).mapInArrow(write, WRITTEN))


def read_archives(archives: DataFrame, payloads: bool = True) -> DataFrame:
    """Rows of all records in the files of ``archives`` (column file), read one frame after another.

    ``intact`` tells whether block and payload still have the digests in the header. A revisit holds no
    payload: its size and digest are those of the page it refers to. ``payloads=False`` leaves payloads out.
    """
    width = archives.sparkSession.sparkContext.defaultParallelism
    names = [f.split(" ")[0] for f in READ.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary(), pa.bool_()]
    schema = pa.schema(list(zip(names, kinds)))

    def parsed(data: bytes) -> list | None:
        fields, body = parse_record(data)
        kind = fields["WARC-Type"]
        if kind == "warcinfo":
            return None
        http, _, payload = body.partition(_END + _END)
        length = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        intact = fields["WARC-Block-Digest"] == f"sha1:{digest_of(body)}"
        if kind == "response":
            intact = intact and len(payload) == length and digest_of(payload) == digest
        number = {k: int(fields[k]) if k in fields else None for k in ("X-Page-ID", "X-Refers-To-Page-ID")}
        return [number["X-Page-ID"], fields["WARC-Target-URI"], length, digest, kind, number["X-Refers-To-Page-ID"],
                payload if payloads and kind == "response" else None, intact]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column("file").to_pylist():
                store, inner = _filesystem(path)
                rows, held = [], 0
                with store.open_input_stream(inner) as file:
                    for data in frames(file):
                        if row := parsed(data):
                            rows.append(row)
                            held += len(row[6] or b"") + 300
                        if held > 8 * READ_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], schema=schema)

    return archives.select("file").repartition(max(width, 1)).mapInArrow(read, READ)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives where every executor can reach it."""
    folder = f"{shared_dir(spark).rstrip('/')}/warc-{uuid.uuid4().hex}"
    store, inner = _filesystem(folder)
    store.create_dir(inner, recursive=True)
    return folder
