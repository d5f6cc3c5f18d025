"""Archives by an exact round trip."""

import base64
import hashlib
import io

import pytest

from conftest import rows
from sessionloom.llm import warc

PAGES = "page_id long, url string, html string, file string, sha1 string"


def pages_of(spark):
    same = "<html>the same page</html>" * 40
    data = [(k, f"http://h.example/{k}?q=ü x", same if k % 3 == 0 else f"<p>page {k} é 😀</p>" * (k + 1), "f", "s")
            for k in range(60)]
    data += [(100, None, None, "f", "s"), (101, "http://a/", "", "f", "s"), (102, "", "x" * 3_000_000, "f", "s"),
             (None, "http://n/", same, "f", "s"), (None, "http://n/", "only here", "f", "s"),
             (57, "http://again/", same, "f", "s"), (200, "http://crlf/\r\nX: y", "a\r\n\r\nWARC/1.1\r\n\r\nb", "f", "s")]
    return data, spark.createDataFrame(data, PAGES).repartition(4)


def test_round_trip(spark):
    data, pages = pages_of(spark)
    archives = warc.write_archives(pages, warc.archive_folder(spark))
    found = warc.read_archives(archives)
    owner = {}
    for page, _, html, *_ in data:
        if page is not None:
            owner[html or ""] = max(owner.get(html or "", page), page)
    expected = []
    for page, _, html, *_ in data:
        body = (html or "").encode()
        own = owner.get(html or "") if sum((h or "") == (html or "") for _, _, h, *_ in data) > 1 else page
        again = own is not None and own != page
        expected.append((page, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                         "revisit" if again else "response", own if again else None, None if again else body, True))
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
            None if r.payload is None else bytes(r.payload), r.intact) for r in found.collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert archives.agg({"records": "sum"}).first()[0] == len(data)


def test_every_record_is_a_frame_of_its_own(spark):
    import zstandard

    _, pages = pages_of(spark)
    archive = warc.write_archives(pages, warc.archive_folder(spark)).first()
    store, inner = warc._filesystem(archive.file)
    with store.open_input_stream(inner) as file:
        data = file.read()
    size = int.from_bytes(data[4:8], "little")
    assert data[:4] == b"\x5d\x2a\x4d\x18"
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8:8 + size]))
    left, n = data[8 + size:], 0
    while left:
        one = reader.decompressobj()
        assert one.decompress(left).startswith(b"WARC/1.1\r\n")
        left, n = one.unused_data, n + 1
    assert n == archive.records + 1


def test_empty_table(spark):
    none = warc.write_archives(spark.createDataFrame([], PAGES), warc.archive_folder(spark))
    assert none.count() == 0 and warc.read_archives(none).count() == 0


def test_damage_is_reported():
    with pytest.raises(ValueError):
        list(warc.frames(io.BytesIO(b"WARC/1.1 without a dictionary")))
    with pytest.raises(ValueError):
        warc.parse_record(b"WARC/1.1\r\nContent-Length: 10\r\n\r\nshort\r\n\r\n")


def test_dictionary_needs_records():
    assert warc.build_dictionary([]) == b""
    assert warc.build_dictionary([b"<p>text %d and more</p>" % k * 20 for k in range(200)])


def test_rows_of_result_are_one_per_page(spark):
    data, pages = pages_of(spark)
    found = warc.read_archives(warc.write_archives(pages, warc.archive_folder(spark)), payloads=False)
    assert rows(found, "page_id") == sorted(((p[0],) for p in data), key=repr)
