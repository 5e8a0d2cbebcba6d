import hashlib
import os
import sys

import pytest
import zstandard
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from compare import compare, duck  # noqa: E402

from gridpulse.llm import queries, warc  # noqa: E402
from gridpulse.llm.common import read_range  # noqa: E402

LONG = "é" * 600  # 1200 bytes
HARD = "WARC/1.1\r\n\r\nContent-Length: 3\r\n\r\n" * 50


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x") for i, u, h in rows], "page_id long, url string, html string, payload string")


def plain(rows):
    out = []
    for i, u, h in rows:
        data = (h or "").encode()
        same = [j for j, _, x in rows if (x or "").encode() == data and j is not None]
        first = max(same, default=None) if len(data) >= 1000 else None
        revisit = first is not None and first != i
        out.append((i, u, None if revisit else data, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=str)


ROWS = [
    (1, "http://a/", LONG), (2, None, LONG), (3, "http://a/", LONG), (3, "http://b/", LONG), (4, "u", None), (5, "u", ""), (6, "u", "short"),
    (7, "u", "short"), (8, "u", HARD), (9, "é", HARD), (None, "u", LONG), (None, "u", "x" * 1000), (None, "u", "x" * 1000), (10, "u", "y" * 999), (11, "u", "y" * 999),
]


def test_round_trip(spark, monkeypatch):
    folder, index = warc.write_archives(pages(spark, ROWS))
    assert sorted((tuple(r) for r in warc.read_archives(folder, index).collect()), key=str) == plain(ROWS)
    assert index.count() == len(ROWS)


def test_seeking_and_standard_tools():
    bundle, want = warc.Bundle(), {}
    for i in range(200):
        want[i] = os.urandom(9000) + bytes(20_000)
        bundle.add(i, warc.record(i, f"http://x/{i}", want[i]))
    data = bundle.finish()
    read = []

    def fetch(start, length):
        read.append(length)
        return data[start:][:length]

    archive = warc.Archive(fetch)
    assert len(archive.frames) > 4
    read.clear()
    for i in (0, 77, 199):
        (found,) = archive.records(i)
        assert (found.page_id, found.payload, found.url) == (i, want[i], f"http://x/{i}")
    assert sum(read) < len(data)  # three frames, not the file
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    assert [r.page_id for r in warc.parse(whole)] == list(range(200))


def test_damage_is_found():
    data = warc.record(1, "u", b"some payload")
    with pytest.raises(ValueError):
        list(warc.parse(data.replace(b"some", b"sOme")))
    with pytest.raises(ValueError):
        list(warc.parse(data[5:]))


def test_line_ends_in_urls():
    (found,) = warc.parse(warc.record(1, "a\r\nWARC-Type: x", b""))
    assert found.url == "a%0D%0AWARC-Type: x" and found.kind == "response"


def test_one_record_through_the_index(spark):
    folder, index = warc.write_archives(pages(spark, ROWS))
    row = index.filter(F.col("id") == 9).first()
    archive = warc.Archive(lambda start, length: read_range(folder, row.file, start, length))
    found = next(warc.parse(archive.frame(row.frame), row.offset))
    assert (found.page_id, found.payload, found.length) == (9, HARD.encode(), row.length)


def test_empty(spark):
    folder, index = warc.write_archives(pages(spark, []))
    assert warc.read_archives(folder, index).count() == 0


def test_query_and_sql(spark, small):
    found = queries.QUERIES["op8_seekable_warc"](spark, small)
    assert compare(found, duck(small), queries.ORACLE_SQL["op8_seekable_warc"]) is None
