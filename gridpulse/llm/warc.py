"""Web archives in seekable Zstandard bundles.

WARC 1.1 records are grouped into independent Zstandard frames. After them a file holds a
skippable frame with the places of its records, and the seek table of the public
Zstandard seekable format as its last frame, so that one record can be read without
the rest: find its frame and its offset in the frame, read that frame alone. Any
Zstandard tool can still unpack the file as a whole.
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import col, map_arrow, new_folder, read_range, stored, write_file
from gridpulse.llm.ranges import parts_for

#: Uncompressed bytes after which a frame is closed, and compressed bytes after which a file is.
FRAME_BYTES, FILE_BYTES = 1 << 20, 32 << 20
#: Shorter payloads are always stored, as a reference would take as much room.
LEAST_SHARED = 1000
#: Numbers of the Zstandard seekable format (fixed values).
SEEK_FRAME, INDEX_FRAME, SEEK_MAGIC = 0x184D2A5E, 0x184D2A50, 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: The pages have no time of capture.
DATE = "1970-01-01T00:00:00Z"
RESPONSE, REVISIT = "response", "revisit"
_ID = "urn:gridpulse:page:"


def _digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _header(value: str) -> str:
    """A header value on one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None) -> bytes:
    """One WARC record: a response, or a revisit without the payload if `refers_to` is given."""
    kind = RESPONSE if refers_to is None else REVISIT
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header(url)}")
    lines.append(f"WARC-Payload-Digest: sha1:{_digest(payload)}")
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{_ID}{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Record:
    page_id: int | None
    url: str | None
    kind: str
    payload: bytes | None
    payload_bytes: int
    payload_digest: str
    refers_to: int | None
    offset: int
    length: int


def _number(reference: str | None) -> int | None:
    number = (reference or "").strip("<>").removeprefix(_ID)
    return int(number) if number else None


def parse(data: bytes, at: int = 0) -> Iterator[Record]:
    """The records of one unpacked frame from `at` on; a payload that does not have its digest is an error."""
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        first, *lines = data[at:end].decode().split("\r\n")
        if first != "WARC/1.1":
            raise ValueError("not a WARC record")
        headers = dict(line.split(": ", 1) for line in lines)
        length = int(headers["Content-Length"])
        block = data[end + 4 : end + 4 + length]
        begin = block.index(b"\r\n\r\n") + 4
        http = dict(line.split(": ", 1) for line in block[: begin - 4].decode().split("\r\n")[1:])
        digest, kind = headers["WARC-Payload-Digest"].removeprefix("sha1:"), headers["WARC-Type"]
        payload = block[begin:] if kind == RESPONSE else None
        if payload is not None and (_digest(payload) != digest or len(payload) != int(http["Content-Length"])):
            raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
        after = end + 4 + length + 4
        yield Record(
            _number(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), kind, payload, int(http["Content-Length"]),
            base64.b32decode(digest).hex(), _number(headers.get("WARC-Refers-To")), at, after - at,
        )
        at = after


class Bundle:
    """Builds one file; `add` returns the place of a record: frame and offset in it."""

    def __init__(self) -> None:
        self.packer = zstandard.ZstdCompressor(level=3, write_checksum=True)
        self.body, self.frames, self.places = bytearray(), [], []
        self.open = bytearray()

    def add(self, page_id: int | None, data: bytes) -> None:
        self.places.append((page_id, len(self.frames), len(self.open), len(data)))
        self.open += data
        if len(self.open) >= FRAME_BYTES:
            self._close_frame()

    def _close_frame(self) -> None:
        if self.open:
            packed = self.packer.compress(bytes(self.open))
            self.frames.append((len(self.body), len(packed), len(self.open)))
            self.body += packed
            self.open = bytearray()

    def finish(self) -> bytes:
        self._close_frame()
        index = self.packer.compress(json.dumps(self.places).encode())
        table = b"".join(struct.pack("<II", packed, raw) for _, packed, raw in self.frames)
        table += struct.pack("<II", 8 + len(index), 0)  # the skippable frame of the places
        table += struct.pack("<IBI", len(self.frames) + 1, 0, SEEK_MAGIC)
        return bytes(self.body) + struct.pack("<II", INDEX_FRAME, len(index)) + index + struct.pack("<II", SEEK_FRAME, len(table)) + table


class Archive:
    """Random access to one file by its seek table; `fetch(start, length)` gives bytes, negative starts count from the end."""

    def __init__(self, fetch: Callable[[int, int], bytes]):
        self.fetch = fetch
        n, flags, magic = struct.unpack("<IBI", fetch(-9, 9))
        if magic != SEEK_MAGIC or flags:
            raise ValueError("no seek table")
        sizes = struct.unpack(f"<{2 * n}I", fetch(-9 - 8 * n, 8 * n))
        self.frames, at = [], 0
        for packed, raw in zip(sizes[::2], sizes[1::2]):
            self.frames.append((at, packed, raw))
            at += packed
        start, packed, _ = self.frames.pop()
        self.places = [tuple(p) for p in json.loads(zstandard.ZstdDecompressor().decompress(fetch(start, packed)[8:]))]

    def frame(self, number: int) -> bytes:
        start, packed, raw = self.frames[number]
        return zstandard.ZstdDecompressor().decompress(self.fetch(start, packed), max_output_size=raw)

    def records(self, page_id: int | None) -> list[Record]:
        return [next(parse(self.frame(n), offset)) for i, n, offset, _ in self.places if i == page_id]


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> tuple[str, DataFrame]:
    """Write a record for every row; gives the folder and the index (id, file, frame, start, packed, offset, length).

    A payload is the html in UTF-8, empty for null. Of rows with equal payloads of at
    least LEAST_SHARED bytes those of the largest id are responses, the others revisits
    of it (rows that repeat the largest id are all responses; rows without an id are
    never referred to, and are responses if no row of their payload has one). Only payloads that occur twice are
    joined, by their digests; a task holds one file. No rows give no files.
    """
    folder = new_folder(pages.sparkSession, "warc")
    rows = pages.select(
        col(id_col).cast("long").alias("id"), col(url_col).cast("string").alias("url"),
        F.encode(F.coalesce(col(html_col).cast("string"), F.lit("")), "utf-8").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    long = rows.filter(F.octet_length("payload") >= LEAST_SHARED).select("id", "digest")
    shared = long.groupBy("digest").agg(F.max("id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first")
    linked = rows.join(stored(shared, "warc-shared"), "digest", "left").select(
        "id", "url", "payload", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = Bundle()

        def close() -> pa.RecordBatch:
            nonlocal bundle
            name = write_file(folder, "part.warc.zst", bundle.finish())
            made = [(i, name, n, *bundle.frames[n][:2], offset, size) for i, n, offset, size in bundle.places]
            bundle = Bundle()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), _INDEX.types)], schema=_INDEX)

        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                bundle.add(page_id, record(page_id, url, payload, refers_to))
                if len(bundle.body) >= FILE_BYTES:
                    yield close()
        if bundle.places:
            yield close()

    schema = "id long, file string, frame long, start long, packed long, offset long, length long"
    return folder, stored(map_arrow(linked, write, schema), "warc-index")


_INDEX = pa.schema([("id", pa.int64()), ("file", pa.string()), *[(n, pa.int64()) for n in ("frame", "start", "packed", "offset", "length")]])


def read_archives(folder: str, index: DataFrame) -> DataFrame:
    """(id, url, payload, payload_bytes, payload_digest, record_type, refers_to) of all records, frame by frame.

    The payload of a revisit is null; its size and digest are those of the full payload.
    """
    frames = index.select("file", "start", "packed").distinct()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                data = unpacker.decompress(read_range(folder, row["file"], row["start"], row["packed"]))
                found = [(r.page_id, r.url, r.payload, r.payload_bytes, r.payload_digest, r.kind, r.refers_to) for r in parse(data)]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), _RECORDS.types)], schema=_RECORDS)

    dealt = frames.repartition(parts_for(index), "file", "start")
    return map_arrow(dealt, read, "id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long")


_RECORDS = pa.schema([
    ("id", pa.int64()), ("url", pa.string()), ("payload", pa.binary()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
])
