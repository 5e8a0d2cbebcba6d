"""Token ids in entropy-coded files: range asymmetric numeral systems with shared static tables.

A file holds the ids of consecutive documents. One frequency table, counted over the
file's ids, serves all of its blocks. A block holds whole documents and is coded on
its own: its ids are dealt to lanes in turn, each lane has a 63-bit state that takes in
or gives off 32-bit words, and the lanes' words are interleaved in one stream, so that
one step codes an id of every lane. At every `STEPS` steps a checkpoint keeps the lanes'
states and the place in the stream; decoding can start at any of them.

Layout, little-endian:

    magic "RTK1"
    table: symbols and frequencies (zlib)
    blocks: words (u32), each block followed by the next
    footer (zlib): blocks' places, documents' ids and lengths, checkpoints' states and places
    u64 footer start, u32 table length, u32 crc of footer, magic "RTK1"

Every block, the table and the footer carry a CRC-32.
"""

from __future__ import annotations

import io
import struct
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import col, map_arrow, new_folder, read_range, stored, write_file
from gridpulse.llm.ranges import boundaries, bucket, parts_for
from gridpulse.llm.tokens import encoder

MAGIC = b"RTK1"
END_ID = 0
#: Bits of the frequency table's total.
TABLE_BITS = 18
LANES = 4096
#: Steps between two checkpoints.
STEPS = 256
#: A block ends with the document that reaches this number of ids, a file likewise.
BLOCK_IDS, FILE_IDS = 1 << 21, 1 << 22
_LOW = np.uint64(1 << 31)
#: Texts encoded at once.
_TEXTS = 256


@dataclass
class Table:
    """Frequencies of a file's symbols, scaled to 2 ** TABLE_BITS."""

    symbols: np.ndarray
    frequencies: np.ndarray

    @classmethod
    def count(cls, ids: np.ndarray) -> Table:
        counts = np.bincount(ids)
        symbols = np.flatnonzero(counts)
        total = 1 << TABLE_BITS
        scaled = np.maximum(1, counts[symbols] * total // max(1, len(ids)))
        order = np.argsort(-scaled, kind="stable")
        over = int(scaled.sum()) - total
        if over < 0:
            scaled[order[0]] -= over
        while over > 0:  # taken from the frequent ones, which lose least
            cut = np.minimum(scaled[order] // 2, np.maximum(1, over * scaled[order] // total))
            cut[np.cumsum(cut) > over] = 0
            if not cut.any():
                cut[0] = min(over, scaled[order[0]] - 1)
            scaled[order] -= cut
            over -= int(cut.sum())
        return cls(symbols.astype(np.uint32), scaled.astype(np.uint32))

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.frequencies, dtype=np.uint32) - self.frequencies

    def pack(self) -> bytes:
        return zlib.compress(np.diff(self.symbols, prepend=0).astype("<u4").tobytes() + self.frequencies.astype("<u4").tobytes())

    @classmethod
    def unpack(cls, data: bytes) -> Table:
        both = np.frombuffer(zlib.decompress(data), "<u4")
        half = len(both) // 2
        return cls(np.cumsum(both[:half], dtype=np.uint32), both[half:].copy())


@dataclass
class Block:
    """Coded ids with the states at every checkpoint; `places[i]` words come before checkpoint i."""

    words: np.ndarray
    states: np.ndarray
    places: np.ndarray
    n_ids: int


def encode_block(ids: np.ndarray, table: Table) -> Block:
    index = np.zeros(int(table.symbols[-1]) + 1, np.int64)
    index[table.symbols] = np.arange(len(table.symbols))
    rank = index[ids]
    frequencies, starts = table.frequencies.astype(np.uint64)[rank], table.starts.astype(np.uint64)[rank]
    steps = -(-len(ids) // LANES)
    state = np.full(LANES, _LOW, np.uint64)
    parts: list[np.ndarray] = []  # words in the order of writing, the reverse of reading
    written, states, places = 0, [], []
    shift, bits = np.uint64(63 - TABLE_BITS), np.uint64(TABLE_BITS)
    for step in range(steps - 1, -1, -1):
        f = frequencies[step * LANES : (step + 1) * LANES]
        x = state[: len(f)]
        full = np.flatnonzero(x >= f << shift)
        if len(full):
            out = x[full]
            x[full] = out >> np.uint64(32)
            parts.append(out.astype("<u4"))  # the low half
            written += len(out)
        quotient = x // f
        state[: len(f)] = (quotient << bits) + (x - quotient * f) + starts[step * LANES : (step + 1) * LANES]
        if step % STEPS == 0:
            states.append(state.copy())
            places.append(written)
    words = np.concatenate(parts[::-1]) if parts else np.empty(0, "<u4")
    return Block(words, np.array(states[::-1], np.uint64), written - np.array(places[::-1], np.int64), len(ids))


def decode_block(block: Block, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """Ids `first` to `last` of a block, from the checkpoint before `first`."""
    last = block.n_ids if last is None else min(last, block.n_ids)
    if first >= last:
        return np.empty(0, np.uint32)
    at = first // (LANES * STEPS)
    begin = at * LANES * STEPS
    out = np.empty(last - begin, np.uint32)
    slots = np.repeat(np.arange(len(table.symbols), dtype=np.uint32), table.frequencies)
    s_slot = table.symbols[slots]
    back = np.arange(1 << TABLE_BITS, dtype=np.uint64) - table.starts.astype(np.uint64)[slots]
    both = (table.frequencies.astype(np.uint64)[slots] << np.uint64(32)) | back  # one look-up for two numbers
    mask, bits, half, low = np.uint64((1 << TABLE_BITS) - 1), np.uint64(TABLE_BITS), np.uint64(32), np.uint64(0xFFFFFFFF)
    state, place, words = block.states[at].copy(), int(block.places[at]), block.words.astype(np.uint64)
    for here in range(begin, last, LANES):
        width = min(LANES, block.n_ids - here)
        x = state[:width]
        slot = (x & mask).astype(np.int64)
        take = min(width, last - here)
        out[here - begin : here - begin + take] = s_slot[slot[:take]]
        found = both[slot]
        x = (found >> half) * (x >> bits) + (found & low)
        empty = np.flatnonzero(x < _LOW)
        if len(empty):
            x[empty] = (x[empty] << half) | words[place : place + len(empty)]
            place += len(empty)
        state[:width] = x
    return out[first - begin :]


def pack_file(ids: np.ndarray, doc_ids: list, lengths: np.ndarray) -> tuple[bytes, list[tuple[int, int, int]]]:
    """A file of documents and, per block: its first document, its documents, its ids."""
    table = Table.count(ids)
    packed = table.pack()
    body = io.BytesIO()
    body.write(MAGIC + packed)
    ends = np.cumsum(lengths)
    head, states, places, listed = [], [], [], []
    doc, begin = 0, 0
    while doc < len(doc_ids):
        stop = min(int(np.searchsorted(ends, begin + BLOCK_IDS, side="left")) + 1, len(doc_ids))
        block = encode_block(ids[begin : int(ends[stop - 1])], table)
        data = block.words.astype("<u4").tobytes()
        head.append((body.tell(), len(data), zlib.crc32(data), block.n_ids, doc, stop - doc))
        states.append(block.states.astype("<u8").tobytes())
        places.append(block.places)
        body.write(data)
        listed.append((doc, stop - doc, block.n_ids))
        doc, begin = stop, int(ends[stop - 1])
    known = np.array([d is not None for d in doc_ids], np.uint8)
    footer = io.BytesIO()
    footer.write(struct.pack("<IIII", len(head), len(doc_ids), LANES, STEPS))
    footer.write(np.array(head, "<i8").tobytes())
    footer.write(known.tobytes())
    footer.write(np.array([d or 0 for d in doc_ids], "<i8").tobytes())
    footer.write(lengths.astype("<i8").tobytes())
    footer.write(np.concatenate(places).astype("<i8").tobytes())
    footer.write(b"".join(states))
    closing = struct.pack("<I", zlib.crc32(packed)) + footer.getvalue()
    closing = zlib.compress(closing, 1)
    at = body.tell()
    body.write(closing)
    body.write(struct.pack("<QII", at, len(packed), zlib.crc32(closing)) + MAGIC)
    return body.getvalue(), listed


class Reader:
    """Reads blocks of a file; `fetch(start, length)` gives bytes, negative starts count from the end."""

    def __init__(self, fetch: Callable[[int, int | None], bytes]):
        self.fetch = fetch
        tail = fetch(-20, 20)
        if tail[-4:] != MAGIC:
            raise ValueError("not a token file, or cut short")
        at, table_length, crc = struct.unpack("<QII", tail[:16])
        closing = fetch(at, None)[:-20]
        if zlib.crc32(closing) != crc:
            raise ValueError("the footer's checksum differs")
        closing = zlib.decompress(closing)
        (table_crc,) = struct.unpack_from("<I", closing)
        packed = fetch(4, table_length)
        if zlib.crc32(packed) != table_crc:
            raise ValueError("the table's checksum differs")
        self.table = Table.unpack(packed)
        n_blocks, n_docs, self.lanes, self.steps = struct.unpack_from("<IIII", closing, 4)
        if (self.lanes, self.steps) != (LANES, STEPS):
            raise ValueError("other numbers of lanes or steps")
        at = 20

        def take(dtype: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(closing, dtype, n, at)
            at += found.nbytes
            return found

        self.blocks = take("<i8", 6 * n_blocks).reshape(-1, 6)
        known = take("u1", n_docs)
        self.doc_ids = [int(d) if k else None for d, k in zip(take("<i8", n_docs), known)]
        self.lengths = take("<i8", n_docs)
        marks = -(-self.blocks[:, 3] // (LANES * STEPS))
        self.marks = np.concatenate(([0], np.cumsum(marks)))
        self.places = take("<i8", int(self.marks[-1]))
        self.states = take("<u8", int(self.marks[-1]) * LANES).reshape(-1, LANES)

    def block(self, number: int) -> Block:
        start, length, crc, n_ids, _, _ = (int(v) for v in self.blocks[number])
        data = self.fetch(start, length)
        if zlib.crc32(data) != crc:
            raise ValueError(f"the checksum of block {number} differs")
        own = slice(int(self.marks[number]), int(self.marks[number + 1]))
        return Block(np.frombuffer(data, "<u4"), self.states[own], self.places[own], n_ids)

    def documents(self, number: int) -> Iterator[tuple[int | None, np.ndarray]]:
        """(id, token ids) of the documents of one block."""
        ids = decode_block(self.block(number), self.table)
        first, n = int(self.blocks[number, 4]), int(self.blocks[number, 5])
        at = 0
        for i in range(first, first + n):
            yield self.doc_ids[i], ids[at : at + int(self.lengths[i])]
            at += int(self.lengths[i])


def write_tokens(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> tuple[str, DataFrame]:
    """Write the ids of all texts in ascending order of id; gives the folder and its list of blocks.

    The list (part, file_no, file, block, n_docs, n_ids) has a row per block, in the order of its first
    three columns and `block`. A null text is empty; every document ends with id 0. Null ids
    come first; rows of one id follow each other, in the order of their texts. A task
    holds one file's ids at a time. No rows give no files.
    """
    folder = new_folder(docs.sparkSession, "tokens")
    parts = parts_for(docs)
    cuts = boundaries(docs, id_col, parts)
    rows = docs.select(
        bucket(col(id_col), cuts).alias("part"), col(id_col).cast("long").alias("id"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    )

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, lengths, doc_ids, size, part, number = [], [], [], 0, 0, 0

        def close() -> pa.RecordBatch:
            nonlocal ids, lengths, doc_ids, size, number
            data, listed = pack_file(np.concatenate(ids), doc_ids, np.concatenate(lengths))
            name = write_file(folder, f"part-{part:06d}-{number:05d}.rtk", data)
            made = [(part, number, name, k, n, total) for k, (_, n, total) in enumerate(listed)]
            ids, lengths, doc_ids, size, number = [], [], [], 0, number + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*made)], ["part", "file_no", "file", "block", "n_docs", "n_ids"]
            )

        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS):
                some = batch.slice(at, _TEXTS)
                part = some.column(0)[0].as_py()
                found, n = encoder(tokenizer).encode(some.column(2).to_pylist())
                closed = np.insert(found, np.cumsum(n), END_ID)
                ids.append(closed.astype(np.uint32))
                lengths.append(n + 1)
                doc_ids += some.column(1).to_pylist()
                size += len(closed)
                if size >= FILE_IDS:
                    yield close()
        if size:
            yield close()

    dealt = rows.repartitionById(len(cuts) + 1, F.col("part").cast("int")).sortWithinPartitions("id", "text")
    schema = "part int, file_no long, file string, block long, n_docs long, n_ids long"
    listed = map_arrow(dealt, lambda b: (r.cast(_BLOCKS) for r in files(b)), schema)
    return folder, stored(listed, "token-blocks")


_BLOCKS = pa.schema([
    ("part", pa.int32()), ("file_no", pa.int64()), ("file", pa.string()),
    ("block", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
])


def read_tokens(folder: str, blocks: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of all documents, decoded from the files.

    `start` counts the ids of all documents before it. Blocks are decoded apart, by
    as many tasks as there are; the driver sees none. Offsets are running sums: of
    blocks within a part, and of the parts' totals, which are as few as the parts.
    """
    in_part = Window.partitionBy("part").orderBy("file_no", "block").rowsBetween(Window.unboundedPreceding, -1)
    over_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocks.groupBy("part").agg(F.sum("n_ids").alias("total"))
    bases = totals.select("part", F.coalesce(F.sum("total").over(over_parts), F.lit(0)).alias("base"))
    placed = blocks.withColumn("inside", F.coalesce(F.sum("n_ids").over(in_part), F.lit(0))).join(bases, "part")
    tasks = placed.select("file", "block", (F.col("base") + F.col("inside")).alias("start"))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, opened = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if row["file"] != opened:
                    opened = row["file"]
                    reader = Reader(lambda start, length, name=opened: read_range(folder, name, start, length))
                out, start = [], row["start"]
                for doc_id, ids in reader.documents(row["block"]):
                    out.append((doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    start += len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out)], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    n = parts_for(blocks)
    dealt = tasks.repartition(n, "file").sortWithinPartitions("file", "block")
    return map_arrow(dealt, decode, "doc_id long, start long, n_tokens long, ids_crc32 long")
