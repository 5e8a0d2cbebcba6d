import zlib

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from gridpulse.llm import queries, rans
from gridpulse.llm.common import read_range
from gridpulse.llm.rans import LANES, STEPS, Reader, Table, decode_block, encode_block, pack_file

PATH = path("byte_bpe_50k.json")


@pytest.mark.parametrize("n", [1, 7, LANES, LANES + 1, LANES * STEPS * 2 + 5])
def test_round_trip_and_checkpoints(n):
    ids = np.minimum(np.random.default_rng(n).zipf(1.3, n), 50256).astype(np.uint32)
    table = Table.count(ids)
    assert table.frequencies.sum() == 1 << rans.TABLE_BITS and (table.frequencies > 0).all()
    block = encode_block(ids, table)
    assert (decode_block(block, table) == ids).all()
    for first in (0, n // 2, n - 1):  # from the checkpoint before
        assert (decode_block(block, table, first, first + 3) == ids[first : first + 3]).all()


def test_size_is_near_the_entropy():
    ids = np.minimum(np.random.default_rng(5).geometric(0.01, 400_000), 5000).astype(np.uint32)
    p = np.bincount(ids) / len(ids)
    bits = -(p[p > 0] * np.log2(p[p > 0])).sum()
    assert encode_block(ids, Table.count(ids)).words.nbytes * 8 < 1.01 * bits * len(ids)


def open_bytes(data):
    return Reader(lambda start, n: data[start:][:n] if n is not None else data[start:])


def test_file_and_damage():
    lengths = np.array([3, 1, rans.BLOCK_IDS + 10, 2])
    ids = np.arange(lengths.sum(), dtype=np.uint32) % 977
    data, listed = pack_file(ids, [5, None, 9, 9], lengths)
    assert [b[1] for b in listed] == [3, 1]
    read = [d for k in range(2) for d in open_bytes(data).documents(k)]
    assert [d for d, _ in read] == [5, None, 9, 9]
    assert (np.concatenate([i for _, i in read]) == ids).all()
    reader = open_bytes(data)
    for place in (10, int(reader.blocks[0, 0]) + 4, len(data) - 40, len(data) - 2):
        broken = bytearray(data)
        broken[place] ^= 1
        with pytest.raises(ValueError):
            list(open_bytes(bytes(broken)).documents(0))


def plain(docs):
    encode = Tokenizer.from_file(PATH).encode
    start, out = 0, []
    for i, text in docs:
        ids = np.array(encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        out.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_order_nulls_and_repeats(documents, spark):
    docs = documents("b", None, "", "word " * 3000, first=4).union(documents("a", "b", "b"))
    docs = docs.union(spark.createDataFrame([(None, "z", None, None, None, None), (2, "a", None, None, None, None)], docs.schema))
    folder, blocks = rans.write_tokens(docs, PATH)
    rows = [tuple(r) for r in rans.read_tokens(folder, blocks).collect()]
    rows.sort(key=lambda r: r[1])
    order = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    assert rows == plain(order)
    name = blocks.first().file
    assert read_range(folder, name, -4, 4) == rans.MAGIC


def test_empty(documents):
    folder, blocks = rans.write_tokens(documents("x").limit(0), PATH)
    assert rans.read_tokens(folder, blocks).count() == 0


def test_query(spark, small):
    docs = sorted(tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    rows = queries.QUERIES["op6_rans_tokens"](spark, small).collect()
    assert sorted(tuple(r) for r in rows) == plain(docs)
