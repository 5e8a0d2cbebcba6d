"""Near duplicates by SimHash: fingerprints that differ in few bits, found through Golay codewords.

The binary Golay code of length 23 is perfect: every 23-bit word lies within three
bits of exactly one of its 4096 codewords. A 64-bit fingerprint is cut into segments
of 23, 23 and 18 bits. If two fingerprints differ in at most three bits, no two
segments can both differ in two or more, so at least two segments differ in at most
one bit each. For words that differ in at most one bit, the codeword of the one is
among the codewords of the other and of all its neighbours at one bit, of which there
are one or six. So for each of the three pairs of segments a fingerprint looks under
the one pair of its own codewords and is filed under every pair of its neighbours'
codewords; each match is checked on all 64 bits. No link is missed.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import col, fresh, map_batches, stored
from gridpulse.llm.components import components

SEED = 42
#: First bit and width of each segment.
SEGMENTS = ((0, 23), (23, 23), (46, 18))
MOST_BITS = 3
#: Generator polynomial of the Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1 (fixed value).
GOLAY = 0b101011100011

_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Shingles whose bits are counted at once.
_CHUNK = 1 << 16


def words_of(text: str) -> tuple[bytes, list[int], list[int]]:
    """The words of a text, A-Z lower-cased and a blank between them, and where each begins and ends."""
    tokens = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    ends = np.cumsum([len(t) + 1 for t in tokens], dtype=np.int64) - 1
    starts = np.concatenate(([0], ends[:-1] + 1)) if tokens else ends
    return b" ".join(tokens), starts.tolist(), ends.tolist()


def fingerprint(text: str, words: int = 3) -> int:
    """64-bit SimHash of a text as an unsigned number; 0 without a word.

    A-Z are lower-cased; words are what stands between blanks (space, tab to carriage
    return); every run of `words` words, repeats included, votes with the bits of its
    XXH64. Fewer words than that vote once as a whole.
    """
    joined, starts, ends = words_of(text)
    if not ends:
        return 0
    last = ends[min(words, len(ends)) - 1 :]
    hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts, last)], "<u8")
    votes = np.zeros(64, np.int64)
    for i in range(0, len(hashes), _CHUNK):
        part = hashes[i : i + _CHUNK].view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fingerprint) of every row; the fingerprint is a long with the same 64 bits.

    A null text counts as empty and has fingerprint 0. Rows are not joined or
    grouped, so repeated rows and null ids each give their own row.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t or "", words) for t in batch.column(1).to_pylist()], "<u8")
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view("<i8"))], ["id", "fingerprint"])

    picked = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    return map_batches(picked, each, f"id {id_type}, fingerprint bigint")


@lru_cache(maxsize=1)
def _leaders() -> np.ndarray:
    """Error pattern of each of the 2048 syndromes."""
    errors = np.array([sum(1 << i for i in c) for n in range(4) for c in combinations(range(23), n)], np.int64)
    table = np.zeros(2048, np.int64)
    table[_syndrome(errors)] = errors
    return table


def _syndrome(words: np.ndarray) -> np.ndarray:
    """Remainder of the words, as polynomials, by the generator."""
    rest = words.copy()
    for bit in range(22, 10, -1):
        rest ^= np.where(rest >> bit & 1, GOLAY << (bit - 11), 0)
    return rest


def codewords(words: np.ndarray) -> np.ndarray:
    """Number (0 to 4095) of the codeword nearest to each 23-bit word."""
    return (words ^ _leaders()[_syndrome(words)]) >> 11


def neighbour_codewords(words: np.ndarray, width: int) -> np.ndarray:
    """(n, width + 1) codeword numbers: of the words and of their one-bit neighbours; repeats are -1."""
    around = words[:, None] ^ np.concatenate(([0], 1 << np.arange(width)))[None, :]
    found = np.sort(codewords(around.ravel()).reshape(around.shape), axis=1)
    found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
    return found


def _segments(prints: np.ndarray) -> list[np.ndarray]:
    bits = prints.astype("<i8").view("<u8")
    return [((bits >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]


def _pairs() -> list[tuple[int, int, int]]:
    return [(n, i, j) for n, (i, j) in enumerate(combinations(range(len(SEGMENTS)), 2))]


def _look_keys(batch: pa.RecordBatch) -> pa.RecordBatch:
    """One key for each pair of segments: own codewords."""
    prints = batch.column(0).to_numpy()
    own = [codewords(s) for s in _segments(prints)]
    keys = np.concatenate([(n << 24) | (own[i] << 12) | own[j] for n, i, j in _pairs()])
    return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(np.tile(prints, 3))], ["key", "a"])


def _filed_keys(batch: pa.RecordBatch) -> pa.RecordBatch:
    """All keys under which a fingerprint may be looked for: its neighbours' codewords."""
    prints = batch.column(0).to_numpy()
    near = [neighbour_codewords(s, width) for s, (_, width) in zip(_segments(prints), SEGMENTS)]
    keys, owners = [], []
    for n, i, j in _pairs():
        left_row, left = np.nonzero(near[i] >= 0)
        left = near[i][left_row, left]
        counts = (near[j] >= 0).sum(axis=1)
        flat = near[j][near[j] >= 0]
        first = np.cumsum(counts) - counts
        times = counts[left_row]
        at = np.repeat(first[left_row] - (np.cumsum(times) - times), times) + np.arange(times.sum())
        keys.append((n << 24) | (np.repeat(left, times) << 12) | flat[at])
        owners.append(prints[np.repeat(left_row, times)])
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(owners))], ["key", "b"])


def close_pairs(prints: DataFrame) -> DataFrame:
    """(a, b), a < b: all pairs of the distinct longs in column `fingerprint` that differ in 1 to 3 bits.

    Keys meet by a shuffle: the planner takes each to be a row per fingerprint, though there are about 80,
    so it would send them to the driver long after they fit.
    """
    looks = map_batches(prints.select("fingerprint"), _look_keys, "key bigint, a bigint")
    filed = map_batches(prints.select("fingerprint"), _filed_keys, "key bigint, b bigint")
    differing = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    return looks.join(filed.hint("merge"), "key").filter((F.col("a") < F.col("b")) & (differing <= MOST_BITS)).select("a", "b").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """(id, fingerprint, component) of every row; component is the least id reachable.

    Rows are linked if their fingerprints differ in at most three bits, and so are
    rows linked through others. Rows of equal fingerprints are one node of the graph,
    however many they are: copies are counted in before any key is made. Null ids
    stay rows and never name a component unless all of it is null; no rows give none.
    """
    printed = stored(fingerprints(docs, id_col, text_col, words), "simhash")
    nodes = stored(printed.groupBy("fingerprint").agg(F.min("id").alias("least")), "simhash-nodes")
    linked = components(close_pairs(nodes))
    named = nodes.join(linked.select(F.col("node").alias("fingerprint"), "root"), "fingerprint", "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    named = stored(named, "simhash-roots")
    roots = named.groupBy("root").agg(F.min("least").alias("component"))
    # Components are named once per fingerprint; only then do the documents meet them.
    # No table with a row per fingerprint or document is sent to the driver: their files say little of their size in memory.
    found = named.join(roots.hint("merge"), "root").select("fingerprint", "component")
    return printed.join(found.hint("merge"), "fingerprint").select("id", "fingerprint", "component")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3) -> DataFrame:
    """The columns of `docs`, one row of each group of near duplicates: the one of the least id."""
    return least_of_groups(docs, near_duplicates(docs, id_col, text_col, words), id_col)


def least_of_groups(docs: DataFrame, found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The columns of `docs`, one row of each component of `found` (id, component): the one of the least id.

    Of rows that repeat the kept id, the one whose JSON form sorts first stays. Rows
    without an id cannot be named, so they all stay. Texts meet the ids to keep in one
    join; they are grouped only where an id repeats.
    """
    mark, many = fresh(docs, "gp_id", "gp_many")
    kept = found.filter("id = component").groupBy(F.col("id").alias(mark)).agg((F.count("*") > 1).alias(many))
    rows = docs.join(kept.hint("merge"), col(id_col) == F.col(mark))  # texts never go to the driver, however well they compress
    whole = F.struct(*[col(c) for c in docs.columns])
    once = rows.filter(F.col(many)).groupBy(mark).agg(F.min_by(whole, F.to_json(whole)).alias(many)).select(f"{many}.*")
    return (
        rows.filter(~F.col(many)).select(*[col(c) for c in docs.columns])
        .union(once).union(docs.filter(col(id_col).isNull()))
    )
