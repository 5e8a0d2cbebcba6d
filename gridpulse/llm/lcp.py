"""Document fingerprints by locally consistent parsing.

A text is parsed into phrases, the phrases into phrases of phrases, and so on to one
name for the whole. On each level runs of one name are drawn together; deterministic coin tossing
then labels every name by the lowest bit in which it differs from the one before,
again and again until few labels are left, and phrases begin where a label is higher
than both neighbours. A phrase has two to four names and begins where its near surroundings
say so, wherever it stands in the text; its name is a hash of the names in it. So equal passages have equal phrases inside,
apart from a few at their ends.

A fingerprint is the name of the whole text, then the least hashes of the names of the
LEVELS in increasing order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import col, map_arrow
from gridpulse.llm.ranges import boundaries, bucket, parts_for

#: Levels whose names are sketched (phrases of about 7, 17 and 45 characters), and how many hashes are kept.
LEVELS, KEPT = (2, 3, 4), 64
#: Characters parsed at once, whole texts at a time.
_CHUNK = 1 << 19
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd multipliers
_APART = 7  # label between two texts
_NO_ID = -(1 << 63)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a ^ (b * _B)) * _A
    h ^= h >> np.uint64(29)
    h *= _B
    return h ^ (h >> np.uint64(32))


def _tossed() -> np.ndarray:
    """Next label from a label below 128 and the one before: twice the lowest differing bit, plus that bit."""
    now, before = np.meshgrid(np.arange(128), np.arange(128), indexing="ij")
    lowest = (now ^ before) & -(now ^ before)
    place = np.where(lowest > 0, np.bitwise_count(np.maximum(lowest, 1) - 1), 0).astype(np.int64)
    return (2 * place + (now >> place & 1)).astype(np.uint8).ravel()


def _freed() -> np.ndarray:
    """Least of the labels 0, 1, 2 that neither neighbour has."""
    return np.array([min({0, 1, 2} - {a, b}) for a in range(8) for b in range(8)], np.uint8)


_TOSS, _FREE = _tossed(), _freed()


def _labels(names: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Labels 0 to 2 in which neighbours differ; texts are set apart by _APART."""
    differing = names[1:] ^ names[:-1]
    lowest = differing & (~differing + differing.dtype.type(1))
    # Names of 64 bits could be equal by chance; the last bit then stands for the difference.
    place = np.minimum(np.bitwise_count(lowest - lowest.dtype.type(1)), 63)
    label = np.empty(len(names), np.uint8)
    label[1:] = 2 * place + ((names[1:] & lowest) != 0)
    label[apart] = 0
    for _ in range(3):  # below 128, 14, 8, then 6
        index = label[1:].astype(np.uint16)
        index <<= np.uint16(7)
        index |= label[:-1]
        label[1:] = _TOSS[index]
        label[apart] = 0
    label[apart] = _APART
    for high in (5, 4, 3):
        at = np.flatnonzero(label == high)
        label[at] = _FREE[label[at - 1] * np.uint8(8) + label[at + 1]]
    return label


def _level(names: np.ndarray, apart: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """One level up: names of the phrases, and where the texts are apart. Name 0 stands between texts.

    New names are salted with the level, as a name may come up unchanged from below.
    """
    salt = np.array([level], np.uint64)
    new = np.empty(len(names), bool)
    new[0] = True
    np.not_equal(names[1:], names[:-1], out=new[1:])
    begin = np.flatnonzero(new)
    if len(begin) < len(names):
        run = np.diff(begin, append=len(names))
        names = names[begin]
        longer = np.flatnonzero(run > 1)
        wide = names.astype(np.uint64)
        wide[longer] = _mixed(_mixed(wide[longer], run[longer].astype(np.uint64)), salt)
        names, apart = wide, np.searchsorted(begin, apart)
    label = _labels(names, apart)
    first = np.zeros(len(names), bool)
    np.greater(label[1:-1], label[:-2], out=first[1:-1])
    first[1:-1] &= label[1:-1] > label[2:]
    first[apart] = True
    first[apart[:-1] + 1] = True
    begin = np.flatnonzero(first)
    size = np.diff(begin, append=len(names))
    out = names[begin].astype(np.uint64)
    more = np.flatnonzero(size > 1)
    out[more] = _mixed(out[more], salt)
    k = 1
    while len(more):
        out[more] = _mixed(out[more], names[begin[more] + k].astype(np.uint64))
        k += 1
        more = more[size[more] > k]
    out[np.flatnonzero(out == 0)] = 1
    apart = np.searchsorted(begin, apart)
    out[apart] = 0
    return out, apart


def parsed(texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Name of each whole text (0 if empty), and per text the least KEPT hashes of its names."""
    roots, sketches = np.zeros(len(texts), np.uint64), [np.empty(0, np.uint32)] * len(texts)
    full = [i for i, t in enumerate(texts) if t]
    if not full:
        return roots, sketches
    points = np.frombuffer("".join(["\0", *(x for i in full for x in (texts[i], "\0"))]).encode("utf-32-le", "surrogatepass"), np.uint32)
    apart = np.cumsum([0, *(len(texts[i]) + 1 for i in full)])
    names = points + np.uint32(1)  # a text may hold the character 0
    names[apart] = 0
    taken, level = [], 0
    while True:
        level += 1
        names, apart = _level(names, apart, level)
        if level in LEVELS:
            taken.append(_hashes(names, apart))
        if len(names) == 2 * len(full) + 1 and level >= max(LEVELS):
            break
    roots[full] = names[1::2]
    keys = np.sort(np.concatenate(taken))
    keys = keys[np.concatenate(([True], keys[1:] != keys[:-1]))]
    owner = (keys >> np.uint64(32)).astype(np.int64)
    begin = np.searchsorted(owner, np.arange(len(full) + 1))
    least = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    for k, i in enumerate(full):
        sketches[i] = least[begin[k] : min(begin[k + 1], begin[k] + KEPT)]
    return roots, sketches


def _hashes(names: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Number of the text and hash of each name, in one number."""
    counts = np.diff(apart) - 1
    inside = np.ones(len(names), bool)
    inside[apart] = False
    return (np.repeat(np.arange(len(counts), dtype=np.uint64), counts) << np.uint64(32)) | ((names[inside] * _A) >> np.uint64(32))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of two texts' phrases that are common, from their sketches: 1 for equal sets, about a half for a common half.

    The common share J of the phrases of both is estimated on the least hashes of the
    union; 2 J / (1 + J) is the share of common ones in either. Two empty texts are alike.
    """
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:KEPT]
    both = np.intersect1d(a, b, assume_unique=True)
    shared = int(np.searchsorted(both, union[-1], side="right")) / len(union)
    return 2 * shared / (1 + shared)


def fingerprint(root: int, sketch: np.ndarray) -> str:
    return f"{int(root):016x}" + sketch.astype(">u4").tobytes().hex()


def sketch_of(print_: str) -> np.ndarray:
    """The hashes in a fingerprint."""
    return np.frombuffer(bytes.fromhex(print_[16:]), ">u4").astype(np.uint32)


def edited(text: str, after: str) -> str:
    """`text` with its last half, rounded down, replaced by the first as many characters of `after`."""
    half = len(text) // 2
    return text[: len(text) - half] + after[:half]


def fingerprinted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) of every row.

    The next document is the one of the next lower id, after the lowest the one of the
    highest. A null text is empty. Rows of one id follow each other in the order of
    their texts, rows without an id come last; no rows give none. Rows are dealt by ranges of ids, and
    each range also gets the first row of the range below, so texts are shuffled once
    and a task holds a stretch of its range. Memory is in proportion to the longest text.
    """
    parts = parts_for(docs)
    cuts = boundaries(docs, id_col, parts)
    key = F.coalesce(col(id_col).cast("long"), F.lit(_NO_ID))
    number = bucket(col(id_col), cuts)
    tops = docs.select(number.alias("part"), key.alias("key")).groupBy("part").agg(F.max("key").alias("top")).collect()
    top = {r.part: r.top for r in tops}  # a row per range
    order = sorted(top)
    above = {p: order[(i + 1) % len(order)] for i, p in enumerate(order)}
    rows = docs.select(
        col(id_col).cast("long").alias("id"), F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
        key.alias("key"), number.alias("part"),
    )
    places = range(len(cuts) + 1)
    top_of = F.get(F.array(*[F.lit(top.get(p, 0)).cast("long") for p in places]), F.col("part"))
    above_of = F.get(F.array(*[F.lit(above.get(p, 0)) for p in places]), F.col("part"))
    own = F.struct(F.col("part").alias("to"), F.lit(0).alias("extra"))
    lent = F.struct(above_of.alias("to"), F.lit(1).alias("extra"))
    sent = F.explode(F.when(F.col("key") == top_of, F.array(own, lent)).otherwise(F.array(own)))
    dealt = (
        rows.select("id", "text", "key", sent.alias("sent")).select("id", "text", "key", "sent.to", "sent.extra")
        .repartitionById(len(cuts) + 1, F.col("to"))
        .sortWithinPartitions("extra", F.col("key").desc(), "text").select("id", "text", "extra")
    )
    schema = (
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return map_arrow(dealt, _stretches, schema)


_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in descending order, then the row after them; all but the last get a result."""
    ids: list[int | None] = []
    texts: list[str] = []
    size = 0
    for batch in batches:
        for doc_id, text, extra in zip(*(c.to_pylist() for c in batch.columns)):
            ids.append(doc_id)
            texts.append(text)
            size += len(text)
            if extra:  # the first of them ends the range
                yield _results(ids, texts)
                return
            if size >= _CHUNK and len(texts) > 1:
                yield _results(ids, texts)
                ids, texts, size = ids[-1:], texts[-1:], len(text)


def _results(ids: list[int | None], texts: list[str]) -> pa.RecordBatch:
    """For each text but the last, which is only the next of the one before."""
    n = len(texts) - 1
    changed = [edited(a, b) for a, b in zip(texts, texts[1:])]
    roots, sketches = parsed(texts + changed)
    prints = [fingerprint(r, s) for r, s in zip(roots, sketches)]
    rows = [
        (ids[i], len(texts[i]), hashlib.sha256(changed[i].encode("utf-8", "surrogatepass")).hexdigest(), prints[i], prints[n + 1 + i],
         likeness(sketches[i], sketches[n + 1 + i]), likeness(sketches[i], sketches[i + 1]))
        for i in range(n)
    ]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(_SCHEMA.types)], schema=_SCHEMA)
