"""Phrases of two and three words whose words keep together, mined by SON partitioning.

The input's partitions are dealt to SHARDS shards. A phrase with the asked support in the
whole has at least the SHARDS-th part of it in one of the shards, so every shard is mined
completely at that lower support: word pairs first, then those triples of which both pairs
were frequent. What any shard found is counted once more over all texts, as words and not
as hashes, so counts are exact. A shard is as many tasks as it has partitions; each of
them adds up long runs of text before its counts are shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.common import col, filesystem, map_arrow, new_folder, stored

SUPPORT = 10
SHARDS = 4
TOP = 2000
#: A phrase is dropped for a longer one that has at least this percentage of its occurrences.
DROP_PERCENT = 50
UNDETERMINED = "und"
#: Words that a task counts at once; texts are cut to so many bytes at a blank.
CHUNK, SLICE = 3 << 18, 1 << 19
#: A filter has a 64-bit word for every four keys, and no more than this many (32 MB). Beyond
#: that more phrases pass that no shard found; they are counted too and fall to the support.
MOST_WORDS = 1 << 22
#: Parts of a language's list that are ranked on their own first.
PARTS = 512

_BREAK = b"."
#: A-Z to lower case, every mark between pieces to a full stop, a tab to a blank.
_FOLD = bytes.maketrans(
    bytes(range(65, 91)) + b".,;:!?\n\x0b\x0c\r\t", bytes(range(97, 123)) + _BREAK * 10 + b" "
)
_BITS = 20  # of a word's number; a chunk has fewer words
_SHARD = np.uint64(SHARDS - 1)


class _Numbers(dict):
    """Numbers of the words of one language, given as they come; the list of all words grows with it."""

    def __init__(self, lang: str, words: list[tuple[str, bytes]]):
        super().__init__({_BREAK: 0})
        self.lang, self.words = lang, words

    def __missing__(self, word: bytes) -> int:
        self.words.append((self.lang, word))
        self[word] = number = len(self.words)
        return number


def _slices(text: str) -> Iterator[list[bytes]]:
    """The words of a text and a `.` for every mark between pieces, some thousands at a time."""
    raw, at = text.encode("utf-8", "surrogatepass").translate(_FOLD), 0
    while at < len(raw):
        end = len(raw)
        if end - at > SLICE and (cut := re.compile(rb"[ .]").search(raw, at + SLICE)):
            end = cut.start()
        yield raw[at:end].replace(_BREAK, b" . ").split()
        at = end


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[tuple[str, bytes]], np.ndarray, int]]:
    """(words, numbers, repeated): runs of texts as numbers of words from 1, with 0 between pieces and texts.

    A text that goes on in the next chunk repeats its last two words there, which are not to be counted again.
    """
    words: list[tuple[str, bytes]] = []
    tables: dict[str, _Numbers] = {}
    parts: list[np.ndarray] = []
    total = repeated = 0
    for batch in batches:
        for i in range(batch.num_rows):
            lang, text = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
            for tokens in _slices(text):
                table = tables.get(lang) or tables.setdefault(lang, _Numbers(lang, words))
                parts.append(np.fromiter(map(table.__getitem__, tokens), np.int64, len(tokens)))
                total += len(tokens)
                if total >= CHUNK:
                    ids = np.concatenate(parts)
                    yield words, ids, repeated
                    last = [words[n - 1][1] if n else _BREAK for n in ids[-2:].tolist()]
                    words, tables = [], {}
                    table = tables.setdefault(lang, _Numbers(lang, words))
                    parts = [np.array([table[w] for w in last], np.int64)]
                    total = repeated = len(last)
            parts.append(np.zeros(1, np.int64))
            total += 1
    if total:
        yield words, np.concatenate(parts), repeated


def _grams(ids: np.ndarray, n: int, repeated: int) -> tuple[np.ndarray, np.ndarray]:
    """(k, n) numbers of the words of every distinct run of n words, and its occurrences."""
    size = max(0, len(ids) - n + 1)
    cols = [ids[i : i + size] for i in range(n)]
    found = np.logical_and.reduce([c > 0 for c in cols])
    found[: max(0, repeated - n + 1)] = False
    packed = np.zeros(int(found.sum()), np.int64)
    for c in cols:
        packed = packed << _BITS | c[found]
    distinct, counts = np.unique(packed, return_counts=True)
    mask = (1 << _BITS) - 1
    return np.stack([distinct >> _BITS * (n - 1 - i) & mask for i in range(n)], axis=1), counts


def _mixed(h: np.ndarray) -> np.ndarray:
    """Hashes with every bit spread over all (fixed multipliers of a public 64-bit finaliser)."""
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def _word_hashes(words: list[tuple[str, bytes]]) -> np.ndarray:
    """Hash of language and word by number; number 0 is no word."""
    own = [xxhash.xxh64_intdigest(lang.encode() + b"\0" + word) for lang, word in words]
    return np.array([0, *own], np.uint64)


def _gram_hashes(hashes: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Hash of each row's words in their order, with the bits of the shard left clear."""
    out = np.zeros(len(grams), np.uint64)
    for c in grams.T:
        out = _mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[c])
    return out & ~_SHARD


@lru_cache(maxsize=2)
def _filter(folder: str, size: int) -> np.ndarray:
    """The words of a filter; a worker reads it once."""
    fs, path = filesystem(folder)
    rows = pq.read_table(path, columns=["at", "bits"], filesystem=fs)
    out = np.zeros(size, np.uint64)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def _in_filter(bloom: tuple[str, int], hashes: np.ndarray) -> np.ndarray:
    """Whether the filter may hold the hashes; never False for one that it holds."""
    one, low = np.uint64(1), np.uint64(63)
    bits = np.zeros(len(hashes), np.uint64)
    for shift in (36, 43, 50, 57):
        bits |= one << (hashes >> np.uint64(shift) & low)
    return _filter(*bloom)[(hashes >> np.uint64(2)) & np.uint64(bloom[1] - 1)] & bits == bits


def _bloom(keys: DataFrame) -> tuple[str, int]:
    """A filter of the longs in column `key`, as a table in the shared folder: its place and number of words."""
    many = keys.count()
    size = min(MOST_WORDS, 1 << max(6, (many // 4).bit_length()))
    bit = "shiftleft(1L, cast(shiftrightunsigned(key, {}) & 63 AS INT))"
    bits = " | ".join(bit.format(shift) for shift in (36, 43, 50, 57))
    folder = new_folder(keys.sparkSession, "collocations-filter")
    keys.groupBy(F.expr(f"shiftrightunsigned(key, 2) & {size - 1}L").alias("at")).agg(
        F.bit_or(F.expr(bits)).alias("bits")
    ).write.parquet(folder)
    return folder, size


def _counted(batches: Iterator[pa.RecordBatch], n: int, bloom: tuple[str, int] | None) -> Iterator[pa.RecordBatch]:
    """(key, n) of every run of n words of each chunk; the key is a hash and the shard in its last bits.

    Runs of three words count only if the filter may hold both their pairs.
    """
    shard = np.uint64(TaskContext.get().partitionId() % SHARDS)
    for words, ids, repeated in _chunks(batches):
        hashes = _word_hashes(words)
        grams, counts = _grams(ids, n, repeated)
        if bloom:
            may = _in_filter(bloom, _gram_hashes(hashes, grams[:, :2]))
            may[may] = _in_filter(bloom, _gram_hashes(hashes, grams[may, 1:]))
            grams, counts = grams[may], counts[may]
        keys = _gram_hashes(hashes, grams) | shard
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["key", "n"])


def _spelled(batches: Iterator[pa.RecordBatch], blooms: dict[int, tuple[str, int]]) -> Iterator[pa.RecordBatch]:
    """(lang, phrase, n) per chunk: every word, the runs that a filter may hold, and all words under an empty phrase."""
    for words, ids, repeated in _chunks(batches):
        hashes = _word_hashes(words)
        langs, phrases, counts = [], [], []
        tally = np.bincount(ids[repeated:], minlength=len(words) + 1)[1:]
        by_lang: dict[str, int] = {}
        for (lang, word), n in zip(words, tally.tolist()):
            langs.append(lang)
            phrases.append(word)
            by_lang[lang] = by_lang.get(lang, 0) + n
        langs += by_lang
        phrases += [b""] * len(by_lang)
        counts.append(np.concatenate([tally, np.array(list(by_lang.values()), np.int64)]))
        for n, bloom in blooms.items():
            grams, many = _grams(ids, n, repeated)
            may = _in_filter(bloom, _gram_hashes(hashes, grams))
            counts.append(many[may])
            for row in grams[may].tolist():
                langs.append(words[row[0] - 1][0])
                phrases.append(b" ".join([words[w - 1][1] for w in row]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(phrases, pa.binary()), pa.array(np.concatenate(counts), pa.int64())],
            ["lang", "phrase", "n"],
        )


def _mined(texts: DataFrame, support: int, n: int, bloom: tuple[str, int] | None = None) -> DataFrame:
    """(key) of the runs of n words that reach the lowered support in a shard and may have the support in all."""
    found = map_arrow(texts, partial(_counted, n=n, bloom=bloom), "key bigint, n bigint")
    local = -(-support // SHARDS)
    frequent = found.groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= local)
    # In every other shard there are less than `local`, so some are known to miss the support.
    most = F.sum("n") + (SHARDS - F.count("*")) * (local - 1)
    united = frequent.groupBy(F.expr(f"key & ~{SHARDS - 1}L").alias("key")).agg(most.alias("most"))
    return stored(united.filter(F.col("most") >= support).select("key"), f"collocations-{n}")


def phrase_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT) -> DataFrame:
    """(lang, phrase, words, f): exact occurrences of all words, and of all runs of two or three with the support.

    The row of a language with an empty phrase (words 0) counts all its words. A null
    text is empty, a null language `und`; rows count as often as they occur; no words
    give no rows.
    """
    texts = docs.select(
        F.coalesce(col(lang_col).cast("string"), F.lit(UNDETERMINED)).alias("lang"),
        F.coalesce(col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    pairs = _bloom(_mined(texts, support, 2))
    blooms = {2: pairs, 3: _bloom(_mined(texts, support, 3, pairs))}
    found = map_arrow(texts, partial(_spelled, blooms=blooms), "lang string, phrase binary, n bigint")
    summed = found.groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("n").alias("f"))
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    counted = summed.select("lang", "phrase", words.alias("words"), "f")
    return stored(counted.filter((F.col("f") >= support) | (F.col("words") == 0)), "collocations-counts")


def _joined(words: Column, start: Column | int, many: Column | int) -> Column:
    return F.array_join(F.slice(words, start, many), " ")


def collocations(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", support: int = SUPPORT,
    top: int = TOP, drop_percent: int = DROP_PERCENT,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's best phrases of two or three words.

    Texts are lower-cased (A-Z) and cut into pieces at `.,;:!?` and ends of lines and into
    words at blanks and tabs. a, l and r are the occurrences of a phrase, of the words
    before and of those after its worst cut; the score is a * a * 1000000 / (l * r),
    rounded down, and of cuts with equal scores the first counts. A phrase is dropped if a
    longer one with the support holds it and has `drop_percent` of its occurrences. Ties
    are ranked by a, then by the phrase's bytes. Null texts are empty, null languages
    `und`, repeated rows count each time, texts of any length are whole, and no rows give none.
    """
    counts = phrase_counts(docs, text_col, lang_col, support)
    split = F.split("phrase", " ")
    candidates = counts.filter("words >= 2").select("lang", "phrase", "words", F.col("f").alias("a"))

    at, size = F.col("at"), F.col("size")
    longer = (
        candidates.filter("words > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
        .withColumn("at", F.explode(F.sequence(F.lit(1), F.col("words") - size + 1)))
        .groupBy("lang", _joined(split, at, size).alias("phrase")).agg(F.max("a").alias("most"))
    )
    kept = candidates.join(longer, ["lang", "phrase"], "left").filter(
        F.col("most").isNull() | (100 * F.col("most") < drop_percent * F.col("a"))
    )

    part = counts.filter("words >= 1").select("lang", F.col("phrase").alias("part"), "f")
    cuts = kept.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).select(
        "lang", "phrase", "a", "k",
        _joined(split, 1, F.col("k")).alias("first"), _joined(split, F.col("k") + 1, F.col("words") - F.col("k")).alias("rest"),
    )
    cuts = cuts.join(part.select("lang", F.col("part").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cuts = cuts.join(part.select("lang", F.col("part").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    exact = {c: f"CAST({c} AS DECIMAL(13, 0))" for c in "alr"}
    score = F.expr(f"(CAST(1000000 AS DECIMAL(7, 0)) * ({exact['a']} * {exact['a']})) div ({exact['l']} * {exact['r']})")
    worst = cuts.withColumn("score", score).groupBy("lang", "phrase", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("worst")
    ).select("lang", "phrase", "a", "worst.score", "worst.l", "worst.r")

    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    deal = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    place = F.row_number().over(Window.partitionBy("lang", "deal").orderBy(*best))
    few = worst.withColumn("deal", deal).withColumn("place", place).filter(F.col("place") <= top)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best))
    ranked = few.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top)
    totals = counts.filter("words = 0").select("lang", F.col("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
