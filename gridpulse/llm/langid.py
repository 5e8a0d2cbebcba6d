"""Language of whole texts by interpolated Kneser-Ney models over characters.

A text is seen as its letters in lower case, with one boundary for every run of other
characters. Each language has a model of the last ORDER symbols, held in sorted arrays
of hashes. A text has the language whose model gives the lowest cross-entropy per symbol.
It is rejected where that is higher than the language's own texts have it, or where the
calibrated probability of the language is below a half.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.llm.common import col, fresh, map_arrow, stored

ORDER = 4
#: About so many labelled documents of each language are learned from; every fifth of them calibrates.
SAMPLE_DOCS = 1500
#: Of the calibrating documents, so many at most are over the highest cross-entropy of a language.
MOST_REJECTED = 0.0005
#: In spreads (of a language's cost per symbol): what is added to that, so other styles of it pass, and how far
#: from the median a document still tells of the language.
MARGIN, FAR = 0.75, 0.25
#: Share of the calibrating documents that may be further out than that.
FEW = 0.02
LEAST_SPREAD = 0.5
UNDETERMINED = "und"
#: Symbols scored at once.
_CHUNK = 1 << 18
_MIX = np.uint64(0x9E3779B97F4A7C15)  # odd, so that the hash of a packed n-gram is one to one
_ASTRAL = 0xFFFF


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Symbol of each code point below 2 ** 16: its lower case if a letter, else 0."""
    table = np.zeros(1 << 16, np.uint16)
    for c in range(1 << 16):
        if chr(c).isalpha():
            low = chr(c).lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, each after ORDER - 1 boundaries, and where each text begins among them."""
    points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le"), np.uint32)
    found = _letters()[np.minimum(points, _ASTRAL)]
    for i in np.flatnonzero(points >= 1 << 16).tolist():
        found[i] = _ASTRAL if chr(points[i]).isalpha() else 0
    kept = found != 0
    kept[1:] |= kept[:-1] & (found[1:] == 0)  # the first of other characters after a letter
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    counts = np.concatenate(([0], np.cumsum(kept)))[bounds]
    pad = ORDER - 1
    starts = counts + pad * np.arange(len(texts) + 1)
    out = np.zeros(int(counts[-1]) + pad * len(texts), np.uint16)
    owner = np.repeat(np.arange(len(texts)), np.diff(counts))
    out[np.arange(int(counts[-1])) + pad * (owner + 1)] = found[kept]
    return out, starts


def packed(stream: np.ndarray, first: int, last: int) -> np.ndarray:
    """The ORDER symbols that end at each of the places first to last, in one number each."""
    out = stream[first:last].astype(np.uint64)
    for back in range(1, ORDER):
        out |= stream[first - back : last - back].astype(np.uint64) << np.uint64(16 * back)
    return out


def _lookup(hashes: np.ndarray, values: np.ndarray, keys: np.ndarray, missing: float) -> np.ndarray:
    if not len(hashes):
        return np.full(len(keys), missing, np.float64)
    asked = keys * _MIX
    at = np.minimum(np.searchsorted(hashes, asked), len(hashes) - 1)
    return np.where(hashes[at] == asked, values[at], missing)


def _sorted(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes = keys * _MIX
    order = np.argsort(hashes)
    return hashes[order], values[order]


def _low(keys: np.ndarray, order: int) -> np.ndarray:
    """The last `order` symbols of packed n-grams."""
    return keys & np.uint64((1 << 16 * order) - 1)


@dataclass
class Model:
    """A language: per order, discounted shares of n-grams and what is left for each context."""

    shares: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    left: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)
    floor: float = 0.0

    @classmethod
    def fit(cls, keys: np.ndarray, counts: np.ndarray, alphabet: int) -> Model:
        """From the packed n-grams of the highest order and their counts.

        Lower orders count the different symbols that an n-gram follows.
        """
        shares, left, floor = [], [], 0.0
        counts = counts.astype(np.float64)
        for order in range(ORDER, 0, -1):
            once, twice = int((counts == 1).sum()), int((counts == 2).sum())
            discount = once / (once + 2 * twice) if once else 0.5
            contexts, at = np.unique(keys >> np.uint64(16), return_inverse=True)
            total, kinds = np.bincount(at, counts), np.bincount(at)
            shares.append(_sorted(keys, np.maximum(counts - discount, 0) / total[at]))
            left.append(_sorted(contexts, discount * kinds / total))
            if order > 1:
                keys, counts = np.unique(_low(keys, order - 1), return_counts=True)
                counts = counts.astype(np.float64)
            else:
                floor = 1.0 / alphabet
        return cls(shares[::-1], left[::-1], floor)

    def probability(self, keys: np.ndarray, order: int = ORDER) -> np.ndarray:
        """Interpolated probability of the last symbol of each n-gram after the others."""
        lower = self.probability(_low(keys, order - 1), order - 1) if order > 1 else self.floor
        share = _lookup(*self.shares[order - 1], keys, 0.0)
        return share + _lookup(*self.left[order - 1], keys >> np.uint64(16), 1.0) * lower


@dataclass
class Identifier:
    """Models of all languages, their n-grams' costs side by side, and the calibration."""

    languages: list[str]
    models: list[Model]
    hashes: np.ndarray
    costs: np.ndarray
    limits: np.ndarray
    spread: np.ndarray
    sharpness: float = 1.0

    @classmethod
    def fit(cls, grams: dict[str, tuple[np.ndarray, np.ndarray]]) -> Identifier:
        languages = sorted(grams)
        alphabet = 1 + len(np.unique(np.concatenate([_low(k, 1) for k, _ in grams.values()])))
        models = [Model.fit(*grams[lang], alphabet) for lang in languages]
        keys = np.unique(np.concatenate([k for k, _ in grams.values()]))
        costs = np.stack([-np.log2(m.probability(keys)) for m in models], axis=1).astype(np.float32)
        hashes = keys * _MIX
        order = np.argsort(hashes)
        n = len(languages)
        return cls(languages, models, hashes[order], costs[order], np.full(n, np.inf), np.zeros(n))

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts, languages) bits per symbol, and the number of symbols of each text."""
        stream, starts = symbols(texts)
        pad, bits = ORDER - 1, np.zeros((len(texts), len(self.languages)))
        for first in range(pad, len(stream), _CHUNK):
            last = min(first + _CHUNK, len(stream))
            keys = packed(stream, first, last)
            asked = keys * _MIX
            at = np.minimum(np.searchsorted(self.hashes, asked), len(self.hashes) - 1)
            cost = self.costs[at]
            new = np.flatnonzero(self.hashes[at] != asked)
            if len(new):
                for j, model in enumerate(self.models):
                    cost[new, j] = -np.log2(model.probability(keys[new]))
            # The boundaries before each text are places in the stream, not symbols of it.
            cuts = np.searchsorted(starts, [first, last], side="right") - 1
            texts_here = np.arange(cuts[0], min(cuts[1], len(texts) - 1) + 1)
            edges = np.clip(np.stack([starts[texts_here] + pad, starts[texts_here + 1]]), first, last) - first
            some = edges[0] < edges[1]
            if some.any():
                flat = np.append(edges[:, some].T.ravel(), last - first)
                padded = np.concatenate([cost, np.zeros((1, cost.shape[1]), cost.dtype)])
                bits[texts_here[some]] += np.add.reduceat(padded, flat, axis=0, dtype=np.float64)[:-1:2]
        n = np.diff(starts) - pad
        return bits / np.maximum(n, 1)[:, None], n

    def calibrate(self, langs: np.ndarray, entropies: np.ndarray, n: np.ndarray) -> None:
        """Limits of the cross-entropy per language, and how sharply it tells languages apart."""
        nearest = entropies.argmin(axis=1)
        for j in range(len(self.languages)):
            own, size = entropies[langs == j, j], n[langs == j]
            if not len(own):
                continue
            middle = float(np.median(own))
            self.spread[j] = float(np.median(np.abs(own - middle) * np.sqrt(size)))
            # Texts made of the same few words have no spread to measure.
            self.spread[j] = max(self.spread[j], LEAST_SPREAD)
            over = own - self.spread[j] * 6 / np.sqrt(size)
            # A few documents under a wrong label, or far out as another language is, do not set this one's limit.
            typical = over[(nearest[langs == j] == j) & (over <= middle + self.spread[j] * FAR)]
            highest = float(np.quantile(typical, 1 - MOST_REJECTED)) if len(typical) else middle
            self.limits[j] = max(highest, middle, float(np.quantile(over, 1 - FEW))) + self.spread[j] * MARGIN
        best, lowest = 1.0, np.inf
        for sharpness in (0.05, 0.1, 0.2, 0.5, 1.0, 2.0):
            chance = self._chance(entropies, n, sharpness)[np.arange(len(langs)), langs]
            loss = -np.log(np.maximum(chance, 1e-12)).mean() if len(langs) else 0.0
            if loss < lowest - 1e-9:
                best, lowest = sharpness, loss
        self.sharpness = best

    def _chance(self, entropies: np.ndarray, n: np.ndarray, sharpness: float) -> np.ndarray:
        scaled = -entropies * (np.minimum(n, 256) * sharpness)[:, None]
        scaled = np.exp2(scaled - scaled.max(axis=1, keepdims=True))
        return scaled / scaled.sum(axis=1, keepdims=True)

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and whether it is rejected, of each text."""
        if not self.languages:  # nothing to compare with, so only texts without a letter are rejected
            _, starts = symbols(texts)
            return [UNDETERMINED] * len(texts), np.zeros(len(texts)), np.diff(starts) < ORDER
        entropies, n = self.entropies(texts)
        best = entropies.argmin(axis=1)
        rows = np.arange(len(texts))
        chance = self._chance(entropies, n, self.sharpness)[rows, best]
        allowed = self.limits[best] + self.spread[best] * 6 / np.sqrt(np.maximum(n, 1))
        excess = np.maximum(entropies[rows, best] - allowed, 0.0)
        score = np.where(n > 0, chance * np.exp2(-excess), 0.0)
        langs = [self.languages[b] if k else UNDETERMINED for b, k in zip(best, n)]
        return langs, score, (n == 0) | (excess > 0) | (score < 0.5)


def _slices(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str]]]:
    """Runs of the batch's rows of about _CHUNK characters."""
    texts, first, size = [], 0, 0
    for i, text in enumerate(batch.column(column).to_pylist()):
        texts.append(text or "")
        size += len(texts[-1])
        if size >= _CHUNK:
            yield first, texts
            texts, first, size = [], i + 1, 0
    if texts:
        yield first, texts


def learn(docs: DataFrame, learnable: Column, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Identifier:
    """An identifier from about SAMPLE_DOCS learnable documents of each language.

    Rows whose text or language is null, or whose `learnable` is not true, are not
    read into it; a language of which no sampled document has a letter is not learned. Documents are
    drawn by a hash of id and text, rows without an id also by their place. The bound is on documents, of whole
    texts. The driver holds the n-grams of the sample, whose size grows with the number of languages, not with `docs`.
    """
    labelled = docs.filter(learnable & col(lang_col).isNotNull())
    rows = labelled.select(
        col(lang_col).cast("string").alias("lang"), col(text_col).cast("string").alias("text"),
        F.pmod(F.xxhash64(col(id_col), col(text_col), F.when(col(id_col).isNull(), F.monotonically_increasing_id())), F.lit(1 << 30))
        .alias("hash"),
    ).filter("text is not null")
    # A row per label, written, so that the planner knows its size before it chooses how to join it.
    below = F.least(F.lit(1.0), F.lit(float(SAMPLE_DOCS)) / F.count("*")) * (1 << 30)
    shares = stored(rows.groupBy(F.col("lang").alias("of")).agg(below.alias("below")), "langid-shares")
    drawn = rows.join(shares, (F.col("lang") == F.col("of")) & (F.col("hash") < F.col("below")))
    sample = stored(drawn.select("lang", "text", "hash"), "langid-sample")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _slices(batch, 1):
                langs = np.array(batch.column(0).slice(first, len(texts)).to_pylist(), object)
                for lang in sorted(set(langs)):
                    stream, starts = symbols([t for t, x in zip(texts, langs) if x == lang])
                    real = np.ones(len(stream), bool)
                    for back in range(ORDER - 1):
                        real[starts[:-1] + back] = False
                    keys, n = np.unique(packed(stream, ORDER - 1, len(stream))[real[ORDER - 1 :]], return_counts=True)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n)], ["lang", "gram", "n"]
                    )

    learning = F.pmod(F.col("hash"), F.lit(5)) > 0
    counted = map_arrow(sample.filter(learning).select("lang", "text"), count, "lang string, gram long, n long")
    found = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    langs = np.array(found.column("lang").to_pylist(), object)
    keys, n = found.column("gram").to_numpy().view(np.uint64), found.column("n").to_numpy()
    if not len(keys):
        return _no_identifier()
    identifier = Identifier.fit({lang: (keys[langs == lang], n[langs == lang]) for lang in set(langs)})
    known = {lang: j for j, lang in enumerate(identifier.languages)}
    shared = sample.sparkSession.sparkContext.broadcast(identifier)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _slices(batch, 1):
                entropies, sizes = shared.value.entropies(texts)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(sizes), pa.array(list(entropies))],
                    ["lang", "n", "bits"],
                )

    held = map_arrow(sample.filter(~learning).select("lang", "text"), measure, "lang string, n long, bits array<double>")
    rows = [r for r in held.collect() if r.n and r["lang"] in known]
    if rows:
        identifier.calibrate(
            np.array([known[r["lang"]] for r in rows]), np.array([r.bits for r in rows]), np.array([r.n for r in rows])
        )
    return identifier


def _no_identifier() -> Identifier:
    return Identifier([], [], np.empty(0, np.uint64), np.empty((0, 0)), np.empty(0), np.empty(0))


def identified(docs: DataFrame, identifier: Identifier, text_col: str = "text") -> tuple[DataFrame, list[str]]:
    """`docs` with language, score (0 to 1) and whether it is rejected; the names of the three.

    Only the whole text is looked at. A null text, or one without a letter, is `und`
    with score 0 and rejected; if nothing was learned any text is `und` with score 0, but
    those with a letter are not rejected. Added columns get names that `docs` does not have; rows are judged one by one, so ties, repeats
    and nulls elsewhere have no effect; of languages with equal cross-entropy the first by name
    is taken; no rows give none.
    """
    names = fresh(docs, "lang_pred", "score", "rejected")
    shared = docs.sparkSession.sparkContext.broadcast(identifier)
    at = docs.columns.index(text_col)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _slices(batch, at):
                langs, score, rejected = shared.value.predict(texts)
                rows = batch.slice(first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(langs, pa.string()), pa.array(score), pa.array(rejected)],
                    [*rows.schema.names, *names],
                )

    kinds = (T.StringType(), T.DoubleType(), T.BooleanType())
    schema = T.StructType([*docs.schema.fields, *map(T.StructField, names, kinds)])
    return map_arrow(docs, predict, schema), names
