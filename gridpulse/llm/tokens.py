"""Token ids of whole texts by the tokenizers library, with repeated pieces encoded once.

A byte-level BPE tokenizer cuts a text into pieces by a pattern and encodes each on
its own, so the ids of a text are the ids of its pieces in order. Texts are cut where
the tokenizer's pattern always cuts too, and each distinct piece is encoded by the
library once per batch and, if it is kept, once per worker. Texts in which the cuts are not certain go to the library
whole. Both ways give the ids of `Tokenizer.encode(text, add_special_tokens=False)`.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import lru_cache
from itertools import chain, repeat

import numpy as np

#: Pieces and characters kept per worker, so that memory is bounded (about 200 bytes a piece); beyond it
#: the pieces met most often stay, half as many at most.
KEPT_PIECES, KEPT_CHARS = 300_000, 6_000_000
#: Pieces that are given to the library as one text.
_JOINED = 256

_LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Blanks, then letters or else what is neither; letters end where the pattern ends a word.
_FINE = re.compile(rf"[ \n]*(?:[{_LETTERS}]+|[^ \n{_LETTERS}]+)|[ \n]+")
#: With an apostrophe in the text, which binds to letters, only blanks are certain.
_COARSE = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
#: Characters whose class is the same for every pattern engine.
_UNSURE = re.compile(rf"[^\x20-\x7e\n{_LETTERS}]")
#: Pieces that the pattern of a byte-level tokenizer takes as one.
_WORD = re.compile(rf" ?[{_LETTERS}]+")


class PieceEncoder:
    """Encodes lists of texts to flat ids and the number of ids of each text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a worker per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.words = self._words()
        self._clear()

    def _words(self):
        """A tokenizer of the same model for words in the byte-level alphabet with blanks between them; none if the pattern is another."""
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, CharDelimiterSplit

        cut = self.tokenizer.pre_tokenizer
        if self.tokenizer.normalizer is not None or not isinstance(cut, ByteLevel) or cut.add_prefix_space or not cut.use_regex:
            return None
        # The alphabet's character of each byte; byte 0, which no word has, stands for the blank between two.
        same = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.alphabet = np.zeros(256, "<u4")
        self.alphabet[same] = same
        others = np.setdiff1d(np.arange(256), same)
        self.alphabet[others] = 256 + np.arange(len(others))
        self.alphabet[0] = 32
        vocabulary = self.tokenizer.get_vocab()
        self.widths = np.zeros(max(vocabulary.values()) + 1, np.int64)  # bytes that an id stands for
        self.widths[list(vocabulary.values())] = list(map(len, vocabulary))
        words = Tokenizer(self.tokenizer.model)
        words.pre_tokenizer = CharDelimiterSplit(" ")
        return words

    def _clear(self) -> None:
        self.codes: dict[str, int] = {}
        self.kept_chars = 0
        self.ids, self.starts = array("I"), array("q", [0])
        self.met = np.zeros(0, np.int64)

    def _shrink(self) -> None:
        pieces, met = list(self.codes), self.met
        best = np.argsort(-met, kind="stable")[: KEPT_PIECES // 2]
        best = best[met[best] > 1]
        chars = np.cumsum([len(pieces[i]) for i in best.tolist()])
        best = best[: np.searchsorted(chars, KEPT_CHARS // 2)]
        ids, sizes = self._ids_of(best)
        self._clear()
        self._add([pieces[i] for i in best.tolist()], ids, sizes)
        self.met = met[best] // 2  # so that pieces added later can overtake them

    def _add(self, pieces: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Keep pieces that are not in the table; `ids` has theirs one after the other, `sizes` how many each has."""
        known = len(self.codes)
        self.codes.update(zip(pieces, range(known, known + len(pieces))))
        self.kept_chars += sum(map(len, pieces))
        self.ids.frombytes(ids.astype(np.uint32).tobytes())
        self.starts.frombytes((self.starts[-1] + np.cumsum(sizes, dtype=np.int64)).tobytes())

    def _ids_of(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of kept pieces in order, and their number per piece."""
        if not len(codes):
            return np.empty(0, np.uint32), np.empty(0, np.int64)
        flat, starts = np.frombuffer(self.ids, np.uint32), np.frombuffer(self.starts, np.int64)
        begin = starts[codes]
        sizes = starts[codes + 1] - begin
        ends = np.cumsum(sizes)
        return flat[np.repeat(begin - (ends - sizes), sizes) + np.arange(int(ends[-1]))], sizes

    def _library(self, tokenizer, texts: list[str]) -> list[list[int]]:
        return [found.ids for found in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> None:
        if together := [p for p in pieces if _WORD.fullmatch(p)] if self.words else []:
            raw = [p.encode() for p in together]
            texts = [np.frombuffer(b"\0".join(raw[i : i + _JOINED]), np.uint8) for i in range(0, len(raw), _JOINED)]
            found = self._library(self.words, [self.alphabet[t].tobytes().decode("utf-32-le") for t in texts])
            ids = np.fromiter(chain.from_iterable(found), np.int64)
            ends = np.cumsum(np.fromiter(map(len, raw), np.int64, len(raw)))
            reached = np.cumsum(self.widths[ids])
            last = np.searchsorted(reached, ends)  # the id with which each piece ends
            if np.array_equal(reached[last[last < len(reached)]], ends):
                self._add(together, ids, np.diff(last, prepend=-1))
                pieces = [p for p in pieces if p not in self.codes]
        each = self._library(self.tokenizer, pieces)
        self._add(pieces, np.fromiter(chain.from_iterable(each), np.int64), np.array(list(map(len, each)), np.int64))

    def _cut(self, text: str) -> list[str] | None:
        if _UNSURE.search(text) or any(s in text for s in self.special):
            return None
        return (_COARSE if "'" in text else _FINE).findall(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids (uint32) in order, and their number per text."""
        cuts = [self._cut(t) for t in texts]
        counts = np.array([-1 if c is None else len(c) for c in cuts], np.int64)
        flat_cuts = list(chain.from_iterable(c for c in cuts if c))
        if len(self.codes) > KEPT_PIECES or self.kept_chars > KEPT_CHARS:
            self._shrink()
        pieces = np.fromiter(map(self.codes.get, flat_cuts, repeat(-1)), np.int64, len(flat_cuts))
        if len(unknown := np.flatnonzero(pieces < 0)):
            new = [flat_cuts[i] for i in unknown.tolist()]
            self._learn(list(dict.fromkeys(new)))
            pieces[unknown] = [self.codes[p] for p in new]
        met = np.bincount(pieces, minlength=len(self.codes))
        met[: len(self.met)] += self.met
        self.met = met
        ids, sizes = self._ids_of(pieces)
        bounds = np.concatenate(([0], np.cumsum(sizes)))[np.concatenate(([0], np.cumsum(np.maximum(counts, 0))))]
        lengths = np.diff(bounds)
        if (counts < 0).any():
            parts = []
            for i, text in enumerate(texts):
                if counts[i] < 0:
                    whole = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
                    lengths[i] = len(whole)
                    parts.append(whole)
                else:
                    parts.append(ids[bounds[i] : bounds[i + 1]])
            ids = np.concatenate(parts) if parts else ids
        return ids, lengths


@lru_cache(maxsize=2)
def encoder(path: str) -> PieceEncoder:
    """The worker's encoder for a tokenizer file."""
    return PieceEncoder(path)
