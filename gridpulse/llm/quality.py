"""Quality rules over whole texts as a short-circuit cascade, in column expressions only.

Base rules come first. The others are tried on a sample for what they cost and how much
they reject, and are then evaluated in the order of rejection per cost; a document that
fails one is not tried on the rest. The verdict is the same in any order.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import col, fresh, stored

BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "[#*$%&|<>]"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30
#: About so many rows, chosen one by one by a hash of their place and text, are used to order the rules.
SAMPLE = 2000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once per row."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, BLANKS), "")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))


def _window_hashes(words: Column, n_words: Column) -> Column:
    """A 64-bit hash of every run of WINDOW words; equal runs have equal hashes."""
    starts = F.sequence(F.lit(1), n_words - F.lit(WINDOW - 1))
    return F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, F.lit(WINDOW))))


def _covered(hashes: Column) -> Column:
    """Words in runs that occur again, from the hashes of all runs."""

    def of_sorted(runs: Column) -> Column:
        again = F.filter(
            runs,
            lambda run, k: (F.get(runs, k - 1)["h"] == run["h"]) | (F.get(runs, k + 1)["h"] == run["h"]),
        )
        starts = F.sort_array(F.transform(again, lambda run: run["i"]))
        return _let(starts, lambda at: F.aggregate(
            F.transform(at, lambda i, k: F.least(F.lit(WINDOW), F.coalesce(F.get(at, k + 1) - i, F.lit(WINDOW)))),
            F.lit(0), lambda total, n: total + n,
        ))

    runs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return _let(runs, of_sorted)


def _repeat_words(words: Column, n_words: Column) -> Column:
    def of_hashes(hashes: Column) -> Column:
        # Most documents repeat no run and need no sort.
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), 0).otherwise(_covered(hashes))

    found = _let(_window_hashes(words, n_words), of_hashes)
    return F.when(n_words <= WINDOW, 0).otherwise(found).cast("long")


def measured(docs: DataFrame, text_col: str, names: list[str], repeats: bool = True) -> DataFrame:
    """`docs` with word array, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words under `names`.

    A null text counts as empty. The measures leave through a row generator, so that a
    later filter uses their values and is not pushed down with their formulas in it.
    The last one, the dearest, is left out without `repeats`.
    """
    words, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words = names
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    cut = docs.withColumn(words, words_of(text))
    found = [
        F.size(words).cast("long").alias(n_words),
        F.length(F.array_join(words, "")).cast("long").alias(word_chars),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias(n_symbols),
        _let(_lines(text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias(n_dup_lines),
    ]
    if repeats:
        found.append(_repeat_words(F.col(words), F.size(words)).alias(n_repeat_words))
    return cut.select("*", F.inline(F.array(F.struct(*found))))


def too_short(n_words: Column) -> Column:
    return n_words < LEAST_WORDS


def too_repetitive(n_words: Column, n_repeat_words: Column) -> Column:
    return 100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words


def base_fails(n_words: Column, n_repeat_words: Column) -> Column:
    return too_short(n_words) | too_repetitive(n_words, n_repeat_words)


def rules(text: Column, names: list[str]) -> dict[str, Column]:
    """Each rule as whether a document fails it, given the columns made by `measured`."""
    words, n_words, word_chars, n_symbols, n_dup_lines, _ = [F.col(n) for n in names]
    text = F.coalesce(text.cast("string"), F.lit(""))
    no_letter = F.regexp_count(text, F.lit(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D\p{L}]+(?![^\x20\x09-\x0D])"))
    stuttered = F.filter(words, lambda word, i: word == F.get(words, i - 1))
    return {
        "symbols": 10 * n_symbols > n_words,
        "word_length": (2 * word_chars < 5 * n_words) | (word_chars > 12 * n_words),
        "lines": 2 * n_dup_lines > F.size(_lines(text)),
        "letters": 10 * no_letter > 3 * n_words,
        "capitals": 2 * F.regexp_count(text, F.lit(r"\p{Lu}")) > word_chars,
        "stutter": 5 * F.size(stuttered) > n_words,
    }


def ordered(sample: DataFrame, tests: dict[str, Column]) -> list[str]:
    """Names of the rules by rejection per second on the sample, the best first; ties by name."""
    rejected = sample.agg(*[F.avg(F.coalesce(t, F.lit(False)).cast("double")).alias(n) for n, t in tests.items()]).first()

    def seconds(test: Column) -> float:
        began = time.perf_counter()
        sample.select(F.count_if(test)).collect()
        return time.perf_counter() - began

    seconds(F.lit(True))  # the first run also opens the files
    idle = seconds(F.lit(True))
    cost = {n: max(seconds(t) - idle, 1e-3) for n, t in tests.items()}
    return sorted(tests, key=lambda n: (-(rejected[n] or 0.0) / cost[n], n))


def _sample(docs: DataFrame, text_col: str) -> DataFrame:
    """About SAMPLE texts, each row drawn on its own: copies of a text do not come together, and nulls do not come at all."""
    texts = docs.select(col(text_col)).filter(col(text_col).isNotNull())
    share = min(1.0, SAMPLE / max(1, texts.count()))
    drawn = F.pmod(F.xxhash64(F.monotonically_increasing_id(), col(text_col)), F.lit(1 << 30))
    return stored(texts.filter(drawn < int(share * (1 << 30))), "quality-sample")


def judged(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, list[str], str, str]:
    """`docs` with the measures and the verdict; the names of the measures, of `base_failed` and of `kept`.

    Added columns get names that `docs` does not have. Every row is judged on its own
    whole text, so nulls in other columns, repeated rows and ties have no effect; an
    empty or null text has no words and fails the base rules; no rows give none.
    """
    made = fresh(docs, "words", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    names, base, kept = made[:6], made[6], made[7]
    tests = rules(col(text_col), names)
    order = ordered(measured(_sample(docs, text_col), text_col, names), tests)
    full = measured(docs, text_col, names)
    full = full.withColumn(base, base_fails(F.col(names[1]), F.col(names[5])))
    verdict = F.when(F.col(base), False)
    for name in order:
        verdict = verdict.when(tests[name], False)
    return full.withColumn(kept, verdict.otherwise(True)), names, base, kept


def kept_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of `docs` that pass the base rules and every other rule, with its columns.

    The same rows as `judged` keeps. As no measure is asked for, the base rule on repeated words, the
    dearest, takes its place in the order like any other; only the count of words comes first.
    """
    names = fresh(docs, "words", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    words, n_words = F.col(names[0]), F.col(names[1])
    tests = rules(col(text_col), names) | {"repeats": too_repetitive(n_words, _repeat_words(words, F.size(words)))}
    order = ordered(measured(_sample(docs, text_col), text_col, names, repeats=False), tests)
    fails = F.when(too_short(n_words), True)
    for name in order:
        fails = fails.when(tests[name], True)
    full = measured(docs, text_col, names, repeats=False)
    return full.filter(~fails.otherwise(False)).select(*[col(c) for c in docs.columns])
