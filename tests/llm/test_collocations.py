import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from gridpulse.llm import collocations as co
from gridpulse.llm import queries


def plain(rows, support=10, top=2000):
    """Each language's list from counters of everything; rows are (lang, text)."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in (1, 2, 3):
                counts.update((lang, *words[i : i + n]) for i in range(len(words) - n + 1))
    out = {}
    long = {k: a for k, a in counts.items() if len(k) == 4 and a >= support}
    for key, a in counts.items():
        lang, *words = key
        if len(words) == 1 or a < support:
            continue
        held = [b for k, b in long.items() if len(words) == 2 and k[0] == lang and tuple(words) in (k[1:3], k[2:4])]
        if any(100 * b >= 50 * a for b in held):
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[(lang, *words[:k])], counts[(lang, *words[k:])]
            cuts.append((1000000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), left, right))
    return sorted(
        (lang, i, p.decode(), -a, le, r, totals[lang], -s)
        for lang, found in out.items() for i, (s, a, p, le, r) in enumerate(sorted(found)[:top], 1)
    )


def found(df):
    return sorted(tuple(r) for r in df.collect())


WORDS = ["New", "york", "City", "of", "the", "ÉTÉ", "été", "a-b", "x y", "\x1f", "q\x00"]


@pytest.fixture
def rows():
    rng = random.Random(3)
    rows = []
    for i in range(300):
        words = [rng.choice(WORDS) for _ in range(rng.randrange(60))]
        text = "".join(w + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "!"]) for w in words)
        rows.append((rng.choice(["en", "de", None, "und"]), text))
    return rows + [("en", "new york city " * 40)] * 3 + [("en", None), ("en", ""), (None, None), ("fr", "...,,,"), ("zz", "one word")]


@pytest.fixture
def table(spark, rows):
    # `phrase`, `n` and `key` are names that the operator uses itself.
    full = [(lang, text, i, None, 7) for i, (lang, text) in enumerate(rows)]
    return spark.createDataFrame(full, "lang string, text string, n long, phrase string, key int")


def test_against_counters(table, rows):
    for parts in (1, 7):
        assert found(co.collocations(table.repartition(parts))) == plain(rows)
    assert {r[0] for r in plain(rows)} == {"de", "en", "und"}


def test_top_is_by_language_and_ties_by_bytes(table, rows):
    assert found(co.collocations(table, top=5)) == plain(rows, top=5)


def test_other_support(table, rows):
    assert found(co.collocations(table, support=3)) == plain(rows, support=3)


def test_small_chunks_count_every_run_once(rows, monkeypatch):
    """Texts that go on from chunk to chunk and from slice to slice."""
    monkeypatch.setattr(co, "CHUNK", 7)
    monkeypatch.setattr(co, "SLICE", 11)
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] or "und" for r in rows]), pa.array([r[1] or "" for r in rows])], ["lang", "text"])
    for n in (1, 2, 3):
        got = Counter()
        for words, ids, repeated in co._chunks(iter([batch])):
            grams, counts = co._grams(ids, n, repeated)
            for row, many in zip(grams.tolist(), counts.tolist()):
                got[(words[row[0] - 1][0], *[words[w - 1][1].decode() for w in row])] += many
        want = Counter()
        for lang, text in rows:
            for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")):
                words = re.findall(r"[^\x20\x09]+", piece)
                want.update((lang or "und", *words[i : i + n]) for i in range(len(words) - n + 1))
        assert got == want


def test_the_filter_misses_nothing_when_it_is_full(spark, monkeypatch):
    monkeypatch.setattr(co, "MOST_WORDS", 64)
    keys = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5000, np.int64) & ~3
    bloom = co._bloom(spark.createDataFrame([(int(k),) for k in keys], "key long"))
    assert bloom[1] == 64 and co._in_filter(bloom, keys.view(np.uint64)).all()


def test_products_past_64_bits(spark, monkeypatch):
    many = 3_000_000_000_000
    counts = [("en", "", 0, 9 * many), ("en", "a", 1, many + 1), ("en", "b", 1, many + 7), ("en", "a b", 2, many)]
    table = spark.createDataFrame(counts, "lang string, phrase string, words int, f long")
    monkeypatch.setattr(co, "phrase_counts", lambda *a: table)
    assert found(co.collocations(table)) == [
        ("en", 1, "a b", many, many + 1, many + 7, 9 * many, 1000000 * many * many // ((many + 1) * (many + 7)))
    ]


def test_very_long_text_and_empty_table(spark, table):
    text = "ab cd " * 400_000 + "z" * 2_000_000 + " ab cd"
    long = spark.createDataFrame([("en", text)], "lang string, text string")
    rows = found(co.collocations(long))
    assert rows == plain([("en", text)]) and len(rows) == 2
    assert found(co.collocations(table.limit(0))) == []


def test_query(spark, small):
    rows = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("lang", "text").collect()]
    assert found(queries.QUERIES["op12_son_collocations"](spark, small)) == plain(rows)
