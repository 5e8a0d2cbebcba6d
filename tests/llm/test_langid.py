import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpulse.llm import langid, queries
from gridpulse.llm.common import stored
from gridpulse.llm.langid import Identifier, Model, symbols


def plain_symbols(text):
    out = []
    for c in text + "\n":  # a text ends with a boundary
        if c.isalpha():
            out.append(c.lower() if len(c.lower()) == 1 else c)
        elif out and out[-1] != "\0":
            out.append("\0")
    return out


def plain_grams(texts, order=4):
    found = Counter()
    for text in texts:
        s = ["\0"] * (order - 1) + plain_symbols(text)
        found.update(tuple(s[i : i + order]) for i in range(len(s) - order + 1))
    return found


def plain_model(counts, alphabet, order=4):
    """Interpolated Kneser-Ney by dictionaries: probability of a gram's last symbol after the others."""
    tables = []
    while order:
        once, twice = sum(c == 1 for c in counts.values()), sum(c == 2 for c in counts.values())
        discount = once / (once + 2 * twice) if once else 0.5
        total, kinds = Counter(), Counter()
        for gram, c in counts.items():
            total[gram[:-1]] += c
            kinds[gram[:-1]] += 1
        tables.append((dict(counts), total, kinds, discount))
        counts = Counter(g[1:] for g in counts) if order > 1 else counts
        order -= 1

    def probability(gram, level=0):
        if level == len(tables):
            return 1.0 / alphabet
        table, total, kinds, discount = tables[level]
        lower = probability(gram[1:], level + 1)
        if gram[:-1] not in total:
            return lower
        n = total[gram[:-1]]
        return max(table.get(gram, 0) - discount, 0) / n + discount * kinds[gram[:-1]] / n * lower

    return probability


def pack(gram):
    return sum(ord(c) << 16 * i for i, c in enumerate(reversed(gram)))


TEXTS = ["Abra kadabra, abra!", "the cat sat on the mat; the cat", "", "x", "ÄÖ ß ab1ab2ab", "İstanbul", "a\n\nb"]


def test_symbols():
    stream, starts = symbols(TEXTS)
    for i, text in enumerate(TEXTS):
        own = stream[starts[i] : starts[i + 1]]
        assert own.tolist() == [0, 0, 0] + [ord(c) for c in plain_symbols(text)]
    assert len(symbols([])[0]) == 0


def test_probabilities():
    counts = plain_grams(TEXTS)
    want = plain_model(counts, 40)
    grams = sorted(counts) + [("q", "q", "q", "q"), ("\0", "t", "h", "z"), ("t", "h", "e", "\0"), ("q", "t", "h", "e")]
    keys = np.array([pack(g) for g in sorted(counts)], np.uint64)
    model = Model.fit(keys, np.array([counts[g] for g in sorted(counts)]), 40)
    got = model.probability(np.array([pack(g) for g in grams], np.uint64))
    assert np.allclose(got, [want(g) for g in grams])
    one = model.probability(np.array([pack(("t", "h", "e", c)) for c in "\0abcdefghijklmnopqrstuvwxyz"], np.uint64))
    assert 0 < one.sum() <= 1.0001


@pytest.mark.parametrize("chunk", [7, 1 << 20])
def test_entropies(monkeypatch, chunk):
    monkeypatch.setattr(langid, "_CHUNK", chunk)
    grams = {"a": plain_grams(TEXTS[:1]), "b": plain_grams(TEXTS[1:])}
    fitted = Identifier.fit({
        k: (np.array([pack(g) for g in sorted(c)], np.uint64), np.array([c[g] for g in sorted(c)])) for k, c in grams.items()
    })
    alphabet = 1 + len({g[-1] for c in grams.values() for g in c})
    texts = ["abra cat", "", "zzz", "the kadabra on Ä", "...", "ab " * 30]
    got, n = fitted.entropies(texts)
    for i, text in enumerate(texts):
        s = ["\0"] * 3 + plain_symbols(text)
        assert n[i] == len(s) - 3
        for j, c in enumerate([grams["a"], grams["b"]]):
            p = plain_model(c, alphabet)
            bits = -sum(math.log2(p(tuple(s[k : k + 4]))) for k in range(len(s) - 3))
            assert math.isclose(got[i, j], bits / max(n[i], 1), rel_tol=1e-4, abs_tol=1e-9)


def labelled(spark):
    words = {"xx": ["kata", "koto", "taka", "toko"], "yy": ["sils", "lisi", "sill", "issi"]}
    rows = []
    for i in range(200):
        lang = "xx" if i % 2 else "yy"
        rows.append((i, " ".join(words[lang][(i * 7 + k * k) % 4] for k in range(12)), lang, "r", None))
    rows += [(1000, None, "xx", "", None), (1001, " 12 !", "yy", "", None), (1002, "kata toko", None, "", None), (1003, "漢字 漢字" * 20, None, "", None)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score string, rejected string")


def test_learned_and_identified(spark):
    docs = labelled(spark)
    identifier = langid.learn(docs, F.lit(True))
    assert identifier.languages == ["xx", "yy"]
    found, (lang, score, rejected) = langid.identified(docs.union(docs.filter("doc_id = 5")), identifier)
    rows = {r.doc_id: r for r in found.collect()}
    assert found.count() == 205 and len(set(found.columns)) == 8
    for r in rows.values():
        assert 0 <= r[score] <= 1
        if r.doc_id < 200 or r.doc_id == 1002:
            assert r[lang] == ("xx" if r.doc_id % 2 or r.doc_id == 1002 else "yy") and not r[rejected]
    assert [(rows[i][lang], rows[i][score], rows[i][rejected]) for i in (1000, 1001)] == [("und", 0.0, True)] * 2
    assert rows[1003][lang] in ("xx", "yy") and rows[1003][rejected]


def test_held_out_rows_are_not_learned(spark):
    docs = labelled(spark)
    identifier = langid.learn(docs, F.col("lang") == "xx")
    assert identifier.languages == ["xx"]


def test_nothing_to_learn(spark):
    docs = labelled(spark)
    for identifier in (langid.learn(docs.limit(0), F.lit(True)), langid.learn(docs, F.lit(False))):
        found, (lang, _, rejected) = langid.identified(docs, identifier)
        assert {(r.doc_id in (1000, 1001), r[lang], r[rejected]) for r in found.collect()} == {(True, "und", True), (False, "und", False)}
    assert langid.identified(docs.limit(0), identifier)[0].count() == 0


def test_query_is_accurate_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = queries.QUERIES["op1_kneser_ney_language"](spark, folder).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    import zlib

    right = defaultdict(list)
    assert len(rows) == len(docs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        right[r.held_out].append(r.lang_pred == docs[r.doc_id].lang)
    assert np.mean(right[True]) > 0.99 and np.mean(right[False]) > 0.98


@pytest.mark.parametrize("out", ["en", "de"])
def test_a_language_that_was_not_learned_is_rejected(spark, out):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").filter("length(text) > 300")
    identifier = langid.learn(docs.filter("doc_id % 4 = 0"), F.col("lang") != out)
    judged = docs.filter("doc_id % 4 = 1 and doc_id < 4000")
    found, (_, _, rejected) = langid.identified(judged, identifier)
    share = dict(found.groupBy(F.col("lang") == out).agg(F.avg(F.col(rejected).cast("int"))).collect())
    assert share[True] > 0.97 and share[False] < 0.01


def test_limits_do_not_follow_the_alphabet():
    """A large script among the languages does not raise what another one lets pass."""
    rng = np.random.default_rng(7)

    def limit(symbol_count):
        texts = {"aa": [" ".join("".join(rng.choice(list("abcde"), 4)) for _ in range(60)) for _ in range(60)]}
        texts["zz"] = ["".join(chr(0x4E00 + i) for i in rng.integers(0, symbol_count, 300)) for _ in range(60)]
        grams = {k: plain_grams(t[:40]) for k, t in texts.items()}
        identifier = Identifier.fit({
            k: (np.array([pack(g) for g in sorted(c)], np.uint64), np.array([c[g] for g in sorted(c)])) for k, c in grams.items()
        })
        entropies, n = identifier.entropies(texts["aa"][40:] + texts["zz"][40:])
        identifier.calibrate(np.array([0] * 20 + [1] * 20), entropies, n)
        return identifier.limits[0]

    assert abs(limit(20) - limit(5000)) < 0.3


def test_rows_without_id_and_many_labels_are_sampled_like_others(spark, monkeypatch):
    monkeypatch.setattr(langid, "SAMPLE_DOCS", 50)
    kept = {}
    monkeypatch.setattr(langid, "stored", lambda df, label: kept.setdefault(label, stored(df, label)))
    rows = spark.range(4000).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit("kata koto taka toko").alias("text"),
        F.when(F.col("id") < 3700, F.lit("xx")).otherwise(F.concat(F.lit("l"), F.col("id"))).alias("lang"),
    )
    identifier = langid.learn(rows, F.lit(True))
    sizes = dict(kept["langid-sample"].groupBy("lang").count().collect())
    assert 20 < sizes.pop("xx") < 100 and len(sizes) == 300 and set(sizes.values()) == {1}
    assert "xx" in identifier.languages and identifier.limits[identifier.languages.index("xx")] < 20
