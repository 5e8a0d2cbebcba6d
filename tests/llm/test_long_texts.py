"""Texts of millions of characters go through every operator whole."""

import hashlib
import random

import pytest
from public_tokenizers import path
from pyspark.sql import functions as F

from gridpulse.llm import html, langid, lcp, mixing, packing, quality, rans, simhash, urls, warc

PATH = path("byte_bpe_50k.json")
RNG = random.Random(6)
WORDS = ["".join(RNG.choice("etaoinshrdlu") for _ in range(RNG.randint(2, 9))) for _ in range(5000)]
LONG = " ".join(RNG.choice(WORDS) for _ in range(300_000))
ONE_WORD = "x" * 1_500_000
TEXTS = [LONG, ONE_WORD, LONG + " end"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"http://h/{i}") for i, t in enumerate(TEXTS)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3).persist()


def test_quality(docs):
    full, names, base, kept = quality.judged(docs)
    got = {r.doc_id: (r[names[1]], r[names[2]], r[kept]) for r in full.drop("text", names[0]).collect()}
    chars = sum(map(len, LONG.split()))
    assert got == {0: (300_000, chars, True), 1: (1, len(ONE_WORD), False), 2: (300_001, chars + 3, True)}


def test_language(docs):
    found, names = langid.identified(docs, langid.learn(docs, F.lit(True)))
    assert {(r[names[0]], r[names[2]]) for r in found.drop("text").collect()} == {("en", False)}


def test_near_duplicates(docs):
    assert {r.id: r.component for r in simhash.near_duplicates(docs).collect()} == {0: 0, 1: 1, 2: 0}


def test_fingerprints(docs):
    rows = {r.doc_id: r for r in lcp.fingerprinted(docs).collect()}
    after = {2: ONE_WORD, 1: LONG, 0: TEXTS[2]}
    for i, text in enumerate(TEXTS):
        assert rows[i].n_chars == len(text)
        assert rows[i].edited_sha256 == hashlib.sha256(lcp.edited(text, after[i]).encode()).hexdigest()
    assert rows[0].near_next > 0.9 > 0.1 > rows[2].near_next


def test_tokens(docs):
    rows = packing.pack(packing.pieces(docs, PATH)).collect()
    folder, blocks = rans.write_tokens(docs, PATH)
    read = {r.doc_id: r.n_tokens for r in rans.read_tokens(folder, blocks).collect()}
    assert read == {i: sum(r.length for r in rows if r.doc_id == i) for i in range(3)}


def test_mix(docs):
    assert mixing.mixed(docs, {"http://h/0": 1, "http://h/1": 1, "http://h/2": 2}, F.length("text")).count() == 3


def test_pages(docs):
    pages = docs.select(F.col("doc_id").alias("page_id"), F.col("source").alias("url"), F.concat(F.lit("<article><p>"), "text").alias("html"))
    assert {r.id: r.n_chars for r in html.extracted(pages).drop("text").collect()} == {i: len(t) for i, t in enumerate(TEXTS)}
    folder, index = warc.write_archives(pages)
    assert {r.id: r.payload_bytes for r in warc.read_archives(folder, index).drop("payload").collect()} == {
        i: len(t) + 12 for i, t in enumerate(TEXTS)
    }
    full, names = urls.judged(pages.withColumn("url", F.concat("url", "html")), [], F.lit(False))
    assert {r[names[0]] for r in full.select(*names).collect()} == {"h"}
