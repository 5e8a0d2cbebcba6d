import os
import re
import sys
from collections import Counter

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from compare import compare, duck  # noqa: E402

from gridpulse.llm import quality, queries  # noqa: E402

BLANK = r"[^\x20\x09-\x0D]+"


def plain(text):
    text = text or ""
    words = re.findall(BLANK, text)
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often, covered = Counter(runs), set()
    for i, run in enumerate(runs):
        if often[run] > 1:
            covered.update(range(i, i + 8))
    lines = [x for x in text.split("\n") if re.search(BLANK, x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered),
        len(words) < 20 or 100 * len(covered) > 30 * len(words),
    )


PROSE = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
TEXTS = [
    None, "", " \t\n\r\x0b\x0c", "one", PROSE, PROSE + "\n" + PROSE, "a b c d e f g h i " * 9, "x " * 8, "x " * 7, "x " * 9,
    "#a$ %b& " * 30, PROSE.upper(), "l one\nl one\n\n \nl two", "a\xa0b 　 c " * 4, "1 2 3 | 4 ! " * 12,
    " ".join(w for w in PROSE.split() for _ in range(3)), "line of eight words is this one now\n" * 2 + PROSE, "é" * 50 + " " + PROSE,
]


def test_measures(documents):
    docs = documents(*TEXTS)
    full, names, base, _ = quality.judged(docs)
    assert set(docs.columns) < set(full.columns)
    got = {r.doc_id: tuple(r[n] for n in [*names[1:], base]) for r in full.collect()}
    assert got == {i: plain(t) for i, t in enumerate(TEXTS, 1)}


def test_verdicts(documents):
    kept = {r.text for r in quality.kept_documents(documents(*TEXTS)).collect()}
    assert kept == {PROSE, "line of eight words is this one now\n" * 2 + PROSE, "é" * 50 + " " + PROSE}


def test_order_does_not_matter(documents, monkeypatch):
    docs = documents(*TEXTS)
    want = sorted(r.doc_id for r in quality.kept_documents(docs).collect())
    monkeypatch.setattr(quality, "ordered", lambda sample, tests: sorted(tests, reverse=True))
    assert sorted(r.doc_id for r in quality.kept_documents(docs).collect()) == want


def test_clashes_repeats_and_empty(documents, spark):
    docs = documents(PROSE, PROSE).union(documents(PROSE)).withColumnRenamed("id", "n_words").withColumnRenamed("source", "KEPT")
    out = quality.kept_documents(docs)
    assert out.columns == docs.columns and out.count() == 3
    assert quality.kept_documents(docs.limit(0)).count() == 0


def test_ordered_puts_rejecting_rules_first(documents):
    from pyspark.sql import functions as F

    docs = documents(*["x"] * 50).cache()
    tests = {"never": F.length("text") > 5, "always": F.length("text") == 1}
    assert quality.ordered(docs, tests) == ["always", "never"]


def test_query_and_sql(spark, small):
    assert compare(queries.QUERIES["op9_quality_cascade"](spark, small), duck(small), queries.ORACLE_SQL["op9_quality_cascade"]) is None


def test_sql_on_hard_texts(documents):
    import duckdb

    docs = documents(*TEXTS)
    full, names, base, kept = quality.judged(docs.select("doc_id", "text"))
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    found = full.select("doc_id", *names[1:], base, kept)
    assert compare(found, con, queries.ORACLE_SQL["op9_quality_cascade"]) is None


@pytest.mark.parametrize("name", ["op9_quality_cascade"])
def test_no_python_in_the_plan(spark, small, name):
    plan = queries.QUERIES[name](spark, small)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_copies_and_nulls_do_not_fill_the_sample(monkeypatch, spark):
    monkeypatch.setattr(quality, "SAMPLE", 100)
    from pyspark.sql import functions as F

    docs = spark.range(6000).select(F.when(F.col("id") % 2 == 0, F.lit(PROSE)).alias("text"))
    assert 50 < quality._sample(docs, "text").count() < 170


def test_kept_documents_are_those_that_are_judged_so(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    full, _, _, kept = quality.judged(docs)
    want = {r.doc_id for r in full.filter(kept).collect()}
    assert {r.doc_id for r in quality.kept_documents(docs).collect()} == want and 0 < len(want) < docs.count()
