import os
import sys
from collections import defaultdict

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from test_packing import check  # noqa: E402
from test_quality import plain as plain_quality  # noqa: E402
from test_simhash import linked, plain as plain_print  # noqa: E402

from gridpulse.llm.common import stored  # noqa: E402

PROSE = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120))
LONG = " ".join(f"long{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(4000))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, extra string"


@pytest.fixture
def mess(spark):
    rows = [
        (1, None, "en", "a", None, None), (2, "", "en", "a", 0, "x"), (3, "12 34 !!", "en", "a", 8, "x"), (4, PROSE, None, None, 1, None),
        (5, PROSE, "en", "b", 1, "x"), (6, PROSE, "en", "b", 1, "x"), (6, PROSE, "en", "b", 1, "x"), (7, PROSE[::-1], "en", "a", 1, "x"),
        (8, "so few words", "en", "a", 1, "x"), (9, "again and " * 300, "en", "a", 1, "x"), (None, PROSE + " no id", "en", "a", 1, "x"),
        (10, LONG, "en", "a", 1, "x"),
    ]
    return spark.createDataFrame(rows, DOCS)


def test_stages_on_a_mess(spark, mess):
    docs, left = mess, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, ""), f"test-{name}")
        assert docs.columns == mess.columns
        left.append(sorted((r.doc_id or 0) for r in docs.collect()))
    assert left[0] == [0, 4, 5, 6, 6, 7, 8, 9, 10]
    assert left[1] == [0, 4, 5, 6, 6, 7, 10]
    assert left[2] == [0, 4, 7, 10]
    assert left[3] == [0, 4, 7, 10]
    rows = corpus_pipeline.pack(spark, docs, "").collect()
    assert {r.doc_id for r in rows} == {None, 4, 7, 10}


def test_empty(spark, mess):
    docs = mess.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, ""), f"test-{name}")
        assert docs.count() == 0


def test_run(spark, small):
    """Against the stages in plain Python; language is held to keep what has a letter."""
    docs = {r.doc_id: r for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    kept = {i for i, r in docs.items() if any(c.isalpha() for c in r.text or "")}
    first = stored(corpus_pipeline.language(spark, spark.read.parquet(f"{small}/documents.parquet"), small), "test-language")
    assert {r.doc_id for r in first.collect()} == kept
    second = stored(corpus_pipeline.good(spark, first, small), "test-quality")
    good = {r.doc_id for r in second.collect()}
    assert good <= {i for i in kept if not plain_quality(docs[i].text)[-1]}
    root = linked(sorted(good), [plain_print(docs[i].text) for i in sorted(good)])
    single = {i for i in good if root[i] == i}
    rows = corpus_pipeline.run(spark, small).collect()
    check(rows, {i: docs[i].text for i in single}, slack=3)


def test_sequences_follow_the_mix(spark, small):
    docs = stored(corpus_pipeline.mix(spark, spark.read.parquet(f"{small}/documents.parquet"), small), "test-mix")
    files = defaultdict(set)
    for r in docs.select("doc_id", "_metadata.file_name").collect():
        files[r.file_name].add(r.doc_id)
    cut = corpus_pipeline.packing.pieces(docs, corpus_pipeline.TOKENIZER, stretch=corpus_pipeline.F.input_file_name())
    rows = corpus_pipeline.packing.pack(cut, share=40).collect()
    at = {r.doc_id: r.sequence_id >> 32 for r in rows}
    spans = [(min(at[i] for i in files[f]), max(at[i] for i in files[f])) for f in sorted(files)]
    assert len(spans) > 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
