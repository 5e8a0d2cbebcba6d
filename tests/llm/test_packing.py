import zlib
from collections import defaultdict

import numpy as np
import pytest
from public_tokenizers import path
from tokenizers import Tokenizer

from gridpulse.llm import packing, queries

PATH = path("byte_bpe_50k.json")


def token_ids(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [0]


def check(rows, docs, length=2048, slack=2):
    """Pieces rebuild the documents; sequences are gapless and about as few as the tokens need."""
    encode = Tokenizer.from_file(PATH).encode
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append((r.offset, r.length))
    assert by_doc.keys() == docs.keys()
    for i, text in docs.items():
        ids = np.array(encode(text or "", add_special_tokens=False).ids + [0], "<u4")
        parts = sorted(by_doc[i], key=lambda r: r.piece)
        assert [r.piece for r in parts] == list(range(-(-len(ids) // length)))
        assert all(r.length == length for r in parts[1:]) and sum(r.length for r in parts) == len(ids)
        at = 0
        for r in parts:
            assert r.start == at and r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
    for held in by_sequence.values():
        at = 0
        for offset, size in sorted(held):
            assert offset == at
            at += size
        assert at <= length
    tokens = sum(r.length for r in rows)
    assert len(by_sequence) <= -(-tokens // length) + slack


def test_place_uses_the_squares():
    # Gaps are 4, 4 and 5 when the last piece of 1 comes: taking it from a 4 leaves 3, 4, 5, all different.
    sequence, offset = packing.place(np.array([6, 6, 5, 1]), 10)
    assert sequence.tolist() == [0, 1, 2, 1] and offset.tolist() == [0, 0, 0, 6]


def test_place_keeps_within_capacity():
    lengths = np.random.default_rng(3).integers(1, 101, 3000)
    sequence, offset = packing.place(lengths, 100)
    fill = np.bincount(sequence, lengths)
    assert fill.max() <= 100 and len(fill) <= 1.02 * lengths.sum() / 100 + (lengths > 50).sum() * 0.05 + 1
    ends = {(s, o + n) for s, o, n in zip(sequence, offset, lengths)}
    assert all(o == 0 or (s, o) in ends for s, o in zip(sequence, offset))


def test_small_documents(documents):
    texts = ["a b c", "", None, "word " * 5000, "word " * 2047, "word " * 2048, "a b c"]
    rows = packing.pack(packing.pieces(documents(*texts), PATH)).collect()
    check(rows, dict(enumerate(texts, 1)))


def test_shares_and_repeats(documents):
    docs = documents(*["one two three"] * 50)
    rows = packing.pack(packing.pieces(docs.union(docs), PATH), share=30).collect()
    assert len(rows) == 100 and len({(r.sequence_id, r.offset) for r in rows}) == 100
    assert {r.length for r in rows} == {len(token_ids("one two three"))}


def test_empty(documents):
    assert packing.pack(packing.pieces(documents("x").limit(0), PATH)).count() == 0


def test_runs_follow_the_positions_at_the_production_share(spark):
    """Sequence ids follow the input at any size, not the lengths of its documents."""
    from pyspark.sql import functions as F

    rows = spark.range(30_000).select(
        F.col("id").alias("doc_id"), (F.pmod(F.xxhash64("id"), F.lit(1500)) + 1).alias("length"),
        F.format_string("part-%05d", F.floor(F.col("id") / 7000)).alias("stretch"), (F.col("id") % 7000).alias("position"),
    )
    packed = packing.pack(rows)
    assert packed.columns == ["doc_id", "length", "sequence_id", "offset"]
    found = sorted((r.sequence_id, r.offset, r.doc_id, r.length) for r in packed.collect())
    assert sorted(f[2] for f in found) == list(range(30_000))
    order = np.array([f[2] for f in found])
    assert np.abs(order - np.arange(30_000)).max() < 2 * packing.RUN
    assert np.corrcoef(order[:4000], np.arange(4000))[0, 1] > 0.5  # also within a run
    sequences = len({f[0] for f in found})
    assert sequences <= 1.005 * sum(f[3] for f in found) / 2048 + 1


@pytest.mark.parametrize("places", [True, False])
def test_pieces_are_not_broadcast(spark, joins, places):
    """The names of stretches take next to nothing in a file, but stand in every row in memory."""
    from pyspark.sql import functions as F

    name = F.format_string("part-%05d-of-a-file-with-a-long-name.parquet", F.col("id") % 3)
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 50 + 1).alias("length"), name.alias("stretch"), F.expr("id div 3").alias("position"))
    found = packing.pack(rows if places else rows.drop("position"))
    assert joins(found)[0] == (("SortMergeJoin", "LeftOuter", None) if places else ("BroadcastHashJoin", "LeftOuter", "BuildRight"))
    assert sorted(r.doc_id for r in found.collect()) == list(range(3000))


def test_a_giant_document_is_spread_over_runs(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(packing, "RUN", 100)
    rows = spark.range(2000).select(
        F.when(F.col("id") < 1000, F.lit(7)).otherwise(F.col("id")).alias("doc_id"), F.lit(10).alias("length"),
        F.lit("f").alias("stretch"), F.when(F.col("id") < 1000, F.lit(0)).otherwise(F.col("id")).cast("long").alias("position"),
    )
    found = packing.pack(rows, share=300).collect()
    by_run = defaultdict(int)
    for r in found:
        by_run[r.sequence_id >> 32] += 1
    assert len(found) == 2000 and max(by_run.values()) < 200 and len(by_run) == 20


def test_query(spark, small):
    docs = dict(spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect())
    check(queries.QUERIES["op4_sum_of_squares_packing"](spark, small).collect(), docs)


@pytest.mark.parametrize("text", ["don't 'tis a'b,'s", "a\n\n b  c", "é x²3 日本", "<|endoftext|> a", " lead", "trail  "])
def test_ids_are_the_library_s(text):
    from gridpulse.llm.tokens import encoder

    ids, n = encoder(PATH).encode(["x", text, ""])
    assert ids[n[0] :].tolist() + [0] == token_ids(text) and n[2] == 0


def test_columns_may_have_any_name(spark):
    from pyspark.sql import functions as F

    extra = "share before step many offset sequence_id gp_share gp_step c0 dealt_by".split()
    rows = spark.range(300).select(
        *[F.concat(F.lit(f"{n}-"), F.col("id")).alias(n) for n in extra], (F.col("id") % 50 + 1).alias("length"),
        F.lit("f").alias("stretch"), F.col("id").alias("position"),
    )
    for given, out in ((rows, [*extra, "length"]), (rows.drop("stretch"), [*extra, "length", "position"])):
        found = packing.pack(given)
        assert found.columns == [*out, "sequence_id_", "offset_"]
        got = found.collect()
        assert sorted(r.share for r in got) == sorted(f"share-{i}" for i in range(300))
        assert all(r.share[6:] == r.c0[3:] and r.length == int(r.share[6:]) % 50 + 1 for r in got)


def test_runs_over_many_stretches_without_places(spark):
    from pyspark.sql import functions as F

    rows = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(100).alias("length"), F.when(F.col("id") > 0, F.format_string("f%04d", "id")).alias("stretch"))
    found = packing.pack(rows, share=50).collect()
    order = [r.doc_id for r in sorted(found, key=lambda r: (r.sequence_id >> 32, r.doc_id))]
    assert order == list(range(500))


def test_the_table_of_pieces_is_small_and_ids_stay_the_library_s(monkeypatch):
    """A worker's table never grows beyond its bound by more than a batch, few bytes as that is; what is left out is encoded anew."""
    from gridpulse.llm import tokens

    assert tokens.KEPT_PIECES <= 400_000 and tokens.KEPT_CHARS <= 8_000_000  # two workers an executor, about 200 bytes a piece
    monkeypatch.setattr(tokens, "KEPT_PIECES", 400)
    rng = np.random.default_rng(5)
    parts = ["a", "Ber", "één", "ß", "ɏ", "the", "xq", "Zz", "7", "12", ",", ".", "!?", "'s", "_", "~", " ", " ", " ", "  ", "\n", "\n ", " \n"]
    made, own = tokens.PieceEncoder(PATH), Tokenizer.from_file(PATH)
    for _ in range(40):
        texts = ["".join(rng.choice(parts, rng.integers(0, 60))) for _ in range(20)]
        ids, n = made.encode(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == [own.encode(t, add_special_tokens=False).ids for t in texts]
        assert len(made.codes) <= 400 + sum(map(len, texts))
    assert len(made.codes) < 1500


def test_words_are_encoded_together():
    """Words go to the library as a few texts; each is kept with its own ids, also where the tokenizer is of another kind."""
    from tokenizers import normalizers

    from gridpulse.llm import tokens

    words = [" eathoueder", "one", " desouèonen", " ñ", " a", "ɏ", " " + "ab" * 300]
    made, own = tokens.PieceEncoder(PATH), Tokenizer.from_file(PATH)
    asked = []
    library = made._library
    made._library = lambda tokenizer, texts: asked.append(len(texts)) or library(tokenizer, texts)
    made._learn(words + ["  two", "\n", "7"])
    assert asked == [1, 3]
    for word, code in made.codes.items():
        assert made._ids_of(np.array([code]))[0].tolist() == own.encode(word, add_special_tokens=False).ids
    made.tokenizer.normalizer = normalizers.Lowercase()
    assert made._words() is None
