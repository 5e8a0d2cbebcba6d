from collections import Counter
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from gridpulse.llm import mixing, queries


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1, "c": 1}, {"a": 0.5, "b": 0.3, "c": 0.15, "d": 0.05}, {"a": 1000, "b": 1}])
def test_every_prefix_is_within_a_block(weights):
    slots = mixing.slots_per_period(weights, 64)
    assert sum(slots.values()) == 64
    made = mixing.schedule(slots)
    got = Counter()
    for t, (s, b) in enumerate(made, 1):
        assert b == got[s]
        got[s] += 1
        assert all(abs(got[x] - Fraction(t * n, 64)) < 1 for x, n in slots.items())


def test_every_prefix_is_within_a_block_of_the_target(spark):
    """20 sources, one of a third of all text, square-root weights: against the weights that were asked for."""
    sizes = {"hot": 9_500.0} | {f"s{i:02d}": 1_000.0 for i in range(19)}
    weights = {s: n**0.5 for s, n in sizes.items()}
    total = sum(weights.values())
    docs = spark.createDataFrame([(s, i) for s, n in sizes.items() for i in range(int(n) // 4)], "source string, n long")
    docs = docs.select("source", F.xxhash64("source", "n").alias("doc_id"), F.lit(4).alias("size"))
    rows = mixing.mixed(docs, weights, F.col("size"), block_size=4).select("source", "slot").collect()
    at, got = sorted((r.slot, r.source) for r in rows), Counter()
    last = {s: max(t for t, x in at if x == s) for s in sizes}
    owner = dict(at)
    for t in range(min(last.values())):
        got[owner[t]] += 1
        assert all(abs(got[s] - (t + 1) * w / total) < 1 for s, w in weights.items()), t
    assert min(last.values()) > 2 * mixing.PERIOD


def test_rows_are_not_broadcast(spark, joins):
    """A row per document takes few bytes in a file, so only the table of chunks may be sent to the driver."""
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), (F.col("id") % 3).cast("string").alias("source"), F.lit(4).alias("size"))
    found = mixing.mixed(docs, {"0": 1.0, "1": 1.0, "2": 1.0}, F.col("size"), block_size=1000)
    assert joins(found)[1] == ("BroadcastHashJoin", "LeftOuter", "BuildRight")
    assert sorted(r.id for r in found.collect()) == list(range(3000))


def test_rounding_keeps_to_the_target():
    weights = {"hot": (1 / 3) ** 0.5} | {i: (2 / 57) ** 0.5 for i in range(19)}
    assert abs(mixing.slots_per_period(weights)["hot"] - 1024 * weights["hot"] / sum(weights.values())) < 1
    assert mixing.slots_per_period({"a": 1e6, "b": 1, "c": 1}) == {"a": 1022, "b": 1, "c": 1}


def test_rounding():
    slots = mixing.slots_per_period({"a": 0.7, "b": 0.2, "c": 0.1, "none": 0}, 1000)
    assert sum(slots.values()) == 1000 and abs(slots["a"] - 700) <= 2 and "none" not in slots
    assert mixing.slots_per_period({}) == {} and mixing.schedule({}) == []
    many = mixing.slots_per_period({i: 1 for i in range(3000)}, 1024)
    assert len(many) == 3000 and sum(many.values()) == 8192


def plain(rows, weights, block, period):
    """(id, source) to (block, place, release, deadline, slot), in one loop."""
    slots = mixing.slots_per_period(weights, period)
    made = mixing.schedule(slots)
    total = len(made)
    at = {}
    for t, (s, b) in enumerate(made):
        at[s, b] = t
    out = {}
    for source in {r.source for r in rows}:
        begin = 0
        own = [r for r in rows if r.source == source]
        for r in own:
            b, place = divmod(begin, block)
            n = slots.get(source)
            out[r.id] = (b, place, *((b * total // n, -(-(b + 1) * total // n), b // n * total + at[source, b % n]) if n else (None,) * 3))
            begin += r.size
    return out


def test_mixed(spark):
    data = [(i, "abcc"[i % 4] if i % 7 else None, i % 11, i) for i in range(400)] + [(1000, "off", 5, 0), (1001, "a", None, 0)]
    docs = spark.createDataFrame(data, "doc_id long, source string, size long, id long")
    weights = {"a": 3, "b": 1, "c": 1, None: 2}
    mix = mixing.mixed(docs, weights, F.col("size"), block_size=20, period=16)
    order = Counter()
    rows = mix.collect()
    assert len(rows) == 402
    hashes = dict(docs.select("doc_id", F.xxhash64("doc_id")).collect())
    rows.sort(key=lambda r: hashes[r.id])
    want = plain(rows, weights, 20, 16)
    for r in rows:
        assert (r.block, r.place, r.release, r.deadline, r.slot) == want[r.id]
        assert r.slot is None or r.release <= r.slot < r.deadline
        order[r.source] += 1
    assert [r.slot for r in rows if r.source == "off"] == [None]
    assert mixing.mixed(docs.limit(0), weights, F.col("size")).count() == 0


def test_chunks_do_not_change_positions(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 10)
    docs = spark.range(300).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit(3).alias("size"))
    monkeypatch.setattr(mixing, "GROUP", 3)
    rows = mixing.mixed(docs, {"s": 1}, F.col("size"), block_size=9, period=4).collect()
    assert sorted(r.block * 9 + r.place for r in rows) == [3 * i for i in range(300)]
    assert Counter(r.slot for r in rows) == {i: 3 for i in range(100)}


def test_in_mix_order(documents, spark):
    docs = documents(*[f"t{i}" for i in range(30)]).union(documents("t0"))
    docs = docs.union(spark.createDataFrame([(None, "no id", "en", "s", 1, "x")], docs.schema))
    mix = mixing.mixed(docs, {"s": 1}, F.length("text"), block_size=7)
    out = mixing.in_mix_order(docs, mix)
    assert out.columns == docs.columns
    ids = [r.doc_id for r in out.collect()]
    assert len(ids) == 32 and ids[-1] is None
    first = {}
    for r in mix.filter("id is not null").collect():
        first[r.id] = min(first.get(r.id, (9e9, 0)), (r.slot, r.place))
    assert ids[:-1] == sorted(ids[:-1], key=lambda i: (first[i], i))


def test_query(spark, small):
    rows = queries.QUERIES["op2_pfair_mixing"](spark, small).collect()
    assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in spark.read.parquet(f"{small}/documents.parquet").collect())
    slots = {}
    for r in rows:
        assert r.release <= r.slot < r.deadline
        assert slots.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
